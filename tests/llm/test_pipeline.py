"""The stages, one after another, against brute-force versions."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from mirrorset.llm import quality
from test_minhash import brute as brute_classes


def without_repeats(rows, width=200):
    texts = {i: t.encode() for i, t in rows}
    seen = Counter(t[p : p + width] for t in texts.values() for p in range(len(t) - width + 1))
    out = []
    for i, t in texts.items():
        covered = np.zeros(len(t), bool)
        for p in range(len(t) - width + 1):
            if seen[t[p : p + width]] > 1:
                covered[p : p + width] = True
        out.append((i, bytes(b for b, c in zip(t, covered) if not c).decode("utf-8", "ignore")))
    return out


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, function in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        function(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def pairs(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_filter", "near_duplicates", "repeated_strings", "packing"]
    for df in stages[1:-1]:
        assert dict(df.dtypes) == dict(stages[0].dtypes)


def test_quality(spark, sf, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {i for i, _ in pairs(stages[1])}
    forest = quality.train(stages[0], spark.read.parquet(f"{sf}/labels.parquet"))
    assert kept == {r.doc_id for r in quality.classify(stages[0], forest).collect() if r.predicted}
    assert np.mean([(i in kept) == (q == 1) for i, q in labels.items()]) > 0.95


def test_near_duplicates(stages):
    given = pairs(stages[1])
    leaders = {c for _, c in brute_classes(given)}
    assert pairs(stages[2]) == [(i, t) for i, t in given if i in leaders]


def test_repeated_strings(stages):
    assert pairs(stages[3]) == sorted(without_repeats(pairs(stages[2])))
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_packing(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in stages[4].collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    given = pairs(stages[3])
    assert set(pieces) == {i for i, _ in given}
    for i, text in given:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert sum(n for _, n, _ in pieces[i]) == len(ids)
        assert all(zlib.crc32(ids[a : a + n].tobytes()) == c for a, n, c in pieces[i])


def test_run_gives_the_last_stage(spark, sf, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    mine = corpus_pipeline.run(spark, sf).select(*columns).collect()
    assert sorted(mine) == sorted(stages[4].select(*columns).collect())


@pytest.mark.parametrize("rows", [[], [(None, None), (None, None), (1, ""), (1, ""), (2, None), (3, "x " * 60_000), (3, "same id"), (4, "same id")]])
def test_stages_take_odd_rows(spark, sf, make_documents, tmp_path, rows):
    """Nulls in every column, repeated rows and ids, empty and long texts, no rows, and further columns."""
    docs = make_documents(rows).selectExpr("*", "'a' AS k", "'b' AS node", "1 AS tag", "2 AS row", "3 AS marks", "4 AS score")
    columns = docs.columns
    for name, function in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        function(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "quality_filter":
            assert set(docs.columns) == set(columns)
            docs = make_documents(rows).selectExpr("*", "'a' AS k", "'b' AS node", "1 AS tag", "2 AS row", "3 AS marks", "4 AS score")
        elif name == "near_duplicates":  # the empty texts are one class, and so is "same id"
            assert docs.columns == columns
            assert sorted((r.text or "")[:4] for r in docs.collect()) == (["", "same", "x x "] if rows else [])
        elif name == "repeated_strings":
            assert docs.columns == columns and docs.count() == (3 if rows else 0)
    assert (docs.groupBy("doc_id").count().count() > 0) == bool(rows)
