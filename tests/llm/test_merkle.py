import hashlib
import re

import pytest
from pyspark.sql import functions as F

from mirrorset.llm import merkle

TEXTS = [
    "", None, "a", "One. Two! Three?\nNext line\n\nA new section. " + "x" * 300, "same text.\nhere", "same text.\nhere",
    "é" * 10 + "日本", "\n\n\n", "no end" * 50, "Word one. Word two.\n" * 40, "." * 500, "a b\n \n c\n",
]


def fingerprint(text):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    sections = []
    for s in re.findall(r"(?s).+?(?:\n[ \t]*\n\s*|\Z)", text):
        paragraphs = []
        for p in re.findall(r"[^\n]*\n|[^\n]+", s):
            pieces = [sha(x) for x in re.findall(r"[^.!?\n]{0,64}[.!?\n]+|[^.!?\n]{1,64}", p)]
            paragraphs.append((sha("".join(pieces)), pieces))
        sections.append((sha("".join(d for d, _ in paragraphs)), paragraphs))
    top = sha("".join(d for d, _ in sections))
    listed = ";".join(d[:8] + ":" + ",".join(p[:8] + "".join(x[:8] for x in xs) for p, xs in ps) for d, ps in sections)
    return top + "|" + listed, {x[:8] for _, ps in sections for _, xs in ps for x in xs}


def like(a, b):
    return 1.0 if not a and not b else 2 * len(a & b) / (len(a) + len(b))


@pytest.mark.parametrize("ranges", [None, 1, 5])
def test_as_brute_force(spark, make_documents, monkeypatch, ranges):
    monkeypatch.setattr(merkle, "_RANGES", ranges or 8)
    rows = [(i * 37 % 1000, t) for i, t in enumerate(TEXTS * 8)]
    rows = [(i, t) for n, (i, t) in enumerate(rows)]
    assert len({i for i, _ in rows}) == len(rows)
    got = {r.doc_id: r for r in merkle.compare_with_edit(make_documents(rows)).collect()}
    ordered = sorted(((i, t or "") for i, t in rows), reverse=True)
    assert len(got) == len(rows)
    for n, (i, text) in enumerate(ordered):
        following = ordered[(n + 1) % len(ordered)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        own, pieces = fingerprint(text)
        other, other_pieces = fingerprint(edited)
        r = got[i]
        assert (r.n_chars, r.fingerprint, r.edited_fingerprint) == (len(text), own, other)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(like(pieces, other_pieces))
        assert r.near_next == pytest.approx(like(pieces, fingerprint(following)[1]))


def test_repeated_null_and_single_rows(spark, make_documents):
    rows = merkle.compare_with_edit(make_documents([(1, "a b c"), (1, "a b c"), (None, "x"), (None, None)])).collect()
    assert len(rows) == 4
    single = merkle.with_next(make_documents([(7, "abc def")])).collect()
    assert [r.next_text for r in single] == ["abc def"]
    assert merkle.compare_with_edit(make_documents([])).count() == 0
    clash = make_documents([(1, "a")]).selectExpr("*", "1 AS part", "2 AS copy", "3 AS tie")
    assert merkle.compare_with_edit(clash).count() == 1


def test_differing_branches_locate_an_edit(spark):
    frame = spark.createDataFrame([("a.\nb.\n\nc.\nd.", "a.\nb.\n\nc.\nX.")], "l string, r string")
    places = frame.select(merkle.differing(merkle.tree(F.col("l")), merkle.tree(F.col("r"))).alias("d")).first().d
    assert [tuple(p) for p in places] == [(1, 1)]


@pytest.mark.parametrize("ranges", [1, 6])
def test_an_id_of_a_third_of_all_rows(spark, make_documents, monkeypatch, ranges):
    """Rows of one id are ordered by hash and text, and lie in many ranges."""
    monkeypatch.setattr(merkle, "_RANGES", ranges)
    rows = [(500, f"text number {i}. And more") for i in range(100)] + [(i * 5, f"other {i}") for i in range(200) if i != 100]
    df = make_documents(rows + [(None, "no id"), (None, "none either")]).repartition(5)
    ties = {r.text: r.t for r in df.select("text", F.xxhash64("text").alias("t")).collect()}
    ordered = sorted(rows, key=lambda r: (r[0], ties[r[1]], r[1]), reverse=True)
    ordered += sorted([(None, "no id"), (None, "none either")], key=lambda r: (ties[r[1]], r[1]), reverse=True)
    want = [(i, t, ordered[(n + 1) % len(ordered)][1]) for n, (i, t) in enumerate(ordered)]
    got = [tuple(r) for r in merkle.with_next(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    found = df.agg(F.percentile_approx("doc_id", [i / 40 for i in range(1, 40)])).first()[0]
    bounds = merkle._bounds(found)
    key = F.struct(F.col("doc_id").alias("i"), F.xxhash64("text").alias("t"))
    parts = df.where("doc_id = 500").groupBy(merkle._range_of(key, bounds)).count().collect()
    assert len(parts) > 8 and max(r["count"] for r in parts) < 30


def test_a_very_long_text(make_documents):
    long = "One sentence. Another one!\nA line\n\n" * 8_000
    rows = {r.doc_id: r for r in merkle.compare_with_edit(make_documents([(1, long), (2, long + "x"), (3, "short")])).collect()}
    assert rows[1].n_chars == len(long) and rows[1].fingerprint == fingerprint(long)[0] and rows[2].near_next > 0.5
