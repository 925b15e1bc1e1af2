import zlib

import numpy as np
import pyarrow as pa

from mirrorset.llm import quality


def test_held_out_rows_are_told_apart(spark, sf, documents):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    forest = quality.train(documents, labels)
    scored = {r.doc_id: r for r in quality.classify(documents, forest).collect()}
    assert len(scored) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in scored.items())
    held = [(scored[r.doc_id], r.quality) for r in labels.collect() if scored[r.doc_id].held_out]
    assert np.mean([r.predicted == q for r, q in held]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored.values())


def test_scores_do_not_depend_on_blocks(documents):
    column = pa.array([r.text for r in documents.collect()] + [None, "", "a", "\n\n", " x "])
    whole = quality.statistics(column)
    single = np.concatenate([quality.statistics(column.slice(i, 1)) for i in range(len(column))])
    np.testing.assert_allclose(whole, single, rtol=1e-5)


def test_trees_find_a_threshold_and_walk_as_fitted():
    rng = np.random.default_rng(1)
    rows = rng.random((2000, 3)).astype(np.float32)
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 2] > 0.3)).astype(float)
    forest = quality.fit(rows, labels)
    assert np.mean((forest.score(rows) > 0.5) == labels) > 0.98


def test_empty_null_and_unlabelled(spark, make_documents):
    odd = make_documents([(None, "a"), (1, None), (1, None), (2, ""), (3, "x" * 500_000)]).selectExpr("*", "1 AS score")
    labels = spark.createDataFrame([(2, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    forest = quality.train(odd, labels)
    rows = quality.classify(odd, forest).collect()
    assert len(rows) == 5 and all(r.score == 0.5 for r in rows)
    assert quality.classify(odd.limit(0), forest).count() == 0
    assert quality.classify(odd, forest, keep=True).columns == odd.columns


def test_a_sampled_id_counts_once(spark, make_documents):
    """An id repeated in most rows gives one row to learn from, and the same trees."""
    rows = [(i, f"good words and more {i}. " * 5 if i % 2 else "junk !!! $$$ " * (i % 7 + 1)) for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    once = quality.train(make_documents(rows), labels)
    often = quality.train(make_documents(rows + [rows[1]] * 2_000).repartition(7), labels)
    texts = pa.array([t for _, t in rows])
    np.testing.assert_array_equal(once.score(quality.statistics(texts)), often.score(quality.statistics(texts)))


def test_flat_trees_as_a_plain_walk(documents):
    """Scores of the array traversal against a walk of one row at a time."""
    statistics = quality.statistics(pa.array([r.text for r in documents.collect()]))
    rng = np.random.default_rng(5)
    forest = quality.fit(statistics, (rng.random(len(statistics)) < 0.3 + 0.4 * (statistics[:, 0] > np.median(statistics[:, 0]))).astype(float))

    def plain(row):
        total = forest.base
        for node in forest.roots.tolist():
            while forest.left[node] != node:  # a leaf points at itself
                node = int(forest.left[node]) + int(row[forest.feature[node]] > forest.cut[node])
            total += forest.value[node]
        return 1 / (1 + np.exp(-total))

    np.testing.assert_allclose(forest.score(statistics), [plain(r) for r in statistics], rtol=1e-9)
