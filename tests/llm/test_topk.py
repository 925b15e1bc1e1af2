import math
import random

import pytest

from mirrorset.llm import topk


def brute(rows, queries, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, qv in good:
        if q not in queries:
            continue
        scored = [(-sum(a * b for a, b in zip(qv, v)), i) for i, v in good if i != q and len(v) == len(qv)]
        out |= {(q, n, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k], 1)}
    return out


@pytest.mark.parametrize("size,block,group", [(300, 4096, 512), (300, 16, 4), (4, 4096, 512)])
def test_as_brute_force(spark, monkeypatch, size, block, group):
    monkeypatch.setattr(topk, "ROWS_PER_BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES_PER_GROUP", group)
    rng = random.Random(size)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(9)]) for i in range(size)]
    rows += [(size + i, [0.5] * 9) for i in range(40)]
    rows += [(1000, None), (1001, []), (1002, [None] + [0.1] * 8), (1003, [float("nan")] * 9), (1004, [float("inf")] * 9),
             (1005, [0.3] * 4), (1010, [0.1] * 4), (None, [0.2] * 9), (1020, [3e6] * 9), (1030, [-3e6] * 9)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    asked = {i for i, _ in rows if i is not None and i % 10 == 0}
    got = topk.top_k(frame, frame.where("vec_id % 10 = 0"), 5)
    assert {tuple(r) for r in got.collect()} == brute(rows, asked, 5)


def test_empty(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(frame, frame).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(one, one).count() == 0


@pytest.mark.parametrize("k,block", [(5, 4096), (5, 16), (1, 4096)])
def test_a_query_id_repeated_in_a_third_of_the_rows(spark, monkeypatch, k, block):
    """Its own copies are the best in every slice, and one of its vectors is invalid."""
    monkeypatch.setattr(topk, "ROWS_PER_BLOCK", block)
    rng = random.Random(k)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(1, 101)]
    own = [2.0] * 8
    frame = spark.createDataFrame(rows + [(0, own)] * 50 + [(0, [float("nan")] * 8), (0, [3.0, None])], "vec_id long, embedding array<double>")
    floors = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    scored = sorted((-sum(512 * x for x in v), i) for i, v in floors.items())
    want = [(0, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    got = topk.top_k(frame, frame.where("vec_id = 0"), k)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_the_valid_vector_of_a_repeated_query_id_counts(spark):
    rows = [(0, [1.0, 1.0]), (0, [float("nan"), 1.0]), (0, [float("inf"), 1.0]), (1, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(frame, frame.where("vec_id = 0"), 1).collect()] == [(0, 1, 1, 65536)]
