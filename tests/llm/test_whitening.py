"""Whitening against numpy's own eigenvectors."""

import math

import numpy as np
import pytest

from mirrorset.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, count=4):
    good = [(i, v) for i, v in rows if v is not None and all(e is not None and math.isfinite(e) for e in v)]
    x = np.array([[math.floor(256 * e) for e in v] for _, v in good], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    projected = (x - sums / n) @ vectors[:, :count] / np.sqrt(values[:count])
    deviation = [sum((n * int(e) - int(s)) ** 2 for e, s in zip(row, sums)) for row in x]
    return [i for i, _ in good], n, deviation, projected, values[:count] / values.sum()


def same(got, rows, count=4):
    ids, n, deviation, projected, explained = brute(rows, count)
    by_row = sorted((r.component, r.vec_id, r.deviation, abs(r.whitened)) for r in got)
    want = sorted((k + 1, i, d, abs(p[k])) for i, d, p in zip(ids, deviation, projected) for k in range(count))
    assert [r[:3] for r in by_row] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in by_row], [r[3] for r in want], rtol=0, atol=1e-9)
    assert {r.n for r in got} == {n} and all(0 <= r.identity_error < 1e-10 for r in got)
    for r in got:
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)


def test_equals_numpy(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    same(whitening.whiten(table).collect(), [(r.vec_id, r.embedding) for r in table.collect()])


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    basis = rng.normal(size=(6, 9))
    good = [(i, (rng.normal(size=6) * [9, 5, 3, 2, 1, 0.5] @ basis).astype(np.float32).tolist()) for i in range(80)]
    hot = [(100 + i, good[0][1]) for i in range(60)] + [(5, good[5][1])]
    bad = [(200, None), (201, [None] * 9), (202, [math.nan] + [0.0] * 8), (203, [math.inf] * 9)]
    other = [(204, [1.0] * 4), (205, []), (206, [])]
    table = spark.createDataFrame([(i, v, None) for i, v in good + hot + bad + other], VECTORS).repartition(5)
    got = whitening.whiten(table.selectExpr("*", "1 AS n", "2 AS x", "3 AS component")).collect()
    same(got, good + hot + bad)


def test_sign_is_the_same_for_all_rows(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(300, 5)).astype(np.float32)
    table = spark.createDataFrame([(i, e.tolist(), 0) for i, e in enumerate(v)], VECTORS)
    got = sorted(whitening.whiten(table, 2).collect(), key=lambda r: r.vec_id)
    *_, projected, _ = brute([(i, e.tolist()) for i, e in enumerate(v)], 2)
    for k in (0, 1):
        mine = np.array([r.whitened for r in got if r.component == k + 1])
        assert min(np.abs(mine - projected[:, k]).max(), np.abs(mine + projected[:, k]).max()) < 1e-9


def test_no_variance_and_empty(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == []
    one = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(9)], VECTORS)
    assert whitening.whiten(one).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i], 0) for i in range(9)], VECTORS)
    got = whitening.whiten(line).collect()
    assert {r.component for r in got} == {1} and got[0].explained == pytest.approx(1)


def test_large_entries(spark):
    table = spark.createDataFrame([(i, [float(i) * 1e12, 1.0 - i, float(i * i)], 0) for i in range(5)], "vec_id long, embedding array<double>, label int")
    got = whitening.whiten(table, 1).collect()
    assert all(r.deviation is None or r.deviation >= 0 for r in got) and any(r.deviation is None for r in got)


@pytest.mark.parametrize("size, rank", [(1, 1), (7, 7), (30, 12), (64, 64)])
def test_eigen(size, rank):
    rng = np.random.default_rng(size)
    a = rng.normal(size=(size, rank)) * np.geomspace(1, 1e-3, rank)
    values, vectors = whitening.eigen(a @ a.T)
    want = np.linalg.eigvalsh(a @ a.T)[::-1]
    assert len(values) <= size and np.allclose(values[:rank], want[: len(values[:rank])], atol=1e-13 * size)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-9)


def test_cholesky():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(8, 5))
    factor, order = whitening.pivoted_cholesky(a @ a.T)
    assert factor.shape == (8, 5) and np.allclose(np.triu(factor, 1), 0)
    assert np.allclose(factor @ factor.T, (a @ a.T)[np.ix_(order, order)])
