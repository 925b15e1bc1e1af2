"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Entries become whole numbers, ``floor(256 * c)``. Statistics are taken over the distinct vectors:
their number and sums exactly, then the scatter of the centred vectors, block by block in the tasks;
the tasks' matrices are added up row by row before one matrix reaches the driver. The scatter is
factored as ``L L'`` with the largest remaining diagonal as pivot, which ends at its rank. Jacobi
rotations applied to the columns of ``L`` itself make them orthogonal: their squared norms are the eigenvalues,
and the normalised columns are the eigenvectors. Every row is then projected in one pass.

What the driver holds depends on the number of dimensions alone. A vector that a third of the
rows share is merged before the shuffle.

Defined cases: rows whose vector is null, or holds a null, a NaN or an infinite entry, take no part; of
the others, those whose length is not the most frequent one (the greater of equally frequent) take no part either;
entries beyond the range of a long count as its ends. A component without variance has no
whitened value and is left out, so fewer than asked for may be returned, none for a single distinct vector. A
deviation that does not fit a long is null. Null ids stay, rows that repeat are returned as often; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorset.sources.staging import stage

_LOW_BITS = 20
_LONG = (1 << 63) - 1
BLOCK_ROWS = 4_096
SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


@dataclass(frozen=True)
class Whitening:
    """Number and exact sums of the distinct vectors, eigenvalues, unit components as columns, trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray, count: int) -> np.ndarray:
        """The first ``count`` whitened coordinates of each row of ``x``."""
        return ((x - self.mean) @ self.components[:, :count]) / np.sqrt(self.values[:count])


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower trapezoidal ``L`` and order ``p`` of the rows with ``a[p][:, p] = L @ L.T``; as many columns as the rank."""
    a = a.copy()
    size = len(a)
    order = np.arange(size)
    factor = np.zeros((size, size))
    least = size * np.finfo(float).eps * max(float(np.max(np.diag(a), initial=0.0)), 0.0)
    for k in range(size):
        pivot = k + int(np.argmax(np.diag(a)[k:]))
        if a[pivot, pivot] <= least:
            return factor[:, :k], order
        swap, back = [k, pivot], [pivot, k]
        order[swap] = order[back]
        factor[swap] = factor[back]
        a[swap] = a[back]
        a[:, swap] = a[:, back]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1 :, k] = a[k + 1 :, k] / factor[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor with its columns rotated against each other until all are orthogonal.

    A sweep meets every pair of columns once, in rounds of pairs without a common column.
    """
    w = factor.copy()
    count = w.shape[1]
    ring = np.arange(count + count % 2)  # an odd number gets a column that sits out
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(max(len(ring) - 1, 0)):
            half = len(ring) // 2
            p, q = ring[:half], ring[half:][::-1]
            real = (p < count) & (q < count)
            p, q = p[real], q[real]
            alpha = np.einsum("ij,ij->j", w[:, p], w[:, p])
            beta = np.einsum("ij,ij->j", w[:, q], w[:, q])
            gamma = np.einsum("ij,ij->j", w[:, p], w[:, q])
            scale = np.sqrt(alpha * beta)
            tilt = np.divide(np.abs(gamma), scale, out=np.zeros_like(gamma), where=scale > 0)
            worst = max(worst, float(np.max(tilt, initial=0.0)))
            turn = tilt > 1e-16
            zeta = np.divide(beta - alpha, 2 * gamma, out=np.zeros_like(gamma), where=turn)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = np.where(turn, 1 / np.hypot(1.0, t), 1.0)
            s = np.where(turn, c * t, 0.0)
            left, right = w[:, p], w[:, q]
            w[:, p], w[:, q] = c * left - s * right, s * left + c * right
            ring = np.concatenate((ring[:1], ring[-1:], ring[1:-1]))
        if worst < 1e-15:
            break
    return w


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues of a positive semidefinite matrix, falling, and its unit eigenvectors as columns."""
    factor, order = pivoted_cholesky(scatter)
    rotated = one_sided_jacobi(factor)
    norms = np.sqrt(np.einsum("ij,ij->j", rotated, rotated))
    falling = np.argsort(-norms, kind="stable")
    falling = falling[norms[falling] > 0]
    vectors = np.empty((len(scatter), len(falling)))
    vectors[order] = rotated[:, falling] / norms[falling]
    return norms[falling] ** 2, vectors


def whole_numbers(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, x`` of the rows that take part."""
    c = F.col(vector_column).cast("array<double>")
    finite = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))))
    x = F.transform(c, lambda e: F.greatest(F.least(F.floor(e * 256).cast("double"), F.lit(2.0**63)), F.lit(-(2.0**63))))
    rows = vectors.where(F.col(vector_column).isNotNull() & finite)
    return rows.select(F.col(id_column).cast("bigint").alias("vec_id"), F.transform(x, _to_long).alias("x"))


def _to_long(e):
    return F.when(e >= 2.0**63, F.lit(_LONG)).otherwise(e.cast("bigint"))


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(start, BLOCK_ROWS)


def _exact_sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and sum of each dimension, in two halves that cannot overflow."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for block in _slices(batches):
            x = _matrix(block, "x")
            n += len(x)
            high += (x >> _LOW_BITS).sum(axis=0)
            low += (x & ((1 << _LOW_BITS) - 1)).sum(axis=0)
        if n:
            columns = [pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), pa.array(high), pa.array(low)]
            yield pa.RecordBatch.from_arrays(columns, ["d", "n", "high", "low"])

    parts = fit.mapInArrow(work, "d int, n long, high long, low long")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    rows = sorted(parts.groupBy("d").agg(*wide).collect())
    return int(rows[0].n) if rows else 0, [(int(r.high) << _LOW_BITS) + int(r.low) for r in rows]


def _added(rows: DataFrame, dims: int, work, schema: str) -> np.ndarray:
    """Sum over all tasks of a matrix that each task emits by rows ``i, row``."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), _matrix(batch, "row")):
                held[i] = held[i] + row if i in held else row
        if held:
            width = len(next(iter(held.values())))
            flat = pa.array(np.concatenate(list(held.values())))
            lists = pa.ListArray.from_arrays(pa.array(range(0, len(flat) + 1, width), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), lists], ["i", "row"])

    parts = rows.mapInArrow(work, schema).repartition("i").mapInArrow(add, schema)
    out = np.zeros((dims, dims))
    for r in parts.collect():
        out[r.i, :] = r.row
    return out


def _rows_of(matrix: np.ndarray) -> pa.RecordBatch:
    size = len(matrix)
    lists = pa.ListArray.from_arrays(pa.array(range(0, size * size + 1, size), pa.int32()), pa.array(matrix.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), lists], ["i", "row"])


def _scatter(fit: DataFrame, dims: int, coordinates) -> np.ndarray:
    """Sum over the vectors of the outer products of ``coordinates(x)``, which have ``dims`` entries."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((dims, dims)), False
        for block in _slices(batches):
            d = coordinates(_matrix(block, "x"))
            total += d.T @ d
            seen = True
        if seen:
            yield _rows_of(total)

    return _added(fit, dims, work, "i int, row array<double>")


def fit_whitening(whole: DataFrame, components: int) -> Whitening | None:
    """The transform learnt from the distinct vectors of ``whole``; None where there is no vector with an entry."""
    lengths = whole.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("dims")).first()
    if usual is None or not usual.dims:
        return None
    dims = usual.dims
    fit = stage(whole.where(F.size("x") == dims).select("x").distinct(), "vectors")
    n, sums = _exact_sums(fit, dims)
    mean = np.array([s / n for s in sums])
    covariance = _scatter(fit, dims, lambda x: x - mean) / n
    values, vectors = eigen(covariance)
    count = min(components, len(values))
    model = Whitening(n, sums, values, vectors, float(np.trace(covariance)))
    if not count:
        return model
    identity = _scatter(fit, count, lambda x: model.project(x, count)) / n
    error = float(np.max(np.abs(identity - np.eye(count))))
    return Whitening(n, sums, values, vectors, model.trace, error)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums over the dimensions of ``(n * x - S) ** 2``."""
    largest = n * int(np.max(np.abs(x.astype(float)), initial=0.0) + 1) + max(map(abs, sums))
    if len(sums) * largest * largest <= _LONG:
        return ((x * n - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * e - s) ** 2 for e, s in zip(row, sums)) for row in x.tolist()]
    return [e if e <= _LONG else None for e in exact]


def whiten(vectors: DataFrame, components: int = 4, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row for each vector and each of its first ``components`` whitened coordinates."""
    whole = whole_numbers(vectors, id_column, vector_column)
    model = fit_whitening(whole, components)
    count = min(components, len(model.values)) if model else 0
    if not count:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    explained = model.values[:count] / model.trace

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _slices(batches):
            rows = block.num_rows
            x = _matrix(block, "x")
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("vec_id").take(pa.array(np.repeat(np.arange(rows), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, model.n, np.int64)),
                    pa.array([d for d in _deviations(x, model.n, model.sums) for _ in range(count)], pa.int64()),
                    pa.array(model.project(x, count).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * count, model.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return whole.where(F.size("x") == len(model.sums)).mapInArrow(work, SCHEMA)
