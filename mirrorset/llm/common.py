"""Helpers that the operators share: texts in bounded blocks, vectorised hashing, Arrow output."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

BLOCK_BYTES = 4 << 20
_BASE = 0x100000001B3
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blocks(batches: Iterable[pa.RecordBatch], column: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``size`` text bytes; a longer text is a slice of its own."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a text column, and each text's start and length in them (null: empty)."""
    data = column.cast(pa.large_binary())
    offsets = np.frombuffer(data.buffers()[1], np.int64, len(data) + 1, data.offset * 8)
    raw = data.buffers()[2]
    flat = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    if data.null_count:
        lengths = np.where(data.is_valid().to_numpy(zero_copy_only=False), lengths, 0)
    first = int(offsets[0]) if len(offsets) else 0
    last = int(offsets[-1]) if len(offsets) else 0
    return flat[first:last], (offsets[:-1] - first).astype(np.int64), lengths.astype(np.int64)


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Scrambled polynomial hash of each ``k`` neighbouring values, by doubling."""
    if len(values) < k:
        return np.zeros(0, np.uint64)
    power, length, done = values.astype(np.uint64) + np.uint64(1), 1, 0
    result = None
    rest = k
    while rest:
        if rest & 1:
            if result is None:
                result, done = power, length
            else:
                n = len(values) - done - length + 1
                result = result[:n] * np.uint64(pow(_BASE, length, 1 << 64)) + power[done : done + n]
                done += length
        rest >>= 1
        if rest:
            n = len(power) - length
            power = power[:n] * np.uint64(pow(_BASE, length, 1 << 64)) + power[length : length + n]
            length *= 2
    return mix64(result)


class SpanHash:
    """Hashes of arbitrary spans of one value array, from prefix sums in arithmetic modulo 2^64.

    Equal spans have equal hashes; the length is part of the hash.
    """

    def __init__(self, values: np.ndarray):
        n = len(values)
        powers = np.empty(n + 1, np.uint64)
        powers[0] = 1
        powers[1:] = _BASE
        np.multiply.accumulate(powers, out=powers)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix64(values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * powers[:n], out=self.sums[1:])
        self.n = n
        self.powers = powers * np.uint64(pow(_BASE, -n, 1 << 64))  # power i is the base to the power of i - n

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        spans = (self.sums[ends] - self.sums[starts]) * self.powers[self.n - starts]
        return mix64(spans + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes ``starts[i] .. starts[i] + lengths[i] - 1`` for all i, one after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def sliding(values: np.ndarray, width: int, reduce: np.ufunc) -> np.ndarray:
    """Reduction over each window of ``width`` neighbours, by doubling."""
    length = 1
    out = values
    while length * 2 <= width:
        out = reduce(out[:-length], out[length:])
        length *= 2
    return reduce(out[: len(out) - (width - length)], out[width - length :]) if length < width else out
