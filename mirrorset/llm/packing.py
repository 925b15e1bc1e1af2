"""Packing of tokenised documents by power-of-two decomposition.

A document of ``n`` ids (with the closing id) is cut into as many pieces of the largest
length as fit, then into one piece for each binary digit of the rest, longest first. Every
piece is a sequence by itself, so no sequence crosses documents and none is padded; pieces
of equal length form a bucket, which a trainer draws its batches from.

Defined cases: a null or empty text is one piece that holds the closing id alone; repeated
rows are packed separately; any other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorset.llm.bpe import task_encoder
from mirrorset.llm.common import ragged

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket int"


def binary_pieces(lengths: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, start and length of all pieces; ``longest`` is a power of two."""
    whole = lengths // longest
    bits = int(longest).bit_length() - 1
    digits = (lengths[:, None] >> np.arange(bits - 1, -1, -1)) & 1
    counts = np.concatenate((whole[:, None], digits), axis=1)
    sizes = 1 << np.arange(bits, -1, -1, dtype=np.int64)
    per_document = counts.sum(axis=1)
    length = np.repeat(np.tile(sizes, len(lengths)), counts.ravel())
    document = np.repeat(np.arange(len(lengths)), per_document)
    ends = np.cumsum(length)
    first = np.concatenate(([0], ends))[np.cumsum(per_document) - per_document]
    return document, ends - length - first[document], length


def pack(
    documents: DataFrame,
    path: str,
    longest: int = 1024,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: its document and place in it, its length, a checksum of its ids and its sequence.

    ``sequence_id`` is unique; sequences of one length carry the same ``bucket`` (the binary
    logarithm of the length). One pass over the rows, without a shuffle.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = task_encoder(path)
        for block, ids, _ in encoder.encoded(batches, "text"):
            if not block.num_rows:
                continue
            counts = np.fromiter(map(len, ids), np.int64, len(ids)) + 1
            flat = np.full(int(counts.sum()), end_id, "<u4")
            begins = np.cumsum(counts) - counts
            flat[ragged(begins, counts - 1)] = np.concatenate(ids)
            document, start, length = binary_pieces(counts, longest)
            view = memoryview(flat).cast("B")
            ends = np.cumsum(length)
            sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip((ends - length).tolist(), ends.tolist())]
            columns = [
                block.column("id").take(pa.array(document)),
                pa.array(start),
                pa.array(length),
                pa.array(sums, pa.int64()),
                pa.array(counts[document]),
                pa.array(np.round(np.log2(length)).astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "bucket"])

    rows = documents.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(work, SCHEMA).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
        "bucket",
    )
