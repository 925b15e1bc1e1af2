"""Sampling of rows that keep arriving."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from mirrorset.operators.sample import TieredDistribution, sample_conditional


def sample_stream(
    rows: DataFrame,
    dist: TieredDistribution,
    columns: Mapping[str, str],
    draw: Column,
    name: str,
    path: str,
    checkpoint: str,
    default: Column | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Write ``rows``, a stream, with a drawn value each to Parquet files below ``path``.

    A draw is a hash of the row's key, and the distribution is staged: a row gets the value that the same
    sample of a table gives it, in whatever batch it comes, and after a restart from ``checkpoint``. No state
    is kept. The default trigger reads what is there, in batches, and ends.
    """
    sampled = sample_conditional(rows, dist, columns, draw, name, default)
    writer = sampled.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)
