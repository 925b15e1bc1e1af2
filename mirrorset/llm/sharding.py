"""Shards of nearly equal bytes by sampled splitters.

Rows are put in one order: by a digest of the text, then by id. Keys are drawn with a chance in
proportion to the row's size; quantiles of the drawn keys are the splitters of the ranges that
rows are dealt to. A range with too many rows (a text that a third of all rows share, or very
many tiny rows) is drawn from again and subdivided, down to single rows if need be. Inside the
ranges, and from range to range, exact sums of bytes and rows are carried; the sums alone decide the
shard, so the result depends neither on the draw nor on the partitioning.

Shards obey the law ``bytes``: each takes its share of all bytes, to within the largest row and
the largest group that is kept whole. Rows of equal text lie side by side. A group of
at most one part in ``whole`` of a shard's share goes to the shard of its first row; a larger one is
cut wherever a share ends.

Everything is DataFrame functions. Texts are read once; what is shuffled has a fixed size a row.

Defined cases: a null text has no bytes, size 1 and the group of the empty text; a null id sorts
first; rows with equal id and text are told apart by the place they were read at, so each has a slot
of its own; an empty table has no shards; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorset.sources.staging import stage

DRAWS = 64
LEAST_ROWS = 1_000
MOST_ROWS = 2_000_000
_KEY = ("_group", "id", "_row")


def _key() -> Column:
    return F.struct(*_KEY)


def _range(bounds: str, count: int) -> Column:
    """Number of the ``count`` sorted splitters in the array column ``bounds`` that the key has reached: a binary search."""
    steps = [1 << i for i in reversed(range(count.bit_length()))]

    def step(at: Column, width: Column) -> Column:
        return F.when(F.get(bounds, at + width - 1) <= _key(), at + width).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def _in_ranges(keyed: DataFrame, bounds: DataFrame | None, count: int) -> DataFrame:
    """The rows with their range ``_part``; the splitters are a bounded table, and one value of each row's plan."""
    if bounds is None:
        return keyed.withColumn("_part", F.lit(0))
    all_bounds = bounds.agg(F.sort_array(F.collect_list("key")).alias("b")).scalar()
    placed = keyed.withColumn("_bounds", all_bounds).withColumn("_part", _range("_bounds", count))
    return placed.drop("_bounds")


def _drawn(inside: DataFrame, draws: int, by_rows: bool) -> DataFrame:
    """New splitters ``key`` inside the ranges ``_part`` with ``_rows, _bytes, _cuts``, from about ``draws`` keys a cut.

    A key is hit in proportion to its bytes; with ``by_rows``, half by its bytes and half evenly.
    """
    share = F.col("size") / F.col("_bytes")
    if by_rows:
        share = (share + F.lit(1.0) / F.col("_rows")) / 2
    even = F.pmod(F.xxhash64("_row", "_group", "_part"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    hits = F.floor(share * F.col("_cuts") * draws + even)
    hit = inside.withColumn("_hits", hits).where("_hits > 0")
    by_key = Window.partitionBy("_part").orderBy(*_KEY)
    before = F.sum("_hits").over(by_key) - F.col("_hits")
    total = F.sum("_hits").over(Window.partitionBy("_part"))
    cut = F.floor(before * F.col("_cuts") / total).alias("_cut")
    return (
        hit.select("_part", _key().alias("key"), cut)
        .groupBy("_part", "_cut")
        .agg(F.min("key").alias("key"))
        .where("_cut > 0")
        .select("key")
    )


def _splitters(keyed: DataFrame, rows: int, total: int, ranges: int, draws: int, least_rows: int) -> tuple[DataFrame | None, int]:
    """Splitters of ranges none of which has more than about twice its share of the rows."""
    if ranges == 1:
        return None, 0
    share = max(rows / ranges, least_rows)
    whole = {"_part": F.lit(0), "_rows": F.lit(rows), "_bytes": F.lit(total), "_cuts": F.lit(ranges)}
    bounds = stage(_drawn(keyed.withColumns(whole), draws, False).distinct(), "splitters")
    count = bounds.count()
    while True:
        placed = _in_ranges(keyed, bounds, count)
        counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), F.sum("size").alias("_bytes"))
        full = counts.where(F.col("_rows") > 2 * share).withColumn("_cuts", F.ceil(F.col("_rows") / share))
        more = _drawn(placed.join(F.broadcast(full), "_part"), draws, True)
        both = stage(bounds.union(more).distinct(), "splitters")
        before, count, bounds = count, both.count(), both
        if count == before:
            return bounds, count


def _with_offsets(placed: DataFrame) -> DataFrame:
    """Bytes and rows before each row, and start and bytes of its group, over all ranges.

    Of every range only its sums and its first and last group are looked at together.
    """
    edge = F.struct("_group", "_group_at", "_group_bytes")
    parts = placed.groupBy("_part").agg(
        F.sum("size").alias("_bytes"),
        F.count(F.lit(1)).alias("_rows"),
        F.min(edge).alias("_first"),
        F.max(edge).alias("_last"),
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        "_first",
        "_last",
    )
    ends = F.array_distinct(F.array("_first", "_last"))
    edges = parts.select("_p", "_bytes_before", F.explode(ends).alias("_e")).select(
        F.col("_p").alias("_ep"),
        F.col("_e._group").alias("_eg"),
        (F.col("_bytes_before") + F.col("_e._group_at")).alias("_at"),
        F.col("_e._group_bytes").alias("_held"),
    )
    whole = Window.partitionBy("_eg")
    edges = edges.select(
        "_ep", "_eg", F.min("_at").over(whole).alias("_whole_at"), F.sum("_held").over(whole).alias("_whole_bytes")
    )
    return (
        placed.join(F.broadcast(parts), F.col("_part") == F.col("_p"))
        .join(F.broadcast(edges), (F.col("_part") == F.col("_ep")) & (F.col("_group") == F.col("_eg")), "left")
        .withColumn("_group_at", F.coalesce("_whole_at", F.col("_bytes_before") + F.col("_group_at")))
        .withColumn("_group_bytes", F.coalesce("_whole_bytes", "_group_bytes"))
        .withColumn("_at", F.col("_bytes_before") + F.col("_own_at"))
        .withColumn("_rank", F.col("_rows_before") + F.col("_own_rank"))
    )


def assign(
    documents: DataFrame,
    shards: int = 16,
    ranges: int = 16,
    draws: int = DRAWS,
    whole: int = 64,
    least_rows: int = LEAST_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: ``id_column, size, text_crc32, law, shard, slot, grown_shard``.

    ``slot`` counts the rows of a shard from 0. Rows are dealt to ``ranges`` ranges a shard, more where a
    range would hold over ``MOST_ROWS`` rows, fewer where it would hold under ``least_rows``; about ``draws`` keys a
    range are drawn.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = stage(
        documents.select(
            F.col(id_column).cast("bigint").alias("id"),
            (F.octet_length(text).cast("bigint") + 1).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("_group"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "keys",
    )
    rows, total = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(1))).first()
    wanted = max(1, min(max(shards * ranges, math.ceil(rows / MOST_ROWS)), rows // least_rows))
    bounds, count = _splitters(keyed, rows, total, wanted, draws, least_rows)
    dealt = _in_ranges(keyed, bounds, count).repartitionById(count + 1, F.col("_part"))
    by_key = Window.partitionBy("_part").orderBy(*_KEY)
    of_group = Window.partitionBy("_part", "_group")
    placed = stage(
        dealt.withColumn("_own_at", F.sum("size").over(by_key) - F.col("size"))
        .withColumn("_own_rank", F.row_number().over(by_key).cast("bigint") - 1)
        .withColumn("_group_at", F.min("_own_at").over(of_group))
        .withColumn("_group_bytes", F.sum("size").over(of_group)),
        "placed",
    )
    kept = F.col("_group_bytes") * F.lit(shards * whole) <= F.lit(total)
    start = F.when(kept, F.col("_group_at")).otherwise(F.col("_at"))
    shard = F.call_function("div", start * F.lit(shards), F.lit(total)).cast("int")
    sharded = _with_offsets(placed).withColumn("shard", shard)
    firsts = sharded.groupBy(F.col("shard").alias("_s")).agg(F.min("_rank").alias("_first_rank"))
    return sharded.join(F.broadcast(firsts), F.col("shard") == F.col("_s")).select(
        F.col("id").alias(id_column),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_rank") - F.col("_first_rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
