"""Ranks, running sums and identifiers that hold no group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorset.config import DEFAULT_LIMITS, Limits
from mirrorset.functions.draws import hash_u60, scale_u60
from mirrorset.operators.joins import all_of
from mirrorset.sources.staging import stage

_POSITION_BITS = 33  # fixed value: low bits of monotonically_increasing_id


def _in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Stage ``df`` split into ranges of ``order``, with part number and position in it.

    ``order`` must be unique per row for the result to be reproducible. Hot values
    of the leading columns are cut by the following ones.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(ranged.withColumn("_place", F.monotonically_increasing_id()), "ordered")
    return placed.withColumn("_part", F.shiftright("_place", _POSITION_BITS)).withColumn(
        "_pos", F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    )


def _fits(rows: int | None, limits: Limits) -> bool:
    return rows is not None and limits.small(rows)


def dense_index(
    df: DataFrame,
    order: Sequence[str],
    start: int = 0,
    name: str = "idx",
    rows: int | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Contiguous ids from ``start`` in the total order of the columns ``order``.

    Only the row counts of the parts, one number each, pass through one task. Where
    the number of ``rows`` is small, a plain window does it; if it is not given, they are staged and counted.
    """
    if rows is None:
        df = stage(df, "counted")
        rows = df.count()
    if _fits(rows, limits):
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint") + (start - 1))
    placed = _in_order(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    )
    return (
        placed.join(F.broadcast(offsets), F.col("_part") == F.col("_p"))
        .withColumn(name, F.lit(start) + F.col("_off") + F.col("_pos"))
        .drop("_place", "_part", "_pos", "_p", "_off")
    )


def _carried(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per part ``_p`` the sum ``_off`` of its first group ``_g0``… over all earlier parts.

    Only the first and the last group of a part can be shared with another part, so
    two rows per part are enough, however many groups there are.
    """
    group = [f"_g{i}" for i in range(len(keys))]
    named = placed.select(F.col("_part").alias("_p"), "_pos", "_w", *[F.col(k).alias(g) for k, g in zip(keys, group)])
    lasts = named.groupBy(F.col("_p").alias("_lp")).agg(F.max("_pos").alias("_end"))
    ends = named.join(F.broadcast(lasts), (F.col("_p") == F.col("_lp")) & (F.col("_pos") == F.col("_end")))
    last_groups = ends.select("_lp", *[F.col(g).alias(f"_l{g}") for g in group])
    in_last = all_of([F.col("_p") == F.col("_lp"), *[F.col(g).eqNullSafe(F.col(f"_l{g}")) for g in group]])
    tails = named.join(F.broadcast(last_groups), in_last).groupBy("_p", *group).agg(F.sum("_w").alias("_s"))
    heads = named.where(F.col("_pos") == 0).select("_p", *group, F.lit(None).cast("bigint").alias("_s"))
    both = tails.withColumn("_tail", F.lit(1)).unionByName(heads.withColumn("_tail", F.lit(0)))
    before = Window.partitionBy(*group).orderBy("_p", "_tail").rowsBetween(Window.unboundedPreceding, -1)
    return both.withColumn("_off", F.sum("_s").over(before)).where(F.col("_tail") == 0).select("_p", *group, "_off")


def running_total(
    df: DataFrame,
    order: Sequence[str],
    weight: Column,
    name: str,
    keys: Sequence[str] = (),
    rows: int | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Sum of the integer ``weight`` from the first row of the key group up to this row.

    NULL weights add nothing; the sum is NULL until the first weight. NULL keys are one group.

    A group of any size is summed part by part, and the sums of earlier parts are
    added to its later ones. Where the number of ``rows`` is small, or the longest group is counted to be short,
    a plain window does it: a shuffle by key instead of a sort and a write. Without keys and ``rows``,
    the rows are staged and counted.
    """
    short = False
    if rows is None and keys:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        short = limits.short(sizes.agg(F.max("_n")).first()[0] or 0)
    elif rows is None:
        df = stage(df, "counted")
        rows = df.count()
    if short or _fits(rows, limits):
        upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.sum(weight.cast("bigint")).over(upto))
    placed = _in_order(df.withColumn("_w", weight.cast("bigint")), [*keys, *order])
    offsets = _carried(placed, keys)
    on = all_of(
        [F.col("_part") == F.col("_p"), *[F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys)]]
    )
    here = Window.partitionBy(*keys, "_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.join(F.broadcast(offsets), on, "left")
        .withColumn("_w", F.sum("_w").over(here))
        .withColumn(name, F.coalesce(F.col("_off") + F.col("_w"), "_off", "_w"))
        .drop("_w", "_place", "_part", "_pos", "_p", "_off", *[f"_g{i}" for i in range(len(keys))])
    )


def group_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "rank",
    rows: int | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Row number from 1 inside each key group."""
    return running_total(df, order, F.lit(1).cast("bigint"), name, keys, rows, limits)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``columns`` of the first row per key in ``order``, by aggregation, without a sort."""
    lead = F.min_by(F.struct(*columns), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(lead).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in columns])


def permutation(seed: int, span: int) -> tuple[int, int]:
    """Factor and shift of an affine permutation of ``range(span)`` whose products fit a BIGINT."""
    limit = max(2, min(span, (1 << 62) // max(span, 1)))
    factor = max(1, (seed * 2_654_435_761 + 1_013_904_223) % limit)
    while gcd(factor, span) != 1:
        factor = factor + 1 if factor + 1 < limit else 1
    return factor, (seed * 40_503 + 12_345) % span


def _turns(idx: Column, span: int) -> tuple[Column, Column]:
    """The place of an index in its range, and the length of all ranges before that one."""
    at = idx.cast("bigint")
    place = F.pmod(at, F.lit(span).cast("bigint"))
    return place, at - place


def surrogate_key(idx: Column, low: int, high: int, seed: int, beyond: bool = False) -> Column:
    """Distinct key in ``[low, high)`` for each index from 0, as an affine permutation.

    Fails on an index that the range cannot hold. With ``beyond``, such indexes get keys of the next ranges of the same
    length, ``[high, 2 * high - low)`` and so on, so that all keys stay distinct.
    """
    span = high - low
    factor, shift = permutation(seed, span)

    def key(at: Column) -> Column:
        return F.lit(low) + F.pmod(F.lit(factor).cast("bigint") * at + F.lit(shift), F.lit(span))

    if beyond:
        place, before = _turns(idx, span)
        return key(place) + before
    refused = F.raise_error(F.lit(f"more than {span} keys are needed")).cast("bigint")
    return F.when(idx >= span, refused).otherwise(key(idx))


FEISTEL_ROUNDS = 8
_WALKS = 8


def feistel_sides(span: int) -> tuple[int, int]:
    """Numbers ``a`` and ``b`` of about equal size whose product just holds ``span``."""
    a = max(1, isqrt(max(span, 1) - 1) + 1)
    return a, -(-span // a)


def feistel_key(idx: Column, low: int, high: int, secret: str, beyond: bool = False) -> Column:
    """Distinct key in ``[low, high)`` for each index from 0, by a keyed permutation that known pairs do not give away.

    An index is split into two digits, of ``a`` and ``b`` values. Each round adds a hash of one digit, the round and
    ``secret`` to the other, which can be undone, so the whole is a permutation of ``a * b`` values. That is at most
    ``a`` more than the range: results behind its end are permuted again (cycle walking) until they lie in it.

    Fails on an index that the range cannot hold, and, rather than return a key twice, on one that is still outside
    after nine turns; of a range of n values, a share of about n^-4.5 would be. With ``beyond``, indexes that the range
    cannot hold get keys of the next ranges of the same length, so that all keys stay distinct.
    """
    span = high - low
    a, b = feistel_sides(span)

    def mixed(number: Column, digit: Column, sides: int) -> Column:
        text = F.concat(F.lit(f"{len(secret)}:{secret}:"), number.cast("string"), F.lit(":"), digit.cast("string"))
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint") % sides

    def one_round(digits: Column, number: Column) -> Column:
        left, right, odd = digits["l"], digits["r"], number % 2 == 1
        return F.struct(
            F.when(odd, (left + mixed(number, right, a)) % a).otherwise(left).alias("l"),
            F.when(odd, right).otherwise((right + mixed(number, left, b)) % b).alias("r"),
        )

    def permuted(value: Column) -> Column:
        start = F.struct(F.call_function("div", value, F.lit(b)).alias("l"), (value % b).alias("r"))
        rounds = F.array(*[F.lit(i) for i in range(1, FEISTEL_ROUNDS + 1)])
        return F.aggregate(rounds, start, one_round, lambda digits: digits["l"] * b + digits["r"])

    walks = F.array(*[F.lit(i) for i in range(min(a * b - span, _WALKS) + 1)])
    place, before = _turns(idx, span) if beyond else (idx.cast("bigint"), F.lit(0).cast("bigint"))
    walked = F.aggregate(walks, place, lambda v, i: F.when((i == 0) | (v >= span), permuted(v)).otherwise(v))
    lost = F.raise_error(F.lit("no key found; choose another secret")).cast("bigint")
    held = F.transform(F.array(walked), lambda v: F.when(v < span, v).otherwise(lost))[0]  # the rounds are run once
    key = F.lit(low) + before + held
    if beyond:
        return key
    many = F.raise_error(F.lit(f"more than {span} keys are needed")).cast("bigint")
    return F.when(idx >= span, many).otherwise(key)


def pick_existing(
    rows: DataFrame,
    row_keys: Sequence[str],
    pool: DataFrame,
    pool_key: str,
    name: str,
    seed: int,
    tag: str = "pick",
) -> DataFrame:
    """A key of ``pool``, drawn evenly and with replacement, for each row.

    The pool is numbered and the drawn numbers are joined, so both sides spread evenly.
    """
    numbered = dense_index(pool.select(F.col(pool_key).alias(name)), [name], 0, "_idx")
    size = numbered.agg(F.count(F.lit(1)).alias("n")).scalar()
    drawn = rows.withColumn("_draw", scale_u60(hash_u60(seed, tag, *[F.col(k) for k in row_keys]), size))
    return drawn.join(numbered, F.col("_draw") == F.col("_idx"), "left").drop("_draw", "_idx")
