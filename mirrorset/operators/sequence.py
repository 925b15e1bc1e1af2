"""Ordered date sequences per animal: expansion, running dates and repair."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorset.config import DEFAULT_LIMITS, Limits
from mirrorset.functions.dates import add_days, add_months_overflow
from mirrorset.operators.joins import next_by_ordinal
from mirrorset.operators.keys import running_total

# Fixed values of the data model.
LACTATION_START = 3_531_047
UNIT_DAYS = 30
DEFAULT_MONTHS = 10
SHORTEST_MONTHS = 2
DRY_MONTHS = 2
BLOCK = 1_000


def explode_counter(
    df: DataFrame,
    key: str,
    count: str,
    ordinal: str = "nolact",
    id_column: str = "id_laitlact",
    start: int = LACTATION_START,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """``count`` rows per key with ordinals from 1 and consecutive ids in key order.

    The running sum is taken over keys, so the expanded rows are not shuffled. Long
    counts are expanded block by block, so that no array gets long.
    """
    summed = running_total(df, [key], F.col(count), "_end", limits=limits).where(F.col(count) >= 1)
    number = F.col(count).cast("int")
    blocks = summed.withColumn("_from", F.explode(F.sequence(F.lit(0), number - 1, F.lit(BLOCK))))
    upto = F.least(number, F.col("_from") + BLOCK)
    rows = blocks.withColumn(ordinal, F.explode(F.sequence(F.col("_from") + 1, upto)))
    ids = F.lit(start) + F.col("_end") - F.col(count) + F.col(ordinal) - 1
    return rows.withColumn(id_column, ids).drop("_end", "_from")


def _per_key(key: str, ordinal: str) -> Window:
    return Window.partitionBy(key).orderBy(ordinal)


def cumulative_dates(
    df: DataFrame,
    key: str,
    ordinal: str,
    gap: str,
    base: str,
    name: str,
    unit_days: int = UNIT_DAYS,
    cumulated: str = "gap_total",
    short: bool = False,
) -> DataFrame:
    """Base date plus the running sum of gaps (months of ``unit_days``) along the ordinals.

    ``short`` states that no key has more rows than a window may hold.
    """
    if short:
        upto = _per_key(key, ordinal).rowsBetween(Window.unboundedPreceding, 0)
        total = df.withColumn(cumulated, F.sum(gap).over(upto))
    else:
        total = running_total(df, [ordinal], F.col(gap), cumulated, [key])
    return total.withColumn(name, add_days(F.col(base), F.col(cumulated) * unit_days))


def end_dates(
    df: DataFrame,
    key: str,
    ordinal: str,
    start: str,
    duration: str,
    name: str,
    unit_days: int = UNIT_DAYS,
    cumulative: bool = False,
    short: bool = False,
) -> DataFrame:
    """Start date plus the row's own duration; ``cumulative`` adds the running sum instead."""
    if cumulative:
        return cumulative_dates(df, key, ordinal, duration, start, name, unit_days, "_total", short).drop("_total")
    return df.withColumn(name, add_days(F.col(start), F.col(duration) * unit_days))


def _repaired(start_of_next: Column, end: Column, months: int, overflow: bool, strict: bool) -> Column:
    latest = add_months_overflow(start_of_next, -months) if overflow else F.add_months(start_of_next, -months)
    broken = end > latest if strict else end >= start_of_next
    return F.when(broken, latest).otherwise(end)


def repair_overlap(
    df: DataFrame,
    key: str,
    ordinal: str,
    start: str,
    end: str,
    months: int = DRY_MONTHS,
    overflow: bool = False,
    strict: bool = False,
    short: bool = False,
) -> DataFrame:
    """End ``months`` before the next start, where a row runs into the next ordinal.

    ``strict`` also widens gaps shorter than ``months``. Rows with a NULL key or ordinal
    are left as they are; of a repeated next ordinal the smallest start counts. ``short``
    states that no key has more rows than a window may hold; the next row is then read
    by a window, which shares the partitioning of the running dates, instead of by a join.
    """
    if short:
        named = F.col(key).isNotNull() & F.col(ordinal).isNotNull()
        nxt = df.withColumn("_next", F.when(named, F.min(start).over(_per_key(key, ordinal).rangeBetween(1, 1))))
    else:
        nxt = next_by_ordinal(df, key, ordinal, {"_next": start})
    return nxt.withColumn(end, _repaired(F.col("_next"), F.col(end), months, overflow, strict)).drop("_next")


def normalise_dates(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.to_date(F.col(c)) for c in columns})


def drop_future(df: DataFrame, start: str, as_of: date) -> DataFrame:
    """Leave out rows that start on or after ``as_of``; rows without a start stay."""
    return df.where(F.col(start).isNull() | (F.col(start) < F.lit(as_of)))


def censor_as_of(df: DataFrame, end: str, as_of: date) -> DataFrame:
    """NULL for ends that lie after ``as_of``: the row is still running."""
    return df.withColumn(end, F.when(F.col(end) <= F.lit(as_of), F.col(end)))
