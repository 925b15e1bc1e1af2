"""Profiles of lactation counts, gaps and durations per breed and area."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorset.config import DEFAULT_LIMITS, Limits
from mirrorset.functions.dates import months_between_trunc
from mirrorset.operators.joins import previous_by_ordinal
from mirrorset.operators.profile import Profile, profile, with_group_values
from mirrorset.operators.sequence import DEFAULT_MONTHS
from mirrorset.sources.staging import stage


def parity_profile(
    lactations: DataFrame,
    animals: DataFrame,
    key: str,
    ordinal: str,
    by: Sequence[str],
    per_row: bool = False,
    limits: Limits = DEFAULT_LIMITS,
) -> Profile:
    """Number of lactations per animal, by the columns ``by`` of ``animals``.

    Each animal counts once with its largest ordinal; ``per_row`` counts every
    lactation with its own ordinal instead, which favours low ones.
    """
    if per_row:
        counted = lactations.groupBy(key, F.col(ordinal).alias("nb_lact")).agg(F.count(F.lit(1)).alias("_n"))
    else:
        counted = lactations.groupBy(key).agg(F.max(ordinal).alias("nb_lact"), F.lit(1).alias("_n"))
    owners = animals.select(F.col(key).alias("_animal"), *by)
    joined = counted.join(owners, F.col(key) == F.col("_animal"))
    return profile(joined, "nb_lact", by, F.col("_n"), limits)


def month_counts(
    rows: DataFrame,
    months: Column,
    by: Sequence[str],
    name: str,
    default: int | None,
    limits: Limits = DEFAULT_LIMITS,
) -> Profile:
    """Profile of month counts in which a NULL count takes the group's mean, then the default.

    The mean is taken over the distinct counts of a group, each with the same weight.
    """
    counts = rows.withColumn("_m", months).groupBy(*by, "_m").agg(F.count(F.lit(1)).alias("n"))
    cells = stage(counts, "months")
    rows_staged = cells.count()
    grouped = with_group_values(cells, by, {"_mean": F.avg("_m")}, limits.small(rows_staged), limits)
    filled = [F.col("_m"), F.col("_mean").cast("int")]
    if default is not None:
        filled.append(F.lit(default))
    merged = grouped.groupBy(*by, F.coalesce(*filled).alias(name)).agg(F.sum("n").alias("n"))
    filled_cells = merged.where(F.col(name).isNotNull())
    if not limits.small(rows_staged):
        filled_cells = stage(filled_cells, "months")
    return Profile(filled_cells, tuple(by), name, rows_staged, limits)


def longest(parity: Profile) -> int:
    """The largest lactation count of the profile: no generated sequence is longer."""
    return parity.cells.agg(F.max(parity.value)).first()[0] or 1


def gap_rows(
    lactations: DataFrame,
    animals: DataFrame,
    key: str,
    ordinal: str,
    start: str,
    end: str,
    birth: str,
    by: Sequence[str],
) -> DataFrame:
    """Finished lactations with ``gap``: months since birth for the first, else since the last calving."""
    previous = previous_by_ordinal(lactations, key, ordinal, {"_previous": start})
    finished = previous.where(F.col(start).isNotNull() & F.col(end).isNotNull())
    owners = animals.select(F.col(key).alias("_animal"), *by, F.col(birth).alias("_birth"))
    since = F.when(F.col(ordinal) == 1, F.col("_birth")).otherwise(F.col("_previous"))
    joined = finished.join(owners, F.col(key) == F.col("_animal"))
    return joined.withColumn("gap", months_between_trunc(F.col(start), since))


def gap_profile(
    lactations: DataFrame,
    animals: DataFrame,
    key: str,
    ordinal: str,
    start: str,
    end: str,
    birth: str,
    by: Sequence[str],
    limits: Limits = DEFAULT_LIMITS,
) -> Profile:
    """Months from birth to first calving, then between calvings, by ``by`` and ordinal."""
    rows = gap_rows(lactations, animals, key, ordinal, start, end, birth, by)
    keys = [*by, ordinal]
    return month_counts(rows, F.col("gap"), keys, "gap", DEFAULT_MONTHS, limits)


def duration_profile(
    lactations: DataFrame,
    animals: DataFrame,
    key: str,
    ordinal: str,
    start: str,
    end: str,
    by: Sequence[str],
    limits: Limits = DEFAULT_LIMITS,
) -> Profile:
    """Months from calving to dry-off of finished lactations, by ``by`` and ordinal."""
    finished = lactations.where(F.col(start).isNotNull() & F.col(end).isNotNull())
    owners = animals.select(F.col(key).alias("_animal"), *by)
    joined = finished.join(owners, F.col(key) == F.col("_animal"))
    keys = [*by, ordinal]
    months = months_between_trunc(F.col(end), F.col(start))
    return month_counts(joined, months, keys, "duration", None, limits)
