"""Does the output follow the source, and does it hold anything real?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorset.config import DEFAULT_LIMITS, Limits
from mirrorset.operators.joins import all_of
from mirrorset.operators.keys import running_total
from mirrorset.operators.profile import with_group_values
from mirrorset.sources.staging import stage


def _moments(df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
    one_row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)],
    )
    pairs = [
        F.struct(F.lit(c).alias("measure"), F.col(f"m{i}").alias(f"{side}_mean"), F.col(f"s{i}").alias(f"{side}_sd"))
        for i, c in enumerate(columns)
    ]
    return one_row.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def fidelity(source: DataFrame, synthetic: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and standard deviation of each column in both tables, one scan each."""
    return _moments(source, columns, "source").join(_moments(synthetic, columns, "synthetic"), "measure")


def _shares(df: DataFrame, column: str, side: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).select("t").scalar()
    return counts.select("value", (F.col("n") / total).alias(f"{side}_share"))


def share_drift(source: DataFrame, synthetic: DataFrame, column: str) -> DataFrame:
    """Share of each value in both tables and the absolute difference."""
    both = _shares(source, column, "source").join(_shares(synthetic, column, "synthetic"), "value", "full")
    filled = both.fillna(0.0, ["source_share", "synthetic_share"])
    return filled.withColumn("drift", F.abs(F.col("source_share") - F.col("synthetic_share")))


def shared_rows(source: DataFrame, synthetic: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``n_shared``: synthetic rows whose values of ``columns`` also occur in the source.

    Both sides are grouped before they meet.
    """
    mine = synthetic.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    theirs = source.select(*[F.col(c).alias(f"_s_{c}") for c in columns]).distinct()
    on = all_of([F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in columns])
    found = mine.join(theirs, on, "left_semi")
    return found.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_shared"))


def anonymity(
    source: DataFrame, synthetic: DataFrame, keys: Sequence[str], quasi_identifiers: Sequence[str]
) -> DataFrame:
    """One row: shared keys, rows with a shared quasi-identifier, number and smallest size of its groups.

    The synthetic side is read once: what is asked of it are its columns, staged.
    """
    synthetic = stage(synthetic.select(*dict.fromkeys([*keys, *quasi_identifiers])), "synthetic")
    groups = synthetic.groupBy(*quasi_identifiers).agg(F.count(F.lit(1)).alias("n"))
    sizes = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_groups"),
        F.min("n").alias("smallest_group"),
    )
    return sizes.select(
        "n_rows",
        shared_rows(source, synthetic, keys).scalar().alias("shared_keys"),
        shared_rows(source, synthetic, quasi_identifiers).scalar().alias("shared_rows"),
        "n_groups",
        "smallest_group",
    )


def group_size_distribution(df: DataFrame, key: str) -> DataFrame:
    """How many keys have how many rows: ``(n_rows, n_keys)``."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return sizes.groupBy("n_rows").agg(F.count(F.lit(1)).alias("n_keys"))


def histogram(df: DataFrame, value: str, width: float) -> DataFrame:
    """Counts per bin of the given width: ``(bin, n)`` with the bin's lower end."""
    lower = (F.floor(F.col(value) / F.lit(width)) * F.lit(width)).alias("bin")
    return df.where(F.col(value).isNotNull()).groupBy(lower).agg(F.count(F.lit(1)).alias("n"))


def ks_distance(source: DataFrame, synthetic: DataFrame, column: str, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """One row: the largest distance between the two cumulative distributions, and the least value where it is reached.

    Both sides are counted by value first, so a value that many rows share is one row; the counts are then
    added up in ranges of the values. NULLs are left out; without rows on either side the distance is NULL.
    """
    sides = [df.where(F.col(column).isNotNull()).select(F.col(column).alias("value")) for df in (source, synthetic)]
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = sides[0].select("value", one.alias("a"), none.alias("b")).unionByName(
        sides[1].select("value", none.alias("a"), one.alias("b"))
    )
    counts = stage(both.groupBy("value").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "values")
    rows = counts.count()
    summed = running_total(counts, ["value"], F.col("a"), "upto_a", (), rows, limits)
    summed = running_total(summed, ["value"], F.col("b"), "upto_b", (), rows, limits)
    totals = counts.agg(F.coalesce(F.sum("a"), none).alias("a"), F.coalesce(F.sum("b"), none).alias("b"))
    n_a, n_b = totals.select("a").scalar(), totals.select("b").scalar()
    gap = F.abs(F.try_divide(F.col("upto_a").cast("double"), n_a) - F.try_divide(F.col("upto_b").cast("double"), n_b))
    far = summed.select("value", gap.alias("gap"), n_a.alias("n_source"), n_b.alias("n_synthetic"))
    return far.agg(
        F.lit(column).alias("measure"),
        F.coalesce(F.max("n_source"), none).alias("n_source"),
        F.coalesce(F.max("n_synthetic"), none).alias("n_synthetic"),
        F.max("gap").alias("distance"),
        F.min_by("value", F.struct(-F.col("gap"), "value")).alias("at_value"),
    )


def _information(df: DataFrame, first: str, second: str, limits: Limits) -> tuple[DataFrame, DataFrame]:
    """Shares ``p`` of the pairs of values that occur, and one row: their mutual information in nats."""
    cells = df.groupBy(F.col(first).alias("v1"), F.col(second).alias("v2")).agg(F.count(F.lit(1)).alias("n"))
    cells = stage(cells, "cells")
    small = limits.small(cells.count())
    margins = with_group_values(cells, ["v1"], {"n1": F.sum("n")}, small, limits)
    margins = with_group_values(margins, ["v2"], {"n2": F.sum("n")}, small, limits)
    total = cells.agg(F.sum("n").cast("double").alias("t")).scalar()
    n, n1, n2 = (F.col(c).cast("double") for c in ("n", "n1", "n2"))
    information = margins.agg(F.sum(n / total * F.ln(n * total / (n1 * n2))).alias("information"))
    return cells.select("v1", "v2", (n / total).alias("p")), information


def pair_drift(
    source: DataFrame, synthetic: DataFrame, first: str, second: str, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """One row: how much two columns tell about each other in both tables, and how far their joint shares lie apart.

    ``distance`` is half the sum of the absolute differences of the shares of all pairs of values, NULL being a value.
    """
    mine, told = _information(source, first, second, limits)
    theirs, told_too = _information(synthetic, first, second, limits)
    a = mine.select(F.col("v1"), F.col("v2"), F.col("p").alias("pa"))
    b = theirs.select(F.col("v1").alias("_v1"), F.col("v2").alias("_v2"), F.col("p").alias("pb"))
    same = F.col("v1").eqNullSafe(F.col("_v1")) & F.col("v2").eqNullSafe(F.col("_v2"))
    zero = F.lit(0.0)
    gap = F.sum(F.abs(F.coalesce("pa", zero) - F.coalesce("pb", zero))) / 2
    return a.join(b, same, "full").agg(
        F.lit(f"{first}, {second}").alias("pair"),
        told.scalar().alias("source_information"),
        told_too.scalar().alias("synthetic_information"),
        gap.alias("distance"),
    )
