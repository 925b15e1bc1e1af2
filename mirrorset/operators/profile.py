"""Conditional distributions of a column, as tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorset.config import DEFAULT_LIMITS, Limits
from mirrorset.operators.joins import lookup_join
from mirrorset.sources.staging import stage


@dataclass(frozen=True)
class Profile:
    """Staged counts ``(keys…, value, n)`` with their number of rows."""

    cells: DataFrame
    keys: tuple[str, ...]
    value: str
    rows: int
    limits: Limits = DEFAULT_LIMITS

    @property
    def small(self) -> bool:
        return self.limits.small(self.rows)

    def shares(self) -> DataFrame:
        """``(keys…, value, n, tot, share)`` with the share inside each key group."""
        totals = with_group_values(self.cells, self.keys, {"tot": F.sum("n")}, self.small, self.limits)
        return totals.withColumn("share", F.col("n") / F.col("tot"))


def profile(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    weight: Column | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> Profile:
    """Count the non-NULL values of a column per key group.

    Rows are counted (or ``weight`` summed) before the shuffle; the source is read
    once, and what follows works on the staged counts.
    """
    weight = F.lit(1) if weight is None else weight
    counts = (
        df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.sum(weight).cast("bigint").alias("n"))
    )
    cells = stage(counts, "profile")
    return Profile(cells, tuple(by), value, cells.count(), limits)


def with_group_values(
    cells: DataFrame,
    keys: Sequence[str],
    values: dict[str, Column],
    small: bool,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Add aggregates over each key group to every row.

    A counted, small table uses a window; a large one is aggregated and joined
    back, so that a group is never held by one task.
    """
    if small:
        group = Window.partitionBy(*keys)
        return cells.select("*", *[agg.over(group).alias(name) for name, agg in values.items()])
    names = {k: f"_g{i}" for i, k in enumerate(keys)}
    groups = cells.groupBy(*[F.col(k).alias(a) for k, a in names.items()]).agg(
        *[agg.alias(name) for name, agg in values.items()]
    )
    if not keys:
        return cells.select("*", *[groups.select(name).scalar().alias(name) for name in values])
    joined = lookup_join(cells, groups, names, "inner", False, limits, null_safe=True)
    return joined.drop(*names.values())
