"""Joins used by the other operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorset.config import DEFAULT_LIMITS, Limits


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    how: str,
    small: bool,
    limits: Limits = DEFAULT_LIMITS,
    null_safe: bool = False,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join many rows to a lookup table; ``on`` maps columns of ``rows`` to those of ``lookup``.

    ``small`` states that the lookup was counted and fits ``limits``: it is then
    broadcast. Otherwise the rows are counted by key, whether the lookup knows it or
    not, and NULL like any other key. Fewer than ``limits.salts`` keys are hot; they
    are broadcast to give their rows a salt, and their lookup rows are repeated per
    salt. All other keys are joined as they are. ``counted`` may name an earlier form
    of ``rows`` with the same keys, which is cheaper to count. The rows of a stream cannot be
    counted before; its batches are joined as they are.
    """

    def matching(columns: Mapping[str, str], safe: bool) -> list[Column]:
        pairs = [(F.col(mine), F.col(theirs)) for mine, theirs in columns.items()]
        return [a.eqNullSafe(b) if safe else a == b for a, b in pairs]

    if small:
        return rows.join(F.broadcast(lookup), all_of(matching(on, null_safe)), how)
    if rows.isStreaming:
        return rows.join(lookup, all_of(matching(on, null_safe)), how)
    source = rows if counted is None else counted
    names = {mine: f"_hot{i}" for i, mine in enumerate(on)}
    per_key = source.groupBy(*[F.col(mine).alias(hot) for mine, hot in names.items()]).agg(F.count(F.lit(1)).alias("_c"))
    total = source.agg(F.count(F.lit(1)).alias("t")).scalar()
    salts = F.ceil(F.col("_c") * F.lit(limits.salts) / total)
    hot = per_key.select(*names.values(), salts.alias("_salts")).where(F.col("_salts") > 1)
    spread = rows.join(F.broadcast(hot), all_of(matching(names, True)), "left").select(
        *rows.columns,
        F.pmod(F.xxhash64(*rows.columns), F.coalesce("_salts", F.lit(1))).alias("_salt"),
    )
    theirs = {other: names[mine] for mine, other in on.items()}
    repeated = (
        lookup.join(F.broadcast(hot), all_of(matching(theirs, True)), "left")
        .withColumn("_lookup_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts", *names.values())
    )
    same = all_of([*matching(on, null_safe), F.col("_salt") == F.col("_lookup_salt")])
    return spread.join(repeated, same, how).drop("_salt", "_lookup_salt")


def replace_column(df: DataFrame, updates: DataFrame, on: str, column: str, keep_old: bool = False) -> DataFrame:
    """``column`` taken from ``updates`` by key; unmatched rows get NULL, or the old value.

    ``updates`` has one row per key. The new column goes to the end.
    """
    new = updates.select(F.col(on).alias("_on"), F.col(column).alias("_new"))
    joined = df.join(new, F.col(on) == F.col("_on"), "left")
    value = F.coalesce("_new", column) if keep_old and column in df.columns else F.col("_new")
    rest = [c for c in df.columns if c != column]
    return joined.select(*rest, value.alias(column))


def select_first(df: DataFrame, *first: str) -> DataFrame:
    """The named columns in front, the rest in their old order."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def _by_ordinal(
    df: DataFrame, key: str, ordinal: str, columns: Mapping[str, str], step: int, pick
) -> DataFrame:
    other = (
        df.where(F.col(key).isNotNull() & F.col(ordinal).isNotNull())
        .groupBy(F.col(key).alias("_key"), (F.col(ordinal) - step).alias("_ordinal"))
        .agg(*[pick(src).alias(name) for name, src in columns.items()])
    )
    on = (F.col(key) == F.col("_key")) & (F.col(ordinal) == F.col("_ordinal"))
    return df.join(other, on, "left").drop("_key", "_ordinal")


def previous_by_ordinal(df: DataFrame, key: str, ordinal: str, columns: Mapping[str, str]) -> DataFrame:
    """Values of the row with the previous ordinal of the same key, NULL across a gap.

    Joined on (key, ordinal) rather than taken by a window over the key, so that a
    key with very many rows is spread by ordinal. Should an ordinal occur twice,
    the largest value counts (``check_unique`` reports such rows).
    """
    return _by_ordinal(df, key, ordinal, columns, -1, F.max)


def next_by_ordinal(df: DataFrame, key: str, ordinal: str, columns: Mapping[str, str]) -> DataFrame:
    """Values of the row with the next ordinal, NULL across a gap; the smallest of repeats."""
    return _by_ordinal(df, key, ordinal, columns, 1, F.min)


def missing_values(dictionary: DataFrame, observed: DataFrame, column: str, observed_column: str) -> DataFrame:
    """Dictionary values that do not occur in the data."""
    seen = observed.select(F.col(observed_column).alias("_seen")).distinct()
    return dictionary.select(column).distinct().join(seen, F.col(column) == F.col("_seen"), "left_anti")


def keyed_or_pool(rows: DataFrame, lookup: DataFrame, key: str, lookup_key: str, value: str, pool: Column) -> DataFrame:
    """``value`` looked up by key, or ``pool`` for rows whose key is unknown.

    ``lookup`` has one row per key.
    """
    found = lookup.select(F.col(lookup_key).alias("_k"), F.col(value).alias("_v"), F.lit(True).alias("_hit"))
    joined = rows.join(found, F.col(key) == F.col("_k"), "left")
    picked = F.when(F.col("_hit"), F.col("_v")).otherwise(pool)
    return joined.withColumn(value, picked).drop("_k", "_v", "_hit")
