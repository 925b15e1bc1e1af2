"""Draw values from a profile, with coarser profiles as fallback."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorset.config import Limits
from mirrorset.functions.draws import hash_u60, scale_u60
from mirrorset.operators.joins import all_of, lookup_join
from mirrorset.operators.keys import running_total
from mirrorset.operators.profile import Profile, with_group_values
from mirrorset.sources.staging import stage

CELL_WEIGHT = 1_000_000  # fixed value: weight of one fine cell when cells are pooled


@dataclass(frozen=True)
class TieredDistribution:
    """Staged intervals ``[lo, hi)`` of ``[0, tot)`` per tier and key group.

    Key ``i`` of the profile is column ``d_i``, NULL in tiers that do not use it.
    ``k`` is the number of values of the group and ``slots`` the number of equal
    sections of ``[0, tot)`` by which its intervals are found. ``groups`` counts the
    groups of each tier.
    """

    intervals: DataFrame
    keys: tuple[str, ...]
    tiers: tuple[tuple[str, ...], ...]
    rows: int
    groups: tuple[int, ...]
    limits: Limits

    @property
    def small(self) -> bool:
        return self.limits.small(self.rows)


def tiered_distribution(
    prof: Profile, tiers: Sequence[Sequence[str]], pool: str = "cells"
) -> TieredDistribution:
    """Distributions of the profile's value for each tier of keys.

    The tier with all keys weighs values by their counts. Coarser tiers add up the
    shares of the fine cells (``pool="cells"``, each cell weighs the same) or the
    row counts (``pool="rows"``). Cells with a NULL key are left out of the tiers
    that use it.
    """
    if pool not in ("cells", "rows"):
        raise ValueError("pool is 'cells' or 'rows'")
    totals = with_group_values(prof.cells, prof.keys, {"_tot": F.sum("n")}, prof.small, prof.limits)
    share = F.greatest(
        F.lit(1), F.expr(f"(2 * {CELL_WEIGHT}L * n + _tot) div (2 * _tot)")
    )  # rounded half up; a rare value keeps a chance

    def one_tier(number: int, used: Sequence[str]) -> Column:
        fine = set(used) == set(prof.keys)
        masked = [
            (F.col(k) if k in used else F.lit(None).cast(prof.cells.schema[k].dataType)).alias(f"d_{i}")
            for i, k in enumerate(prof.keys)
        ]
        return F.struct(
            F.lit(number).alias("tier"),
            *masked,
            (F.col("n") if fine or pool == "rows" else share).cast("bigint").alias("w"),
            all_of([F.lit(True), *[F.col(k).isNotNull() for k in used]]).alias("_usable"),
        )

    names = ["tier", *[f"d_{i}" for i in range(len(prof.keys))]]
    per_tier = totals.select(
        F.col(prof.value).alias("value"),
        F.explode(F.array(*[one_tier(t + 1, used) for t, used in enumerate(tiers)])).alias("t"),
    ).select("value", "t.*")
    weights = per_tier.where("_usable").groupBy(*names, "value").agg(F.sum("w").alias("w"))
    small = prof.limits.small(prof.rows * len(tiers))
    if not small:
        weights = stage(weights, "weights")
    sized = with_group_values(weights, names, {"tot": F.sum("w"), "k": F.count(F.lit(1))}, small, prof.limits)
    if small:
        upto = Window.partitionBy(*names).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        summed = sized.withColumn("hi", F.sum("w").over(upto))
    else:
        summed = running_total(sized, ["value"], F.col("w"), "hi", names)
    slots = F.col("k")
    if not small:  # a hot group gets more slots, in all at most ``salts`` per tier
        by_tier = weights.groupBy("tier").agg(F.sum("w").alias("w")).sort("tier").collect()
        total = F.coalesce(*[F.when(F.col("tier") == r.tier, F.lit(r.w)) for r in by_tier], F.lit(1))
        slots = slots + F.floor(F.col("tot") * F.lit(prof.limits.salts) / total)
    placed = summed.select("*", (F.col("hi") - F.col("w")).alias("lo"), slots.alias("slots")).drop("w")
    intervals = stage(placed, "distribution")
    counted = intervals.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("lo") == 0).alias("g"))
    found = {r.tier: (r.n, r.g) for r in counted.collect()}  # one row per tier
    return TieredDistribution(
        intervals,
        prof.keys,
        tuple(tuple(t) for t in tiers),
        sum(n for n, _ in found.values()),
        tuple(found.get(t, (0, 0))[1] for t in range(1, len(tiers) + 1)),
        prof.limits,
    )


def _tagged(rows: DataFrame, dist: TieredDistribution, columns: Mapping[str, str]) -> DataFrame:
    """Add ``_tier``, ``_tot`` and ``_slots`` of the first tier whose key group exists."""
    heads = dist.intervals.where(F.col("lo") == 0)
    out = rows
    for number, used in enumerate(dist.tiers, start=1):
        at = {k: dist.keys.index(k) for k in used}
        head = heads.where(F.col("tier") == number).select(
            *[F.col(f"d_{i}").alias(f"_h{number}_{i}") for i in at.values()],
            F.col("tot").alias(f"_tot{number}"),
            F.col("slots").alias(f"_slots{number}"),
        )
        if used:
            on = {columns[k]: f"_h{number}_{i}" for k, i in at.items()}
            few = dist.limits.small(dist.groups[number - 1])
            out = lookup_join(out, head, on, "left", few, dist.limits, counted=rows)
        else:  # one group, so one row: two scalar subqueries
            for c in (f"_tot{number}", f"_slots{number}"):
                out = out.withColumn(c, head.select(c).scalar())
    tags = range(1, len(dist.tiers) + 1)
    return out.select(
        *rows.columns,
        F.coalesce(*[F.when(F.col(f"_tot{t}").isNotNull(), F.lit(t)) for t in tags]).alias("_tier"),
        F.coalesce(*[F.col(f"_tot{t}") for t in tags]).alias("_tot"),
        F.coalesce(*[F.col(f"_slots{t}") for t in tags]).alias("_slots"),
    )


def tiered_lookup(rows: DataFrame, dist: TieredDistribution, columns: Mapping[str, str]) -> DataFrame:
    """Tag each row with the number ``tier`` of the first tier whose key group exists.

    ``columns`` maps the profile's keys to the columns of ``rows``. Rows that no
    tier covers, also by a NULL key, get NULL.
    """
    return _tagged(rows, dist, columns).withColumnRenamed("_tier", "tier").drop("_tot", "_slots")


def _slots(dist: TieredDistribution) -> DataFrame:
    """Intervals repeated for the slots they may touch.

    A draw's slot narrows its group to about two intervals. The bounds lean
    outwards, the exact interval test follows in the join.
    """
    width = F.col("slots") / F.col("tot")
    first = F.greatest(F.lit(0), F.floor(F.col("lo") * width - 1e-6))
    last = F.least(F.col("slots") - 1, F.floor(F.col("hi") * width + 1e-6))
    return dist.intervals.select(
        F.col("tier").alias("_in_tier"),
        *[F.col(f"d_{i}").alias(f"_d{i}") for i in range(len(dist.keys))],
        F.col("value").alias("_value"),
        F.col("lo").alias("_lo"),
        F.col("hi").alias("_hi"),
        F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))).alias("_slot"),
    )


def sample_conditional(
    rows: DataFrame,
    dist: TieredDistribution,
    columns: Mapping[str, str],
    draw: Column,
    name: str,
    default: Column | None = None,
) -> DataFrame:
    """Draw a value per row from the first tier that knows its keys, else ``default``.

    ``draw`` is a 60-bit number (see ``hash_u60``) and is mapped to the interval
    that holds ``floor(draw * tot / 2^60)``. A distribution too large to broadcast is
    joined by shuffle; the slots of a hot group then spread its rows.
    """
    tagged = _tagged(rows.withColumn("_u", draw), dist, columns)
    point = tagged.select(
        *rows.columns,
        "_tier",
        scale_u60(F.col("_u"), F.col("_tot")).alias("_x"),
        scale_u60(F.col("_u"), F.col("_slots")).alias("_s"),
        *[
            F.when(F.col("_tier").isin([t for t, used in enumerate(dist.tiers, start=1) if key in used]),
                   F.col(columns[key])).alias(f"_m{i}")
            for i, key in enumerate(dist.keys)
            if key in columns
        ],
    )
    on = [F.col("_tier") == F.col("_in_tier"), F.col("_s") == F.col("_slot")]
    on += [F.col(f"_m{i}").eqNullSafe(F.col(f"_d{i}")) for i, key in enumerate(dist.keys) if key in columns]
    on.append((F.col("_x") >= F.col("_lo")) & (F.col("_x") < F.col("_hi")))
    slots = _slots(dist)
    if not dist.small:  # rows that no tier knows would meet under NULL; they are spread by a number of their own
        free = F.xxhash64(*rows.columns)
        point = point.withColumn("_s", F.when(F.col("_tier").isNull(), free).otherwise(F.col("_s")))
        point = point.withColumn("_tier", F.coalesce("_tier", F.lit(0)))
    joined = point.join(F.broadcast(slots) if dist.small else slots, all_of(on), "left")
    value = F.col("_value") if default is None else F.coalesce(F.col("_value"), default)
    return joined.select(*rows.columns, value.alias(name))


def sample_from(
    rows: DataFrame,
    prof: Profile,
    columns: Mapping[str, str],
    draw: Column,
    name: str,
) -> DataFrame:
    """Draw from one profile, by its keys or, when it has none, for all rows alike."""
    return sample_conditional(rows, tiered_distribution(prof, [prof.keys], "rows"), columns, draw, name)


def sample_by_tiers(
    rows: DataFrame,
    prof: Profile,
    tiers: Sequence[Sequence[str]],
    columns: Mapping[str, str],
    row_keys: Sequence[str],
    name: str,
    seed: int,
    tag: str,
    default: int,
    pool: str = "cells",
    floor: int | None = None,
) -> DataFrame:
    """Draw an integer per row, with fallback tiers, a default and an optional lower bound."""
    dist = tiered_distribution(prof, tiers, pool)
    draw = hash_u60(seed, tag, *[F.col(k) for k in row_keys])
    out = sample_conditional(rows, dist, columns, draw, name, F.lit(default))
    return out if floor is None else out.withColumn(name, F.greatest(F.col(name), F.lit(floor)))


__all__ = [
    "TieredDistribution",
    "sample_by_tiers",
    "sample_conditional",
    "sample_from",
    "tiered_distribution",
    "tiered_lookup",
]
