"""New parents, and cohorts of members cloned onto them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorset.config import DEFAULT_LIMITS, Limits
from mirrorset.functions.codes import area_of
from mirrorset.functions.draws import bernoulli, hash_u60, scale_u60, uniform_int
from mirrorset.operators.joins import lookup_join
from mirrorset.operators.keys import dense_index, feistel_key, group_rank, running_total, surrogate_key
from mirrorset.operators.profile import Profile
from mirrorset.operators.sample import sample_from
from mirrorset.sources.staging import stage

# Fixed values of the data model.
EXIT_FARM = 111_111
FARM_START = 200_000
ANIMAL_LOW, ANIMAL_HIGH = 13_665_449, 19_639_291
SIRE_LOW, SIRE_HIGH = 99_000_000, 99_999_999
DAM_KNOWN = 0.8


def generate_entities(
    spark: SparkSession,
    n: int,
    prof: Profile,
    seed: int,
    id_column: str,
    value_column: str,
    start: int = FARM_START,
    max_n: int | None = None,
) -> DataFrame:
    """``n`` new entities with consecutive ids and a value drawn from a profile."""
    if n < 1 or (max_n is not None and n > max_n):
        raise ValueError(f"number of entities must be from 1 to {max_n}")
    ids = spark.range(start, start + n).withColumnRenamed("id", id_column)
    return sample_from(ids, prof, {}, hash_u60(seed, "entity", F.col(id_column)), value_column)


def with_area(df: DataFrame, postcode: str, area: str = "area", size: int = 100) -> DataFrame:
    """Add the area and leave out rows without an address or with area 0 (unknown)."""
    return df.where(F.col(postcode) != 0).withColumn(area, area_of(F.col(postcode), size)).where(F.col(area) != 0)


def herds(
    members: DataFrame,
    farms: DataFrame,
    farm_key: str,
    farm_id: str,
    area: str,
    exit_farm: int | None = EXIT_FARM,
) -> DataFrame:
    """``(area, herd, n_members)``: the members kept on each source farm, per area.

    Members are counted per farm before the join with the farms.
    """
    counted = members.groupBy(F.col(farm_key).alias("herd")).agg(F.count(F.lit(1)).alias("n_members"))
    if exit_farm is not None:
        counted = counted.where(F.col("herd") != exit_farm)
    places = farms.select(F.col(farm_id).alias("_farm"), F.col(area).alias("area"))
    return counted.join(places, F.col("herd") == F.col("_farm")).select("area", "herd", "n_members")


def herd_slots(herds_: DataFrame, most: int | None = None, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Number the herds of each area from 1, in the order of their ids; ``most`` bounds their number."""
    return group_rank(herds_, ["area"], ["herd"], "slot", most, limits)


def assign_cohorts(
    targets: DataFrame,
    herds_: DataFrame,
    target_id: str,
    area: str,
    seed: int,
    n_targets: int | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Give each target a herd of its own area, or any herd where the area has none.

    Herds and targets are shuffled by hash inside the area and matched by position;
    when targets outnumber herds the herds go round again. Returns
    ``(target_id, area, herd, n_members)``. ``n_targets`` is the number of targets,
    if known.
    """
    mixed_herds = stage(herds_.withColumn("_u", hash_u60(seed, "herd", F.col("herd"))), "herds")
    n_herds = mixed_herds.count()
    small = limits.small(n_herds)
    placed_herds = mixed_herds.where(F.col("area").isNotNull())
    local = group_rank(placed_herds, ["area"], ["_u", "herd"], "_r", n_herds, limits)
    no_area = mixed_herds.withColumn("area", F.lit(None).cast(herds_.schema["area"].dataType))
    everywhere = dense_index(no_area, ["_u", "herd"], 1, "_r", n_herds, limits)
    slots = local.unionByName(everywhere).drop("_u")
    sizes = placed_herds.groupBy(F.col("area").alias("_a")).agg(F.count(F.lit(1)).alias("_n"))

    mixed = targets.withColumn("_u", hash_u60(seed, "target", F.col(target_id)))
    ranked = group_rank(mixed, [area], ["_u", target_id], "_rank", n_targets, limits).drop("_u")
    known = lookup_join(ranked, sizes, {area: "_a"}, "left", small, limits, counted=targets)
    turned = scale_u60(hash_u60(seed, "pool", F.col(area)), n_herds)  # areas without herds start anywhere
    in_pool = (F.col("_rank") - 1 + turned) % max(n_herds, 1)
    placed = known.select(
        *[F.col(c) for c in targets.columns],
        F.when(F.col("_n").isNotNull(), F.col(area)).alias("_area"),
        F.when(F.col("_n").isNotNull(), (F.col("_rank") - 1) % F.col("_n")).otherwise(in_pool).alias("_slot"),
    )
    chosen = slots.select(
        F.col("area").alias("_herd_area"), "herd", "n_members", (F.col("_r") - 1).alias("_herd_slot")
    )
    if small:
        on = F.col("_area").eqNullSafe(F.col("_herd_area")) & (F.col("_slot") == F.col("_herd_slot"))
        joined = placed.join(F.broadcast(chosen), on)
    else:
        placed = stage(placed, "placed")
        keys = {"_area": "_herd_area", "_slot": "_herd_slot"}
        joined = lookup_join(placed, chosen, keys, "inner", False, limits, null_safe=True)
    return joined.select(*targets.columns, "herd", "n_members")


def clone_members(
    assigned: DataFrame,
    members: DataFrame,
    target_id: str,
    member_id: str,
    member_farm: str,
    n_targets: int | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Every member of a target's herd, copied to the target, with a dense index from 0.

    The index is the target's offset plus the member's rank in its herd, so the
    clones, the largest table here, are not sorted. Adds ``target_id`` and ``idx``
    to the columns of ``members``. Without ``n_targets``, a bound on their number,
    ``assigned`` is staged and counted.
    """
    assigned = assigned.select(target_id, "herd", "n_members")
    if n_targets is None:
        assigned = stage(assigned, "targets")
        n_targets = assigned.count()
    small = limits.small(n_targets)
    summed = running_total(assigned, [target_id], F.col("n_members"), "_end", (), n_targets, limits)
    offsets = summed.select(
        target_id, F.col("herd").alias("_herd"), "n_members", (F.col("_end") - F.col("n_members")).alias("_start")
    )
    drawn = offsets.select(F.col("_herd").alias("_drawn")).distinct()
    wanted = members.join(F.broadcast(drawn) if small else drawn, F.col(member_farm) == F.col("_drawn"), "left_semi")
    ranked = group_rank(wanted, [member_farm], [member_id], "_rank", None, limits)  # herds nobody drew are not ranked
    joined = lookup_join(ranked, offsets, {member_farm: "_herd"}, "inner", small, limits, counted=wanted)
    return joined.select(
        *members.columns, target_id, (F.col("_start") + F.col("_rank") - 1).alias("idx")
    )


def pedigree(
    clones: DataFrame,
    total: Column,
    seed: int,
    names: Mapping[str, str] | None = None,
    low: int = ANIMAL_LOW,
    high: int = ANIMAL_HIGH,
    dam_known: float = DAM_KNOWN,
    no_self: bool = False,
    secret: str | None = None,
) -> DataFrame:
    """Add a new unique id, a sire code and a dam to rows with a dense index ``idx``.

    The dam is another row of the table: its index is drawn and turned into its id
    by the same permutation that made the ids, so no join is needed. ``no_self``
    keeps an animal from being its own dam. With a ``secret``, ids cannot be traced back to
    the order of the rows from a few known pairs.
    """

    def new_id(at: Column) -> Column:
        return surrogate_key(at, low, high, seed) if secret is None else feistel_key(at, low, high, secret)

    names = {"id": "noan", "sire": "noanpere", "dam": "noanmere", **(names or {})}
    idx = F.col("idx")
    u = hash_u60(seed, "dam", idx)
    total = total.cast("bigint")
    if no_self:
        dam_idx = F.when(total > 1, (idx + 1 + scale_u60(u, total - 1)) % total)
    else:
        dam_idx = scale_u60(u, total)
    known = bernoulli(hash_u60(seed, "dam known", idx), dam_known)
    return (
        clones.withColumn(names["id"], new_id(idx))
        .withColumn(names["sire"], uniform_int(hash_u60(seed, "sire", idx), SIRE_LOW, SIRE_HIGH))
        .withColumn(names["dam"], F.when(known, new_id(dam_idx)))
    )


def jittered(day: Column, days: int, seed: int, key: Column) -> Column:
    """The date moved by up to ``days`` either way, so that it is not a real one."""
    return F.date_add(day, uniform_int(hash_u60(seed, "jitter", key), -days, days).cast("int"))
