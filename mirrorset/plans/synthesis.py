"""The whole run: eight source tables in, eight synthetic tables out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorset.config import DEFAULT_LIMITS, Limits
from mirrorset.functions.codes import area_of, canonical_code
from mirrorset.functions.dates import parse_yyyymmdd
from mirrorset.operators import calendar as cal
from mirrorset.operators import cohort, lactation, model, sequence
from mirrorset.operators.profile import profile
from mirrorset.operators.sample import sample_by_tiers
from mirrorset.schema import SCHEMAS, enforce_schema
from mirrorset.sources.staging import stage

DICTIONARIES = ("AIDACTIEL", "CL_AIDE_ETAPE_CTRL", "CL_AIDE_TYPE_CTRL")
GAP_TIERS = (("ACTIEL", "area", "NOLACT"), ("ACTIEL", "area"), ("ACTIEL",))
PARITY_TIERS = (("area", "ACTIEL"), ("ACTIEL",), ("area",))


@dataclass(frozen=True)
class Settings:
    """Parameters of a run. The flags after ``pool`` bring back rules of the original
    that its own description contradicts."""

    as_of: date
    n_farms: int = 600
    max_farms: int | None = None
    seed: int = 42
    unit_days: int = sequence.UNIT_DAYS
    pool: str = "cells"
    parity_per_row: bool = False
    type_filter_first: bool = True
    cumulative_durations: bool = False
    overflow_months: bool = False
    strict_gap: bool = False
    no_self_dam: bool = False
    jitter_days: int = 0
    boosting: model.Boosting = field(default_factory=model.Boosting)
    limits: Limits = DEFAULT_LIMITS
    secret: str | None = None
    animal_ids: tuple[int, int] = (cohort.ANIMAL_LOW, cohort.ANIMAL_HIGH)


def _clean_source(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Declared types and canonical breed codes, before anything is copied."""
    typed = dict(tables)
    for name in ("AIDACTIEL", "IDENTANV"):
        typed[name] = tables[name].withColumn("ACTIEL", canonical_code(F.col("ACTIEL")))
    for name in ("AIDACTIEL", "EXPLOITATION", "IDENTANV", "CL_LAITEXPL", "CL_LAITLACT"):
        typed[name] = enforce_schema(typed[name], SCHEMAS[name])
    return typed


def make_farms(spark: SparkSession, src: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    areas = profile(cohort.with_area(src["EXPLOITATION"], "CODPOST"), "area", limits=s.limits)
    return cohort.generate_entities(
        spark, s.n_farms, areas, s.seed, "NOINTEXPL", "CODPOST", max_n=s.max_farms
    )


def make_animals(src: Mapping[str, DataFrame], farms: DataFrame, s: Settings) -> DataFrame:
    places = cohort.with_area(src["EXPLOITATION"], "CODPOST")
    source_herds = cohort.herds(src["IDENTANV"], places, "NOINTSANIT", "NOINTEXPL", "area")
    addressed = farms.where(F.col("CODPOST") != 0)
    assigned = stage(
        cohort.assign_cohorts(addressed, source_herds, "NOINTEXPL", "CODPOST", s.seed, s.n_farms, s.limits),
        "assigned",
    )
    kept = src["IDENTANV"].where(F.col("NOINTSANIT") != cohort.EXIT_FARM)
    members = kept.select("NOAN", "DTNAISANINV", "NOINTSANIT", "ACTIEL")
    clones = cohort.clone_members(assigned, members, "NOINTEXPL", "NOAN", "NOINTSANIT", s.n_farms, s.limits)
    total = assigned.agg(F.sum("n_members").alias("n")).scalar()
    new = cohort.pedigree(
        clones.drop("NOAN", "NOINTSANIT"),
        total,
        s.seed,
        {"id": "NOAN", "sire": "NOANPERE", "dam": "NOANMERE"},
        *s.animal_ids,
        no_self=s.no_self_dam,
        secret=s.secret,
    )
    if s.jitter_days:
        moved = cohort.jittered(parse_yyyymmdd(F.col("DTNAISANINV")), s.jitter_days, s.seed, F.col("idx"))
        new = new.withColumn("DTNAISANINV", F.date_format(moved, "yyyyMMdd"))
    return enforce_schema(
        new.withColumn("SEXEAN", F.lit("F")).withColumnRenamed("NOINTEXPL", "NOINTSANIT"), SCHEMAS["IDENTANV"]
    )


def make_visits(src: Mapping[str, DataFrame], farms: DataFrame, s: Settings) -> DataFrame:
    source = src["CL_LAITEXPL"]
    typed = cal.control_types(
        farms.select("NOINTEXPL"), source, "NOINTEXPL", "NOINTEXPL", "CD_TYPE_CTRL",
        ["DATE_CTRL", "ID_LAITEXPL"], s.seed, filter_first=s.type_filter_first, name="CD_TYPE_CTRL",
    )
    plan = cal.visit_plan(typed, "NOINTEXPL", s.as_of, cal.step_days(F.col("CD_TYPE_CTRL")), s.seed)
    numbered = cal.visit_ids(plan, "NOINTEXPL", name="ID_LAITEXPL", n_farms=s.n_farms, limits=s.limits)
    visits = numbered.withColumnRenamed("visit_date", "DATE_CTRL")
    stepped = cal.control_steps(visits, source, "CD_ETAPE_CTRL", ["NOINTEXPL", "pos"], s.seed, "CD_ETAPE_CTRL")
    dated = cal.lab_dates(
        stepped, "DATE_CTRL", cal.mean_lag(source, "DATE_CTRL", "DATE_RECEPT_ANALYSE"), "DATE_RECEPT_ANALYSE"
    )
    slotted = cal.slots(dated, source, "CD_TYPE_CTRL", "TRAIT1", "CD_TYPE_CTRL", "NOINTEXPL", s.seed, name="TRAIT1")
    return enforce_schema(slotted, SCHEMAS["CL_LAITEXPL"])


def source_animals(src: Mapping[str, DataFrame]) -> DataFrame:
    """Animals on a farm, with its area, whose breed is in the dictionary."""
    farms = src["EXPLOITATION"].select("NOINTEXPL", area_of(F.col("CODPOST")).alias("area"))
    breeds = src["AIDACTIEL"].select("ACTIEL").distinct()
    return (
        src["IDENTANV"]
        .where(F.col("NOINTSANIT") != cohort.EXIT_FARM)
        .join(farms, F.col("NOINTSANIT") == F.col("NOINTEXPL"))
        .join(breeds, "ACTIEL", "left_semi")
        .select("NOAN", "ACTIEL", "area", parse_yyyymmdd(F.col("DTNAISANINV")).alias("birth"))
    )


def make_lactations(
    src: Mapping[str, DataFrame], farms: DataFrame, animals: DataFrame, s: Settings
) -> DataFrame:
    known = stage(source_animals(src), "source-animals")
    source = src["CL_LAITLACT"].select("NOAN", "NOLACT", "DATE_VEL", "DATE_TAR")
    parity = lactation.parity_profile(source, known, "NOAN", "NOLACT", ["area", "ACTIEL"], s.parity_per_row, s.limits)
    gaps = lactation.gap_profile(
        source, known, "NOAN", "NOLACT", "DATE_VEL", "DATE_TAR", "birth", ["ACTIEL", "area"], s.limits
    )
    durations = lactation.duration_profile(
        source, known, "NOAN", "NOLACT", "DATE_VEL", "DATE_TAR", ["ACTIEL", "area"], s.limits
    )
    short = s.limits.short(lactation.longest(parity))
    own = {"ACTIEL": "ACTIEL", "area": "area", "NOLACT": "NOLACT"}
    places = farms.select("NOINTEXPL", F.col("CODPOST").alias("area"))
    cows = animals.join(places, F.col("NOINTSANIT") == F.col("NOINTEXPL")).select(
        "NOAN", "ACTIEL", "area", parse_yyyymmdd(F.col("DTNAISANINV")).alias("birth")
    )
    counted = sample_by_tiers(
        cows, parity, PARITY_TIERS, own, ["NOAN"], "nb_lact", s.seed, "parity", 1, s.pool
    )
    rows = sequence.explode_counter(counted, "NOAN", "nb_lact", "NOLACT", "ID_LAITLACT")
    row_key = ["NOAN", "NOLACT"]
    spaced = sample_by_tiers(
        rows, gaps, GAP_TIERS, own, row_key, "gap", s.seed, "gap", sequence.DEFAULT_MONTHS, s.pool
    )
    started = sequence.cumulative_dates(spaced, "NOAN", "NOLACT", "gap", "birth", "DATE_VEL", s.unit_days, short=short)
    lasting = sample_by_tiers(
        started, durations, GAP_TIERS, own, row_key, "duration", s.seed, "duration",
        sequence.DEFAULT_MONTHS, s.pool, sequence.SHORTEST_MONTHS,
    )
    ended = sequence.end_dates(
        lasting, "NOAN", "NOLACT", "DATE_VEL", "duration", "DATE_TAR", s.unit_days, s.cumulative_durations, short
    )
    repaired = sequence.repair_overlap(
        ended, "NOAN", "NOLACT", "DATE_VEL", "DATE_TAR",
        overflow=s.overflow_months, strict=s.strict_gap, short=short,
    )
    kept = sequence.drop_future(sequence.normalise_dates(repaired, "DATE_VEL", "DATE_TAR"), "DATE_VEL", s.as_of)
    return sequence.censor_as_of(kept, "DATE_TAR", s.as_of).select(
        "ID_LAITLACT", "NOAN", "NOLACT", "DATE_VEL", "DATE_TAR", "ACTIEL"
    )


def add_measures(
    src: Mapping[str, DataFrame], lactations: DataFrame, s: Settings
) -> tuple[DataFrame, DataFrame]:
    """Predicted measures for every lactation, and the R² of the models."""
    measures = ["MG", "PROT", "PIC", "PERSISTANCE"]
    train = model.training_set(
        src["CL_LAITLACT"], src["IDENTANV"], "NOAN", "ACTIEL", "ID_LAITLACT", "NOLACT",
        "DATE_VEL", "DATE_TAR", "LAIT", measures,
    )
    numeric = [c.name for c in model.CHAIN]
    train = stage(train.select(*[c for c in train.columns if c.lower() not in numeric],
                               *[F.col(c).cast("double").alias(c) for c in numeric]), "training")
    codes = model.code_index(src["AIDACTIEL"], "ACTIEL", s.limits)
    chain = model.fit_chain(train, codes, s.boosting)
    features = lactations.select(
        F.col("ID_LAITLACT").alias("id"),
        F.col("NOLACT").alias("nolact"),
        F.col("ACTIEL").alias("code"),
        F.month("DATE_VEL").alias("month"),
        F.datediff(F.coalesce("DATE_TAR", F.lit(s.as_of)), "DATE_VEL").alias("duration"),
        "NOAN",
        "DATE_VEL",
        "DATE_TAR",
    )
    scored = model.score_chain(features, chain)  # rows keep their own columns: no join back is needed
    return (
        enforce_schema(scored.withColumnRenamed("id", "ID_LAITLACT"), SCHEMAS["CL_LAITLACT"]),
        chain.metrics,
    )


def synthesize(spark: SparkSession, tables: Mapping[str, DataFrame], settings: Settings) -> dict[str, DataFrame]:
    """Synthetic tables by name, plus ``metrics`` with the R² of the models.

    Farms, animals and lactations are staged because several later steps read them.
    """
    src = _clean_source(tables)
    out = {name: src[name] for name in DICTIONARIES}
    out["EXPLOITATION"] = stage(make_farms(spark, src, settings), "farms")
    out["IDENTANV"] = stage(make_animals(src, out["EXPLOITATION"], settings), "animals")
    out["CL_LAITEXPL"] = make_visits(src, out["EXPLOITATION"], settings)
    dated = stage(make_lactations(src, out["EXPLOITATION"], out["IDENTANV"], settings), "lactations")
    out["CL_LAITLACT"], out["metrics"] = add_measures(src, dated, settings)
    out["CL_LAITCTRL"] = spark.createDataFrame([], SCHEMAS["CL_LAITCTRL"])
    return out
