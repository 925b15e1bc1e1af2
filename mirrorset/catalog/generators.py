"""Farms, herds, clones, visits and lactation sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorset.catalog.registry import query
from mirrorset.catalog.roles import (
    ANIMALS,
    AS_OF,
    EXIT,
    FARMS,
    LACTATIONS,
    SEED,
    VISITS,
    animals,
    farms,
    hash_sql,
    lactations,
    months_sql,
    scale_sql,
    table,
    visits,
)
from mirrorset.catalog.sampling import sample_sql
from mirrorset.functions.draws import TWO60
from mirrorset.operators import calendar as cal
from mirrorset.operators import cohort, keys, lactation, sequence
from mirrorset.operators.profile import Profile, profile
from mirrorset.operators.sample import sample_by_tiers
from mirrorset.sources.staging import stage

# Farms: as many as there are suppliers, drawn from the areas of the real ones.
_PLACES = f"{FARMS}, places AS (SELECT farm, CAST((postcode // 100) * 100 AS INTEGER) AS area FROM farms WHERE postcode >= 100)"
_NEW_FARMS = (
    f"{_PLACES}, area_cells AS (SELECT area AS value, count(*) AS n FROM places GROUP BY ALL), "
    "ids AS (SELECT 200000 + row_number() OVER (ORDER BY s_suppkey) - 1 AS new_farm FROM supplier), "
    + sample_sql("new_farms", "area_cells", [], [[]], "rows", "ids", {}, hash_sql("entity", "r.new_farm"), "area")
)


def _places(spark: SparkSession, sf: str) -> DataFrame:
    return cohort.with_area(farms(spark, sf), "postcode").select("farm", "area")


def _n_farms(spark: SparkSession, sf: str) -> int:
    return table(spark, sf, "supplier").count()


def _new_farms(spark: SparkSession, sf: str) -> DataFrame:
    n = _n_farms(spark, sf)
    return cohort.generate_entities(spark, n, profile(_places(spark, sf), "area"), SEED, "new_farm", "area")


@query(f"WITH {_NEW_FARMS} SELECT new_farm, area FROM new_farms")
def generate_farms(spark: SparkSession, sf: str) -> DataFrame:
    return _new_farms(spark, sf)


_HERDS = (
    f"{ANIMALS}, herds AS (SELECT area, a.farm AS herd, n_members FROM (SELECT farm, count(*) AS n_members FROM animals "
    f"WHERE farm <> {EXIT} GROUP BY farm) a JOIN places p ON a.farm = p.farm)"
)


def _herds(spark: SparkSession, sf: str) -> DataFrame:
    return cohort.herds(animals(spark, sf), _places(spark, sf), "farm", "farm", "area", EXIT)


@query(
    f"WITH {_PLACES}, {_HERDS} SELECT area, herd, n_members, "
    "row_number() OVER (PARTITION BY area ORDER BY herd) AS slot FROM herds"
)
def herd_profile(spark: SparkSession, sf: str) -> DataFrame:
    return cohort.herd_slots(_herds(spark, sf), _n_farms(spark, sf))


# Beside the new farms, one per nation in an area without herds, which must take one from the pool of all herds.
_HAVE, _ALL_HERDS = "herds", "(SELECT count(*) FROM herds)"
_FAR_TARGETS = " UNION ALL SELECT 900000000 + n_nationkey, CAST(900000000 + 100 * n_nationkey AS INTEGER) FROM nation"
_ASSIGNED = f"""{_NEW_FARMS}, {_HERDS},
targets AS (SELECT new_farm, area FROM new_farms{_FAR_TARGETS}),
local_herds AS (SELECT *, row_number() OVER (PARTITION BY area ORDER BY {hash_sql('herd', 'herd')}, herd) - 1 AS slot FROM {_HAVE}),
pool_herds AS (SELECT *, row_number() OVER (ORDER BY {hash_sql('herd', 'herd')}, herd) - 1 AS slot FROM {_HAVE}),
ranked AS (SELECT new_farm, area, row_number() OVER (PARTITION BY area ORDER BY {hash_sql('target', 'new_farm')}, new_farm) - 1 AS r FROM targets),
sized AS (SELECT r.*, s.n FROM ranked r LEFT JOIN (SELECT area, count(*) AS n FROM local_herds GROUP BY area) s ON r.area = s.area),
assigned AS (SELECT s.new_farm, s.area, h.herd, h.n_members FROM sized s JOIN local_herds h ON s.area = h.area AND s.r % s.n = h.slot
  UNION ALL SELECT s.new_farm, s.area, h.herd, h.n_members FROM sized s JOIN pool_herds h ON s.n IS NULL
  AND (s.r + {scale_sql(hash_sql('pool', 's.area'), _ALL_HERDS)}) % {_ALL_HERDS} = h.slot)"""


def _assigned(spark: SparkSession, sf: str) -> DataFrame:
    far = table(spark, sf, "nation").select(
        (F.col("n_nationkey") + 900_000_000).cast("bigint").alias("new_farm"),
        (F.col("n_nationkey") * 100 + 900_000_000).cast("int").alias("area"),
    )
    targets = _new_farms(spark, sf).unionByName(far)
    return cohort.assign_cohorts(targets, _herds(spark, sf), "new_farm", "area", SEED, _n_targets(spark, sf))


def _n_targets(spark: SparkSession, sf: str) -> int:
    return _n_farms(spark, sf) + table(spark, sf, "nation").count()


@query(f"WITH {_ASSIGNED} SELECT new_farm, area, herd, n_members FROM assigned")
def assign_cohorts(spark: SparkSession, sf: str) -> DataFrame:
    return _assigned(spark, sf)


_CLONES = f"""{_ASSIGNED},
members AS (SELECT noan, breed, birth, farm, row_number() OVER (PARTITION BY farm ORDER BY noan) - 1 AS r FROM animals),
offsets AS (SELECT *, CAST(sum(n_members) OVER (ORDER BY new_farm) AS BIGINT) - n_members AS first FROM assigned),
clones AS (SELECT noan, breed, birth, new_farm, first + r AS idx FROM members JOIN offsets ON farm = herd)"""


def _clones(spark: SparkSession, sf: str, assigned: DataFrame) -> DataFrame:
    members = animals(spark, sf).select("noan", "breed", "birth", "farm")
    return cohort.clone_members(assigned, members, "new_farm", "noan", "farm", _n_targets(spark, sf))


@query(f"WITH {_CLONES} SELECT noan, breed, birth, new_farm, idx FROM clones")
def clone_members(spark: SparkSession, sf: str) -> DataFrame:
    return _clones(spark, sf, _assigned(spark, sf)).drop("farm")


_SPAN = 10_000_000_000
_FACTOR, _SHIFT = keys.permutation(SEED, _SPAN)


def _surrogate(idx: str) -> str:
    return f"1000000 + CAST((CAST({_FACTOR} AS HUGEINT) * ({idx}) + {_SHIFT}) % {_SPAN} AS BIGINT)"


_N_CLONES = "(SELECT count(*) FROM clones)"
_DAM = f"(idx + 1 + {scale_sql(hash_sql('dam', 'idx'), f'({_N_CLONES} - 1)')}) % {_N_CLONES}"


def _pedigree_sql(dam: str) -> str:
    return (
        f"WITH {_CLONES} SELECT {_surrogate('idx')} AS noan, new_farm, breed, birth, "
        f"99000000 + {scale_sql(hash_sql('sire', 'idx'), '1000000')} AS noanpere, "
        f"CASE WHEN {hash_sql('dam known', 'idx')} < {int(0.8 * TWO60)} THEN {_surrogate(dam)} END AS noanmere FROM clones"
    )


def _pedigree(spark: SparkSession, sf: str, no_self: bool) -> DataFrame:
    assigned = stage(_assigned(spark, sf), "assigned")
    total = assigned.agg(F.sum("n_members").alias("n")).scalar()
    clones = _clones(spark, sf, assigned).drop("noan", "farm")
    new = cohort.pedigree(clones, total, SEED, low=1_000_000, high=1_000_000 + _SPAN, no_self=no_self)
    return new.drop("idx")


@query(_pedigree_sql(_DAM))
def pedigree(spark: SparkSession, sf: str) -> DataFrame:
    return _pedigree(spark, sf, True)


@query(_pedigree_sql(scale_sql(hash_sql("dam", "idx"), _N_CLONES)))
def pedigree_any_dam(spark: SparkSession, sf: str) -> DataFrame:
    """An animal may be drawn as its own dam."""
    return _pedigree(spark, sf, False)


# Visits.
_TYPED = (
    f"{VISITS}, supplier_ids AS (SELECT s_suppkey AS farm FROM supplier), "
    "type_cells AS (SELECT control_type AS value, count(*) AS n FROM (SELECT control_type, row_number() OVER "
    "(PARTITION BY farm ORDER BY visit_date, visit_id) AS r FROM visits WHERE control_type IN (1, 2, 9, 10)) "
    "WHERE r = 1 GROUP BY ALL), "
    + sample_sql("typed", "type_cells", [], [[]], "rows", "supplier_ids", {}, hash_sql("control type", "r.farm"), "control_type")
)


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("farm"))
    return cal.control_types(
        ids, visits(spark, sf), "farm", "farm", "control_type", ["visit_date", "visit_id"], SEED
    )


_UNFILTERED = _TYPED.replace(
    "FROM visits WHERE control_type IN (1, 2, 9, 10)) WHERE r = 1", "FROM visits) WHERE r = 1 AND control_type IN (1, 2, 9, 10)"
)


@query(f"WITH {_UNFILTERED} SELECT farm, control_type FROM typed")
def control_type_unfiltered(spark: SparkSession, sf: str) -> DataFrame:
    """Types taken from the first visit of all, before the other types are left out."""
    ids = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("farm"))
    order = ["visit_date", "visit_id"]
    return cal.control_types(ids, visits(spark, sf), "farm", "farm", "control_type", order, SEED, filter_first=False)


@query(f"WITH {_TYPED} SELECT farm, control_type FROM typed")
def control_type(spark: SparkSession, sf: str) -> DataFrame:
    return _typed(spark, sf)


_START = f"CAST(DATE '{AS_OF}' - INTERVAL 60 MONTH AS DATE)"
_FIRST = f"{_START} + CAST({scale_sql(hash_sql('first visit', 'farm'), f'''(DATE '{AS_OF}' - {_START} + 1)''')} AS INTEGER)"
_CALENDAR = f"""{_TYPED}, firsts AS (SELECT farm, control_type, {_FIRST} AS first_visit,
  CASE WHEN control_type IN (1, 9) THEN 28 ELSE 42 END AS step FROM typed),
counted AS (SELECT *, least((DATE '{AS_OF}' - first_visit) // step + 1, 1825 // step + 1) AS n_visits FROM firsts),
exploded AS (SELECT *, unnest(range(n_visits)) AS p FROM counted),
cal AS (SELECT farm, control_type, CAST(p AS INTEGER) AS pos, first_visit + CAST(p * step AS INTEGER) AS visit_date FROM exploded)"""


def _plan(spark: SparkSession, sf: str) -> DataFrame:
    return cal.visit_plan(_typed(spark, sf), "farm", AS_OF, cal.step_days(F.col("control_type")), SEED)


def _calendar(spark: SparkSession, sf: str) -> DataFrame:
    return cal.visit_calendar(_plan(spark, sf)).select("farm", "control_type", "pos", "visit_date")


@query(f"WITH {_CALENDAR} SELECT farm, control_type, pos, visit_date FROM cal")
def visit_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return _calendar(spark, sf)


@query(f"WITH {_CALENDAR} SELECT farm, visit_date, 700000 + row_number() OVER (ORDER BY farm, visit_date) - 1 AS visit_id FROM cal")
def visit_ids(spark: SparkSession, sf: str) -> DataFrame:
    return cal.visit_ids(_plan(spark, sf), "farm", n_farms=_n_farms(spark, sf)).select("farm", "visit_date", "visit_id")


@query(
    f"WITH {_CALENDAR}, step_cells AS (SELECT step_code AS value, count(*) AS n FROM visits GROUP BY ALL), "
    + sample_sql("stepped", "step_cells", [], [[]], "rows", "cal", {}, hash_sql("control step", "r.farm", "r.pos"), "step_code")
    + " SELECT farm, pos, step_code FROM stepped"
)
def control_step(spark: SparkSession, sf: str) -> DataFrame:
    out = cal.control_steps(_calendar(spark, sf), visits(spark, sf), "step_code", ["farm", "pos"], SEED, "step_code")
    return out.select("farm", "pos", "step_code")


@query(
    f"WITH {_CALENDAR}, m AS (SELECT max(visit_date) AS latest FROM visits), lag AS (SELECT "
    "CAST(round_even(avg(lab_date - visit_date), 0) AS INTEGER) AS days FROM visits, m "
    "WHERE visit_date BETWEEN CAST(latest - INTERVAL 12 MONTH AS DATE) AND latest) "
    "SELECT farm, pos, visit_date + days AS lab_date FROM cal, lag"
)
def lab_date(spark: SparkSession, sf: str) -> DataFrame:
    lag = cal.mean_lag(visits(spark, sf), "visit_date", "lab_date")
    return cal.lab_dates(_calendar(spark, sf), "visit_date", lag).select("farm", "pos", "lab_date")


@query(
    f"WITH {_CALENDAR}, slot_cells AS (SELECT slot AS value, count(*) AS n FROM visits WHERE control_type IN (1, 2) GROUP BY ALL), "
    + sample_sql("slotted", "slot_cells", [], [[]], "rows", "cal", {}, hash_sql("slot", "r.farm", "r.pos"), "drawn")
    + " SELECT farm, pos, CASE WHEN control_type IN (1, 2) THEN drawn WHEN (row_number() OVER (PARTITION BY farm ORDER BY "
    f"visit_date) - 1 + {hash_sql('slot start', 'farm')}) % 2 = 0 THEN 'AM' ELSE 'PM' END AS slot FROM slotted"
)
def slot_alternate(spark: SparkSession, sf: str) -> DataFrame:
    out = cal.slots(
        _calendar(spark, sf), visits(spark, sf), "control_type", "slot", "control_type", "farm", SEED
    )
    return out.select("farm", "pos", "slot")


# Lactation profiles.
_SHARES = "n, CAST(sum(n) OVER (PARTITION BY {keys}) AS BIGINT) AS tot, n / sum(n) OVER (PARTITION BY {keys}) AS share"
_PARITY = """parity AS (SELECT area, breed, value, count(*) AS n FROM (SELECT noan, max(nolact) AS value FROM lact GROUP BY noan) l
  JOIN animals a ON l.noan = a.noan GROUP BY ALL)"""


def _parity(spark: SparkSession, sf: str, source: DataFrame, per_row: bool = False) -> Profile:
    return lactation.parity_profile(source, animals(spark, sf), "noan", "nolact", ["area", "breed"], per_row)


@query(
    f"WITH {LACTATIONS}, {ANIMALS}, {_PARITY} SELECT area, breed, value AS nb_lact, "
    f"{_SHARES.format(keys='area, breed')} FROM parity"
)
def parity_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _parity(spark, sf, lactations(spark, sf)).shares()


@query(
    f"WITH {LACTATIONS}, {ANIMALS}, p AS (SELECT area, breed, nolact AS nb_lact, count(*) AS n FROM lact l "
    f"JOIN animals a ON l.noan = a.noan GROUP BY ALL) SELECT area, breed, nb_lact, {_SHARES.format(keys='area, breed')} FROM p"
)
def parity_profile_per_row(spark: SparkSession, sf: str) -> DataFrame:
    return _parity(spark, sf, lactations(spark, sf), True).shares()


_GAPS = f"""spans AS (SELECT breed, area, nolact, CASE WHEN nolact = 1 THEN {months_sql('vel', 'birth')} ELSE
  {months_sql('vel', 'prev')} END AS m, {months_sql('tar', 'vel')} AS d
  FROM (SELECT *, lag(vel) OVER (PARTITION BY noan ORDER BY nolact) AS prev FROM lact) l JOIN animals a ON l.noan = a.noan
  WHERE vel IS NOT NULL AND tar IS NOT NULL),
gap_raw AS (SELECT breed, area, nolact, m, count(*) AS n FROM spans GROUP BY ALL),
gaps AS (SELECT breed, area, nolact, value, CAST(sum(n) AS BIGINT) AS n FROM (SELECT breed, area, nolact, n,
  coalesce(m, CAST(trunc(avg(m) OVER (PARTITION BY breed, area, nolact)) AS INTEGER), 10) AS value FROM gap_raw) GROUP BY ALL),
durations AS (SELECT breed, area, nolact, d AS value, count(*) AS n FROM spans GROUP BY ALL)"""


def _gaps(spark: SparkSession, sf: str, source: DataFrame) -> Profile:
    return lactation.gap_profile(
        source, animals(spark, sf), "noan", "nolact", "vel", "tar", "birth", ["breed", "area"]
    )


def _durations(spark: SparkSession, sf: str, source: DataFrame) -> Profile:
    return lactation.duration_profile(source, animals(spark, sf), "noan", "nolact", "vel", "tar", ["breed", "area"])


_CELL = "breed, area, nolact"


@query(f"WITH {LACTATIONS}, {ANIMALS}, {_GAPS} SELECT {_CELL}, value AS gap, {_SHARES.format(keys=_CELL)} FROM gaps")
def gap_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _gaps(spark, sf, stage(lactations(spark, sf), "lactations")).shares()


@query(f"WITH {LACTATIONS}, {ANIMALS}, {_GAPS} SELECT {_CELL}, value AS duration, {_SHARES.format(keys=_CELL)} FROM durations")
def duration_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _durations(spark, sf, lactations(spark, sf)).shares()


# Generated lactations of the animals: count, expansion, calving and dry-off dates.
_PARITY_TIERS = [["area", "breed"], ["breed"], ["area"]]
_DATE_TIERS = [["breed", "area", "nolact"], ["breed", "area"], ["breed"]]
_OWN = {"area": "area", "breed": "breed", "nolact": "nolact"}

_COUNTED = f"{LACTATIONS}, {ANIMALS}, {_PARITY}, " + sample_sql(
    "counted", "parity", ["area", "breed"], _PARITY_TIERS, "cells", "animals", _OWN, hash_sql("parity", "r.noan"), "nb_lact", "1"
)
_EXPANDED = f"""{_COUNTED}, expanded AS (SELECT noan, breed, area, birth, nolact,
  3531047 + row_number() OVER (ORDER BY noan, nolact) - 1 AS id_laitlact FROM (SELECT noan, breed, area, birth,
  CAST(unnest(range(1, nb_lact + 1)) AS INTEGER) AS nolact FROM counted))"""
_STARTED = (
    f"{_EXPANDED}, {_GAPS}, "
    + sample_sql(
        "spaced", "gaps", ["breed", "area", "nolact"], _DATE_TIERS, "cells", "expanded", _OWN,
        hash_sql("gap", "r.noan", "r.nolact"), "gap", "10",
    )
    + ", started AS (SELECT * EXCLUDE (tier), CAST(sum(gap) OVER (PARTITION BY noan ORDER BY nolact) AS BIGINT) AS gap_total, "
    "birth + CAST(30 * sum(gap) OVER (PARTITION BY noan ORDER BY nolact) AS INTEGER) AS date_vel FROM spaced)"
)
_ENDED = (
    f"{_STARTED}, "
    + sample_sql(
        "lasting", "durations", ["breed", "area", "nolact"], _DATE_TIERS, "cells", "started", _OWN,
        hash_sql("duration", "r.noan", "r.nolact"), "drawn", "10",
    )
    + ", ended AS (SELECT *, date_vel + 30 * greatest(drawn, 2) AS date_tar FROM lasting)"
)


def _counted(spark: SparkSession, sf: str, parity: Profile) -> DataFrame:
    rows = animals(spark, sf).select("noan", "breed", "area", "birth")
    return sample_by_tiers(rows, parity, _PARITY_TIERS, _OWN, ["noan"], "nb_lact", SEED, "parity", 1)


def _expanded(spark: SparkSession, sf: str, parity: Profile) -> DataFrame:
    return sequence.explode_counter(_counted(spark, sf, parity), "noan", "nb_lact")


def _started(spark: SparkSession, sf: str, source: DataFrame) -> tuple[DataFrame, bool]:
    parity = _parity(spark, sf, source)
    short = parity.limits.short(lactation.longest(parity))
    spaced = sample_by_tiers(
        _expanded(spark, sf, parity), _gaps(spark, sf, source), _DATE_TIERS, _OWN, ["noan", "nolact"], "gap", SEED,
        "gap", 10,
    )
    return sequence.cumulative_dates(spaced, "noan", "nolact", "gap", "birth", "date_vel", short=short), short


def _lasting(spark: SparkSession, sf: str) -> tuple[DataFrame, bool]:
    source = stage(lactations(spark, sf), "lactations")
    started, short = _started(spark, sf, source)
    lasting = sample_by_tiers(
        started, _durations(spark, sf, source), _DATE_TIERS, _OWN, ["noan", "nolact"], "duration", SEED,
        "duration", 10, floor=2,
    )
    return lasting, short


def _ended(spark: SparkSession, sf: str) -> tuple[DataFrame, bool]:
    lasting, short = _lasting(spark, sf)
    return sequence.end_dates(lasting, "noan", "nolact", "date_vel", "duration", "date_tar"), short


@query(f"WITH {_COUNTED} SELECT noan, nb_lact FROM counted")
def lactation_count(spark: SparkSession, sf: str) -> DataFrame:
    return _counted(spark, sf, _parity(spark, sf, lactations(spark, sf))).select("noan", "nb_lact")


@query(f"WITH {_EXPANDED} SELECT id_laitlact, noan, nolact FROM expanded")
def explode_counter(spark: SparkSession, sf: str) -> DataFrame:
    return _expanded(spark, sf, _parity(spark, sf, lactations(spark, sf))).select("id_laitlact", "noan", "nolact")


@query(f"WITH {_STARTED} SELECT id_laitlact, gap, gap_total, date_vel FROM started")
def start_dates(spark: SparkSession, sf: str) -> DataFrame:
    started, _ = _started(spark, sf, stage(lactations(spark, sf), "lactations"))
    return started.select("id_laitlact", "gap", "gap_total", "date_vel")


@query(f"WITH {_ENDED} SELECT id_laitlact, date_vel, date_tar FROM ended")
def end_dates(spark: SparkSession, sf: str) -> DataFrame:
    return _ended(spark, sf)[0].select("id_laitlact", "date_vel", "date_tar")


@query(
    f"WITH {_ENDED} SELECT id_laitlact, date_vel + 30 * CAST(sum(greatest(drawn, 2)) OVER (PARTITION BY noan ORDER BY nolact) "
    "AS INTEGER) AS date_tar FROM lasting"
)
def end_dates_cumulative(spark: SparkSession, sf: str) -> DataFrame:
    """Each end lies all durations so far behind the row's start."""
    lasting, short = _lasting(spark, sf)
    rows = sequence.end_dates(lasting, "noan", "nolact", "date_vel", "duration", "date_tar", cumulative=True, short=short)
    return rows.select("id_laitlact", "date_tar")


@query(
    f"""WITH {_ENDED}, fixed AS (SELECT id_laitlact, noan, nolact, date_vel, CASE WHEN date_tar >= following
  THEN CAST(following - INTERVAL 2 MONTH AS DATE) ELSE date_tar END AS date_tar FROM (SELECT *, lead(date_vel) OVER
  (PARTITION BY noan ORDER BY nolact) AS following FROM ended))
SELECT id_laitlact, noan, nolact, date_vel, CASE WHEN date_tar <= DATE '{AS_OF}' THEN date_tar END AS date_tar
FROM fixed WHERE date_vel < DATE '{AS_OF}'"""
)
def dated_lactations(spark: SparkSession, sf: str) -> DataFrame:
    """Generated lactations after overlap repair, removal of future rows and censoring."""
    ended, short = _ended(spark, sf)
    repaired = sequence.repair_overlap(ended, "noan", "nolact", "date_vel", "date_tar", short=short)
    kept = sequence.censor_as_of(sequence.drop_future(repaired, "date_vel", AS_OF), "date_tar", AS_OF)
    return kept.select("id_laitlact", "noan", "nolact", "date_vel", "date_tar")


_NEXT = f"WITH {LACTATIONS}, n AS (SELECT *, lead(vel) OVER (PARTITION BY noan ORDER BY nolact) AS following FROM lact) "


@query(
    _NEXT + "SELECT id, CASE WHEN tar >= following THEN CAST(following - INTERVAL 2 MONTH AS DATE) ELSE tar END AS tar FROM n"
)
def repair_overlap(spark: SparkSession, sf: str) -> DataFrame:
    source = stage(lactations(spark, sf), "lactations")
    return sequence.repair_overlap(source, "noan", "nolact", "vel", "tar").select("id", "tar")


@query(
    _NEXT + "SELECT id, CASE WHEN tar >= following THEN CAST(date_trunc('month', following) - INTERVAL 2 MONTH AS DATE) "
    "+ CAST(day(following) - 1 AS INTEGER) ELSE tar END AS tar FROM n"
)
def repair_overlap_overflow(spark: SparkSession, sf: str) -> DataFrame:
    source = stage(lactations(spark, sf), "lactations")
    rows = sequence.repair_overlap(source, "noan", "nolact", "vel", "tar", overflow=True)
    return rows.select("id", "tar")


@query(
    _NEXT + "SELECT id, CASE WHEN tar > CAST(following - INTERVAL 2 MONTH AS DATE) THEN CAST(following - INTERVAL 2 MONTH AS DATE) "
    "ELSE tar END AS tar FROM n"
)
def repair_overlap_strict(spark: SparkSession, sf: str) -> DataFrame:
    """Gaps shorter than two months are widened as well."""
    rows = sequence.repair_overlap(stage(lactations(spark, sf), "lactations"), "noan", "nolact", "vel", "tar", strict=True)
    return rows.select("id", "tar")


_LOOSE = (
    f"{LACTATIONS}, loose AS (SELECT id, CASE WHEN id % 5 > 0 THEN noan END AS noan, (nolact + 1) // 2 AS nolact, vel, tar FROM lact), "
    "firsts AS (SELECT noan, nolact, min(vel) AS vel FROM loose WHERE noan IS NOT NULL GROUP BY ALL)"
)


@query(
    f"WITH {_LOOSE} SELECT id, CASE WHEN l.tar >= f.vel THEN CAST(f.vel - INTERVAL 2 MONTH AS DATE) ELSE l.tar END AS tar "
    "FROM loose l LEFT JOIN firsts f ON l.noan = f.noan AND f.nolact = l.nolact + 1"
)
def repair_overlap_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Repair where some animals are unknown and ordinals occur twice."""
    rows = stage(lactations(spark, sf), "lactations").select(
        "id",
        F.when(F.col("id") % 5 > 0, F.col("noan")).alias("noan"),
        F.expr("cast((nolact + 1) div 2 as int)").alias("nolact"),
        "vel",
        "tar",
    )
    return sequence.repair_overlap(rows, "noan", "nolact", "vel", "tar").select("id", "tar")
