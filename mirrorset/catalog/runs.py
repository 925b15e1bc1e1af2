"""Visits and lactations of a full run, and audits of the run's own output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorset.catalog import generators, measures
from mirrorset.catalog.registry import query
from mirrorset.catalog.roles import AS_OF, LACTATIONS, SEED, hash_sql, table
from mirrorset.catalog.sampling import SEGMENT_BY_NATION, sample_sql
from mirrorset.functions.draws import hash_u60
from mirrorset.operators import audit, cohort
from mirrorset.operators.profile import profile
from mirrorset.operators.sample import tiered_distribution
from mirrorset.plans import synthesis
from mirrorset.sources.staging import stage, staged_path
from mirrorset.streaming import sample_stream


def _run(spark: SparkSession, sf: str) -> tuple[dict[str, DataFrame], synthesis.Settings, DataFrame]:
    """Source tables, settings and farms of a run."""
    settings = measures._settings(spark, sf)
    source = synthesis._clean_source(measures.domain_tables(spark, sf))
    return source, settings, stage(synthesis.make_farms(spark, source, settings), "farms")


# The calendar of the new farms.
_RUN_CALENDAR = f"{generators._NEW_FARMS}, " + generators._CALENDAR.replace(
    "supplier_ids AS (SELECT s_suppkey AS farm FROM supplier)", "supplier_ids AS (SELECT new_farm AS farm FROM new_farms)"
)
_RUN_VISITS = ", ".join(
    [
        _RUN_CALENDAR,
        "step_cells AS (SELECT ascii(step_code) AS value, count(*) AS n FROM visits GROUP BY ALL)",
        sample_sql("stepped", "step_cells", [], [[]], "rows", "cal", {}, hash_sql("control step", "r.farm", "r.pos"), "step"),
        "m AS (SELECT max(visit_date) AS latest FROM visits)",
        "lag AS (SELECT CAST(round_even(avg(lab_date - visit_date), 0) AS INTEGER) AS days FROM visits, m "
        "WHERE visit_date BETWEEN CAST(latest - INTERVAL 12 MONTH AS DATE) AND latest)",
        "slot_cells AS (SELECT slot AS value, count(*) AS n FROM visits WHERE control_type IN (1, 2) GROUP BY ALL)",
        sample_sql("slotted", "slot_cells", [], [[]], "rows", "cal", {}, hash_sql("slot", "r.farm", "r.pos"), "drawn"),
    ]
)


@query(
    f"""WITH {_RUN_VISITS} SELECT 700000 + row_number() OVER (ORDER BY s.farm, s.visit_date) - 1 AS visit_id, s.farm, s.visit_date,
  CAST(s.control_type AS INTEGER) AS control_type, s.visit_date + days AS lab_date, CAST(t.step AS INTEGER) AS step,
  CASE WHEN s.control_type IN (1, 2) THEN drawn WHEN (row_number() OVER (PARTITION BY s.farm ORDER BY s.visit_date) - 1
    + {hash_sql('slot start', 's.farm')}) % 2 = 0 THEN 'AM' ELSE 'PM' END AS slot
FROM slotted s JOIN stepped t ON s.farm = t.farm AND s.pos = t.pos, lag"""
)
def synthetic_visits(spark: SparkSession, sf: str) -> DataFrame:
    """The visits of a full run, on its own farms."""
    source, settings, farms = _run(spark, sf)
    return synthesis.make_visits(source, farms, settings).select(
        F.col("ID_LAITEXPL").alias("visit_id"),
        F.col("NOINTEXPL").alias("farm"),
        F.col("DATE_CTRL").alias("visit_date"),
        F.col("CD_TYPE_CTRL").alias("control_type"),
        F.col("DATE_RECEPT_ANALYSE").alias("lab_date"),
        F.col("CD_ETAPE_CTRL").alias("step"),
        F.col("TRAIT1").alias("slot"),
    )


# The lactations of the new animals, by profiles of the animals on known farms.
_OWNED = "JOIN animals a ON l.noan = a.noan"
_KNOWN = "JOIN known a ON l.noan = a.noan"
_COWS = f"""{measures._RUN_CLONES}, {LACTATIONS},
known AS (SELECT a.noan, a.breed, CAST(floor(f.postcode / 100) * 100 AS INTEGER) AS area, a.birth
  FROM animals a JOIN farms f ON a.farm = f.farm WHERE a.farm <> {cohort.EXIT_FARM}),
cows AS (SELECT {measures._animal_id('idx')} AS noan, breed, birth, n.area FROM clones c JOIN new_farms n ON c.new_farm = n.new_farm)"""
_RUN_ENDED = ", ".join(
    [
        _COWS,
        generators._PARITY.replace(_OWNED.removeprefix("JOIN "), _KNOWN.removeprefix("JOIN ")),
        sample_sql("counted", "parity", ["area", "breed"], generators._PARITY_TIERS, "cells", "cows", generators._OWN,
                   hash_sql("parity", "r.noan"), "nb_lact", "1"),
        "expanded AS (SELECT noan, breed, area, birth, nolact, 3531047 + row_number() OVER (ORDER BY noan, nolact) - 1 AS id_laitlact "
        "FROM (SELECT noan, breed, area, birth, CAST(unnest(range(1, nb_lact + 1)) AS INTEGER) AS nolact FROM counted))",
        generators._GAPS.replace(_OWNED, _KNOWN),
        sample_sql("spaced", "gaps", ["breed", "area", "nolact"], generators._DATE_TIERS, "cells", "expanded", generators._OWN,
                   hash_sql("gap", "r.noan", "r.nolact"), "gap", "10"),
        "started AS (SELECT * EXCLUDE (tier), birth + CAST(30 * sum(gap) OVER (PARTITION BY noan ORDER BY nolact) AS INTEGER) "
        "AS date_vel FROM spaced)",
        sample_sql("lasting", "durations", ["breed", "area", "nolact"], generators._DATE_TIERS, "cells", "started", generators._OWN,
                   hash_sql("duration", "r.noan", "r.nolact"), "drawn", "10"),
        "ended AS (SELECT *, date_vel + 30 * greatest(drawn, 2) AS date_tar, "
        "lead(date_vel) OVER (PARTITION BY noan ORDER BY nolact) AS following FROM lasting)",
        "fixed AS (SELECT id_laitlact, noan, nolact, breed, date_vel, CASE WHEN date_tar >= following "
        "THEN CAST(following - INTERVAL 2 MONTH AS DATE) ELSE date_tar END AS date_tar FROM ended)",
        f"made AS (SELECT id_laitlact, noan, nolact, breed, date_vel, CASE WHEN date_tar <= DATE '{AS_OF}' THEN date_tar END "
        f"AS date_tar FROM fixed WHERE date_vel < DATE '{AS_OF}')",
    ]
)


def _animals(source: dict[str, DataFrame], farms: DataFrame, settings: synthesis.Settings) -> DataFrame:
    return stage(synthesis.make_animals(source, farms, settings), "animals")


def _lactations(spark: SparkSession, sf: str) -> tuple[dict[str, DataFrame], DataFrame]:
    source, settings, farms = _run(spark, sf)
    made = synthesis.make_lactations(source, farms, _animals(source, farms, settings), settings)
    return source, made.select(
        F.col("ID_LAITLACT").alias("id_laitlact"),
        F.col("NOAN").alias("noan"),
        F.col("NOLACT").cast("int").alias("nolact"),
        F.col("ACTIEL").alias("breed"),
        F.col("DATE_VEL").alias("date_vel"),
        F.col("DATE_TAR").alias("date_tar"),
    )


@query(f"WITH {_RUN_ENDED} SELECT id_laitlact, noan, nolact, breed, date_vel, date_tar FROM made")
def synthetic_lactations(spark: SparkSession, sf: str) -> DataFrame:
    """The dated lactations of a full run, on its own animals."""
    return _lactations(spark, sf)[1]


_MOMENTS = ["nolact", "month", "duration"]
_MEASURED = (
    "real_m AS (SELECT nolact, month(vel) AS month, tar - vel AS duration FROM lact), "
    "made_m AS (SELECT nolact, month(date_vel) AS month, date_tar - date_vel AS duration FROM made)"
)


def _moment_sql(column: str) -> str:
    parts = [
        f"(SELECT round({f}({column}), 4) FROM {side}_m) AS {name}_{what}"
        for side, name in (("real", "source"), ("made", "synthetic"))
        for f, what in (("avg", "mean"), ("stddev_samp", "sd"))
    ]
    return f"SELECT '{column}' AS measure, {', '.join(parts)}"


def _measured(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.select("nolact", F.month(start).alias("month"), F.datediff(end, start).alias("duration"))


@query(f"WITH {_RUN_ENDED}, {_MEASURED} {' UNION ALL '.join(map(_moment_sql, _MOMENTS))}")
def synthetic_fidelity(spark: SparkSession, sf: str) -> DataFrame:
    """Mean and deviation of the run's lactations beside those of the source."""
    source, made = _lactations(spark, sf)
    real = source["CL_LAITLACT"].withColumnRenamed("NOLACT", "nolact")
    out = audit.fidelity(_measured(real, "DATE_VEL", "DATE_TAR"), stage(_measured(made, "date_vel", "date_tar"), "measured"), _MOMENTS)
    return out.select("measure", *[F.round(c, 4).alias(c) for c in out.columns if c != "measure"])


_HERD_SIZES = (
    f"WITH {measures._RUN_CLONES}, real_s AS (SELECT count(*) AS v FROM animals WHERE farm <> {cohort.EXIT_FARM} GROUP BY farm), "
    "made_s AS (SELECT count(*) AS v FROM clones GROUP BY new_farm), "
    "a AS (SELECT v AS value, count(*) / sum(count(*)) OVER () AS s FROM real_s GROUP BY ALL), "
    "b AS (SELECT v AS value, count(*) / sum(count(*)) OVER () AS s FROM made_s GROUP BY ALL) "
    "SELECT coalesce(a.value, b.value) AS value, round(coalesce(a.s, 0), 6) AS source_share, "
    "round(coalesce(b.s, 0), 6) AS synthetic_share, round(abs(coalesce(a.s, 0) - coalesce(b.s, 0)), 6) AS drift "
    "FROM a FULL JOIN b ON a.value = b.value"
)


@query(_HERD_SIZES)
def synthetic_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of herd sizes in the source and in the run's animals."""
    source, settings, farms = _run(spark, sf)
    real = source["IDENTANV"].where(F.col("NOINTSANIT") != cohort.EXIT_FARM)
    made = _animals(source, farms, settings)
    sizes = [df.groupBy("NOINTSANIT").agg(F.count(F.lit(1)).alias("size")) for df in (real, made)]
    out = audit.share_drift(*sizes, "size")
    return out.select("value", *[F.round(c, 6).alias(c) for c in out.columns if c != "value"])


@query(
    f"""WITH {measures._RUN_CLONES}, synth AS (SELECT {measures._animal_id('idx')} AS k, breed, birth FROM clones),
g AS (SELECT breed, birth, count(*) AS n FROM synth GROUP BY ALL)
SELECT (SELECT count(*) FROM synth) AS n_rows, (SELECT count(*) FROM synth WHERE k IN (SELECT noan FROM animals)) AS shared_keys,
  (SELECT count(*) FROM synth s WHERE EXISTS (SELECT 1 FROM animals a WHERE a.breed = s.breed AND a.birth = s.birth)) AS shared_rows,
  (SELECT count(*) FROM g) AS n_groups, (SELECT min(n) FROM g) AS smallest_group"""
)
def synthetic_anonymity(spark: SparkSession, sf: str) -> DataFrame:
    """Ids and birthdays by breed that the run's animals share with real ones."""
    source, settings, farms = _run(spark, sf)
    made = _animals(source, farms, settings)
    return audit.anonymity(source["IDENTANV"], made, ["NOAN"], ["ACTIEL", "DTNAISANINV"])


_KS_PRICE = """v AS (SELECT o_totalprice AS value, count(*) FILTER (WHERE o_orderstatus <> 'O') AS a,
  count(*) FILTER (WHERE o_orderstatus = 'O') AS b FROM orders WHERE o_totalprice IS NOT NULL GROUP BY ALL)"""


def _ks_sql(column: str) -> str:
    return f"""g AS (SELECT value, a, b, abs((sum(a) OVER upto)::DOUBLE / sum(a) OVER () - (sum(b) OVER upto)::DOUBLE / sum(b) OVER ()) AS gap
  FROM v WINDOW upto AS (ORDER BY value ROWS UNBOUNDED PRECEDING))
SELECT '{column}' AS measure, sum(a)::BIGINT AS n_source, sum(b)::BIGINT AS n_synthetic, round(max(gap), 9) AS distance,
  (SELECT value FROM g ORDER BY gap DESC, value LIMIT 1) AS at_value FROM g"""


def _ks(real: DataFrame, made: DataFrame, column: str) -> DataFrame:
    return audit.ks_distance(real, made, column).withColumn("distance", F.round("distance", 9))


@query(f"WITH {_KS_PRICE}, {_ks_sql('o_totalprice')}")
def ks_distance(spark: SparkSession, sf: str) -> DataFrame:
    """Largest gap between the distributions of the prices of finished and running orders."""
    orders = table(spark, sf, "orders")
    return _ks(orders.where("o_orderstatus <> 'O'"), orders.where("o_orderstatus = 'O'"), "o_totalprice")


_KS_DURATION = """v AS (SELECT value, count(*) FILTER (WHERE real) AS a, count(*) FILTER (WHERE NOT real) AS b FROM (
  SELECT tar - vel AS value, true AS real FROM lact UNION ALL SELECT date_tar - date_vel, false FROM made)
  WHERE value IS NOT NULL GROUP BY ALL)"""


@query(f"WITH {_RUN_ENDED}, {_KS_DURATION}, {_ks_sql('duration')}")
def synthetic_ks(spark: SparkSession, sf: str) -> DataFrame:
    """The same for the durations of the run's lactations beside the source's."""
    source, made = _lactations(spark, sf)
    return _ks(_measured(source["CL_LAITLACT"].withColumnRenamed("NOLACT", "nolact"), "DATE_VEL", "DATE_TAR"),
               _measured(made, "date_vel", "date_tar"), "duration")


def _pair_sql(real: str, made: str, first: str, second: str) -> str:
    told = "(SELECT round(sum(n / t * ln(n * t / (n1 * n2))), 6) FROM {0}_i)"
    sides = ", ".join(
        f"{s}_c AS (SELECT {first} AS v1, {second} AS v2, count(*)::DOUBLE AS n FROM {rows} GROUP BY ALL), "
        f"{s}_i AS (SELECT *, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY v1) AS n1, sum(n) OVER (PARTITION BY v2) AS n2 FROM {s}_c)"
        for s, rows in (("real", real), ("made", made))
    )
    return f"""{sides} SELECT '{first}, {second}' AS pair, {told.format("real")} AS source_information,
  {told.format("made")} AS synthetic_information, (SELECT round(sum(abs(coalesce(r.n / r.t, 0) - coalesce(m.n / m.t, 0))) / 2, 6)
  FROM real_i r FULL JOIN made_i m ON r.v1 IS NOT DISTINCT FROM m.v1 AND r.v2 IS NOT DISTINCT FROM m.v2) AS distance"""


@query(
    f"WITH {_RUN_ENDED}, real_p AS (SELECT breed, nolact FROM lact l JOIN known a ON l.noan = a.noan), "
    + _pair_sql("real_p", "made", "breed", "nolact")
)
def synthetic_pair_drift(spark: SparkSession, sf: str) -> DataFrame:
    """What breed and lactation number tell about each other in the source and in the run's lactations."""
    source, made = _lactations(spark, sf)
    known = synthesis.source_animals(source).select(F.col("NOAN").alias("noan"), F.col("ACTIEL").alias("breed"))
    real = source["CL_LAITLACT"].select(F.col("NOAN").alias("noan"), F.col("NOLACT").alias("nolact")).join(known, "noan")
    out = audit.pair_drift(real, made, "breed", "nolact")
    return out.select("pair", *[F.round(c, 6).alias(c) for c in out.columns if c != "pair"])


@query(f"WITH {SEGMENT_BY_NATION} SELECT o_orderkey, c_nationkey, segment FROM sampled")
def sample_stream_segment(spark: SparkSession, sf: str) -> DataFrame:
    """The draw of segments by nation for orders that arrive in several files, read as a stream."""
    customers = table(spark, sf, "customer")
    buyers = table(spark, sf, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    arriving = staged_path(spark, "arriving")
    buyers.repartition(4, "o_orderkey").write.parquet(arriving)
    stream = spark.readStream.schema(buyers.schema).option("maxFilesPerTrigger", 2).parquet(arriving)
    prof = profile(customers, "c_mktsegment", ["c_nationkey"])
    dist = tiered_distribution(prof, [prof.keys], "rows")
    out = staged_path(spark, "sampled")
    draw = hash_u60(SEED, "segment", F.col("o_orderkey"))
    running = sample_stream(stream, dist, {"c_nationkey": "c_nationkey"}, draw, "segment", out, staged_path(spark, "stream-state"))
    running.awaitTermination()
    return spark.read.parquet(out).select("o_orderkey", "c_nationkey", "segment")
