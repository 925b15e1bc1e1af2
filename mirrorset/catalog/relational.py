"""Joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorset.catalog.registry import query
from mirrorset.catalog.roles import (
    ANIMALS,
    LACTATIONS,
    SEED,
    VISITS,
    animals,
    hash_sql,
    lactations,
    months_sql,
    table,
    visits,
)
from mirrorset.functions.draws import hash_u60
from mirrorset.functions.dates import months_between_trunc
from mirrorset.operators import calendar, joins, keys, lactation
from mirrorset.operators.profile import profile
from mirrorset.sources.staging import stage


@query(
    f"WITH {LACTATIONS}, {ANIMALS} SELECT id, l.noan, breed, n_name FROM lact l JOIN animals a ON l.noan = a.noan "
    "JOIN nation ON n_nationkey = area"
)
def inner_join(spark: SparkSession, sf: str) -> DataFrame:
    owners = animals(spark, sf).select("noan", "breed", "area")
    named = lactations(spark, sf).join(owners, "noan").join(
        table(spark, sf, "nation"), F.col("n_nationkey") == F.col("area")
    )
    return named.select("id", "noan", "breed", "n_name")


@query("SELECT event_id, user_id, s_name FROM events LEFT JOIN supplier ON user_id = s_suppkey")
def left_join(spark: SparkSession, sf: str) -> DataFrame:
    farms = table(spark, sf, "supplier")
    joined = table(spark, sf, "events").join(farms, F.col("user_id") == F.col("s_suppkey"), "left")
    return joined.select("event_id", "user_id", "s_name")


_ORDINALS = f"{LACTATIONS}, gappy AS (SELECT * REPLACE (CAST(nolact + CASE WHEN nolact > 3 THEN 1 ELSE 0 END AS INTEGER) AS nolact) FROM lact)"


def _gappy(spark: SparkSession, sf: str) -> DataFrame:
    """All lactations, numbered without a fourth, so that there is a gap; staged, as both sides read it."""
    shifted = F.col("nolact") + F.when(F.col("nolact") > 3, 1).otherwise(0)
    return stage(lactations(spark, sf).select("id", "noan", shifted.alias("nolact"), "vel"), "gappy")


@query(
    f"WITH {_ORDINALS} SELECT a.id, a.nolact, b.vel AS previous FROM gappy a "
    "LEFT JOIN gappy b ON a.noan = b.noan AND b.nolact = a.nolact - 1"
)
def previous_ordinal(spark: SparkSession, sf: str) -> DataFrame:
    rows = joins.previous_by_ordinal(_gappy(spark, sf), "noan", "nolact", {"previous": "vel"})
    return rows.select("id", "nolact", "previous")


@query(
    f"WITH {_ORDINALS} SELECT a.id, a.nolact, b.vel AS following FROM gappy a "
    "LEFT JOIN gappy b ON a.noan = b.noan AND b.nolact = a.nolact + 1"
)
def next_ordinal(spark: SparkSession, sf: str) -> DataFrame:
    rows = joins.next_by_ordinal(_gappy(spark, sf), "noan", "nolact", {"following": "vel"})
    return rows.select("id", "nolact", "following")


@query(
    "SELECT event_id, CASE WHEN s_suppkey IS NULL THEN (SELECT max(s_name) FROM supplier) ELSE s_name END AS s_name "
    "FROM events LEFT JOIN supplier ON user_id = s_suppkey"
)
def keyed_or_pool(spark: SparkSession, sf: str) -> DataFrame:
    farms = table(spark, sf, "supplier")
    pool = farms.agg(F.max("s_name").alias("p")).scalar()
    rows = table(spark, sf, "events").select("event_id", "user_id")
    return joins.keyed_or_pool(rows, farms, "user_id", "s_suppkey", "s_name", pool).select("event_id", "s_name")


@query(
    "SELECT c_mktsegment, n, CAST(sum(n) OVER () AS BIGINT) AS tot, n / sum(n) OVER () AS share FROM "
    "(SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment)"
)
def profile_global(spark: SparkSession, sf: str) -> DataFrame:
    return profile(table(spark, sf, "customer"), "c_mktsegment").shares()


@query(
    "SELECT c_nationkey, c_mktsegment, n, CAST(sum(n) OVER (PARTITION BY c_nationkey) AS BIGINT) AS tot, "
    "n / sum(n) OVER (PARTITION BY c_nationkey) AS share FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n "
    "FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_nationkey, c_mktsegment)"
)
def profile_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return profile(table(spark, sf, "customer"), "c_mktsegment", ["c_nationkey"]).shares()


@query(
    f"WITH {VISITS}, m AS (SELECT max(visit_date) AS latest FROM visits) "
    "SELECT CAST(round_even(avg(lab_date - visit_date), 0) AS INTEGER) AS mean_lag FROM visits, m "
    "WHERE visit_date BETWEEN CAST(latest - INTERVAL 12 MONTH AS DATE) AND latest"
)
def mean_lag(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.mean_lag(visits(spark, sf), "visit_date", "lab_date")


@query(
    f"WITH {LACTATIONS} SELECT count(*) AS n, max(vel) AS latest, CAST(sum(nolact) AS BIGINT) AS total, "
    "count(*) FILTER (WHERE nolact = 1) AS firsts, count(DISTINCT noan) AS n_animals FROM lact"
)
def simple_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    per_animal = lactations(spark, sf).groupBy("noan").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("vel").alias("latest"),
        F.sum("nolact").alias("total"),
        F.count_if(F.col("nolact") == 1).alias("firsts"),
    )
    return per_animal.agg(
        F.sum("n").alias("n"),
        F.max("latest").alias("latest"),
        F.sum("total").alias("total"),
        F.sum("firsts").alias("firsts"),
        F.count(F.lit(1)).alias("n_animals"),
    )


@query(
    f"WITH {VISITS} SELECT farm, control_type, visit_id FROM (SELECT *, row_number() OVER "
    "(PARTITION BY farm ORDER BY visit_date, visit_id) AS r FROM visits) WHERE r = 1"
)
def first_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return keys.first_per_key(visits(spark, sf), ["farm"], ["visit_date", "visit_id"], ["control_type", "visit_id"])


@query(
    f"WITH {LACTATIONS}, {ANIMALS}, g AS (SELECT breed, nolact, {months_sql('tar', 'vel')} AS m, count(*) AS n "
    "FROM lact l JOIN animals a ON l.noan = a.noan GROUP BY ALL), f AS (SELECT breed, nolact, n, "
    "coalesce(m, CAST(trunc(avg(m) OVER (PARTITION BY breed, nolact)) AS INTEGER), 10) AS months FROM g) "
    "SELECT breed, nolact, months, CAST(sum(n) AS BIGINT) AS n FROM f GROUP BY ALL"
)
def group_mean_fill(spark: SparkSession, sf: str) -> DataFrame:
    rows = lactations(spark, sf).join(animals(spark, sf).select("noan", "breed"), "noan")
    months = months_between_trunc(F.col("tar"), F.col("vel"))
    return lactation.month_counts(rows, months, ["breed", "nolact"], "months", 10).cells


@query(
    f"WITH {LACTATIONS}, {ANIMALS} SELECT id, nolact, CASE WHEN nolact = 1 THEN {months_sql('vel', 'birth')} "
    f"ELSE {months_sql('vel', 'prev')} END AS gap FROM (SELECT id, noan, nolact, vel, tar, "
    "lag(vel) OVER (PARTITION BY noan ORDER BY nolact) AS prev FROM lact) l "
    "JOIN animals a ON l.noan = a.noan WHERE vel IS NOT NULL AND tar IS NOT NULL"
)
def months_since_previous(spark: SparkSession, sf: str) -> DataFrame:
    rows = lactation.gap_rows(
        lactations(spark, sf), animals(spark, sf), "noan", "nolact", "vel", "tar", "birth", ["breed"]
    )
    return rows.select("id", "nolact", "gap")


@query(
    f"WITH {LACTATIONS} SELECT id, noan, CAST(sum(id % 40) OVER (PARTITION BY noan ORDER BY nolact) AS BIGINT) AS running "
    "FROM lact"
)
def running_sum(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("noan"), F.to_date("o_orderdate").alias("vel")
    )
    return keys.running_total(rows, ["vel", "id"], F.col("id") % 40, "running", ["noan"]).select("id", "noan", "running")


@query(
    "SELECT o_orderkey AS id, o_custkey AS noan, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN o_orderkey % 40 END) OVER "
    "(PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS BIGINT) AS running FROM orders"
)
def running_sum_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """A running sum over weights that are often NULL, also at the start of a group."""
    weight = F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey") % 40).alias("w")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("noan"), F.to_date("o_orderdate").alias("vel"), weight
    )
    return keys.running_total(rows, ["vel", "id"], F.col("w"), "running", ["noan"]).select("id", "noan", "running")


@query("SELECT o_orderkey, 700000 + row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS idx FROM orders")
def dense_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return keys.dense_index(rows, ["o_custkey", "o_orderkey"], 700000).select("o_orderkey", "idx")


@query(f"WITH {LACTATIONS} SELECT id, noan, nolact FROM lact WHERE nolact <= 3")
def first_n_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return lactations(spark, sf).where(F.col("nolact") <= 3).select("id", "noan", "nolact")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey")
def sorted_output(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return rows.orderBy("o_custkey", F.desc("o_totalprice"), "o_orderkey")


@query(
    "WITH c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer), "
    "s AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS j FROM supplier) "
    "SELECT c_custkey, s_suppkey FROM c JOIN s ON i % (SELECT count(*) FROM supplier) = j"
)
def cycle_to_length(spark: SparkSession, sf: str) -> DataFrame:
    rows = keys.dense_index(table(spark, sf, "customer").select("c_custkey"), ["c_custkey"])
    cycle = keys.dense_index(table(spark, sf, "supplier").select("s_suppkey"), ["s_suppkey"], 0, "_slot")
    length = table(spark, sf, "supplier").agg(F.count(F.lit(1)).alias("n")).scalar()
    turned = rows.withColumn("_at", F.col("idx") % length)
    return turned.join(cycle, F.col("_at") == F.col("_slot")).select("c_custkey", "s_suppkey")


_SHUFFLE = hash_sql("shuffle", "c_custkey")


@query(
    "SELECT c_nationkey, c_custkey, row_number() OVER "
    f"(PARTITION BY c_nationkey ORDER BY {_SHUFFLE}, c_custkey) AS rank FROM customer"
)
def shuffle_in_group(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_nationkey", "c_custkey")
    mixed = rows.withColumn("_u", hash_u60(SEED, "shuffle", F.col("c_custkey")))
    return keys.group_rank(mixed, ["c_nationkey"], ["_u", "c_custkey"]).drop("_u")


@query(
    "SELECT c_custkey, c_mktsegment, n FROM customer LEFT JOIN "
    "(SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey"
)
def columns_by_key(spark: SparkSession, sf: str) -> DataFrame:
    counted = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return rows.join(counted, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")


@query("SELECT DISTINCT user_id FROM events EXCEPT SELECT s_suppkey FROM supplier")
def missing_categories(spark: SparkSession, sf: str) -> DataFrame:
    return joins.missing_values(table(spark, sf, "events"), table(spark, sf, "supplier"), "user_id", "s_suppkey")
