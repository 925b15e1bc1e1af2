"""The test tables in the roles of the domain.

area = nation, breed = market segment, farm = supplier, animal = customer living on
farm ``c_custkey % number of suppliers``, lactation = order, visit = event.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorset.operators.keys import group_rank

AS_OF = date(2001, 8, 2)
SEED = 7
EXIT = 7


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def farms(spark: SparkSession, sf: str) -> DataFrame:
    """Farms with a postal code; one in thirteen has none."""
    code = F.when(F.col("s_suppkey") % 13 == 12, 0).otherwise((F.col("s_nationkey") + 1) * 100 + F.col("s_suppkey") % 100)
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("farm"), code.cast("int").alias("postcode"))


def animals(spark: SparkSession, sf: str) -> DataFrame:
    n_farms = table(spark, sf, "supplier").agg(F.count(F.lit(1)).alias("n")).scalar()
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("noan"),
        F.col("c_mktsegment").alias("breed"),
        F.col("c_nationkey").alias("area"),
        (F.col("c_custkey") % n_farms).alias("farm"),
        F.date_add(F.lit(date(1990, 1, 1)), (F.col("c_custkey") % 1500).cast("int")).alias("birth"),
    )


def lactations(spark: SparkSession, sf: str) -> DataFrame:
    vel = F.to_date("o_orderdate")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("noan"),
        vel.alias("vel"),
        F.when(F.col("o_orderstatus") != "O", F.date_add(vel, (F.col("o_orderkey") % 400 + 30).cast("int"))).alias("tar"),
        F.col("o_totalprice").alias("lait"),
    )
    return group_rank(orders, ["noan"], ["vel", "id"], "nolact").withColumn("nolact", F.col("nolact").cast("int"))


def visits(spark: SparkSession, sf: str) -> DataFrame:
    code = F.expr("CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 9 WHEN 'purchase' THEN 10 ELSE 5 END")
    day = F.date_add(F.lit(date(2000, 1, 1)), (F.col("event_id") % 500).cast("int"))
    return table(spark, sf, "events").select(
        F.col("event_id").alias("visit_id"),
        F.col("user_id").alias("farm"),
        code.alias("control_type"),
        day.alias("visit_date"),
        F.date_add(day, (F.col("event_id") % 7).cast("int")).alias("lab_date"),
        F.when(F.col("event_id") % 3 == 0, "PM").otherwise("AM").alias("slot"),
        F.substring("event_type", 1, 1).alias("step_code"),
    )


# The same tables in SQL, as common table expressions.
FARMS = """farms AS (SELECT s_suppkey AS farm, CAST(CASE WHEN s_suppkey % 13 = 12 THEN 0
  ELSE (s_nationkey + 1) * 100 + s_suppkey % 100 END AS INTEGER) AS postcode FROM supplier)"""
ANIMALS = """animals AS (SELECT c_custkey AS noan, c_mktsegment AS breed, c_nationkey AS area,
  c_custkey % (SELECT count(*) FROM supplier) AS farm,
  DATE '1990-01-01' + CAST(c_custkey % 1500 AS INTEGER) AS birth FROM customer)"""
LACTATIONS = """lact AS (SELECT o_orderkey AS id, o_custkey AS noan, CAST(o_orderdate AS DATE) AS vel,
  CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 400 AS INTEGER) END AS tar,
  o_totalprice AS lait,
  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS INTEGER) AS nolact
  FROM orders)"""
VISITS = """visits AS (SELECT event_id AS visit_id, user_id AS farm,
  CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 9 WHEN 'purchase' THEN 10 ELSE 5 END AS control_type,
  DATE '2000-01-01' + CAST(event_id % 500 AS INTEGER) AS visit_date,
  DATE '2000-01-01' + CAST(event_id % 500 + event_id % 7 AS INTEGER) AS lab_date,
  CASE WHEN event_id % 3 = 0 THEN 'PM' ELSE 'AM' END AS slot, substr(event_type, 1, 1) AS step_code FROM events)"""


def hash_sql(tag: str, *keys: str, seed: int = SEED) -> str:
    written = [f"coalesce(length(CAST({k} AS VARCHAR)) || ':' || CAST({k} AS VARCHAR), 'N')" for k in keys]
    text = " || ".join([f"'{seed}:{len(tag)}:{tag}'", *written])
    return f"CAST(('0x' || substr(md5({text}), 1, 15)) AS BIGINT)"


def scale_sql(u: str, size: str) -> str:
    return f"CAST((CAST({u} AS HUGEINT) * CAST({size} AS HUGEINT)) // 1152921504606846976 AS BIGINT)"


def months_sql(end: str, start: str) -> str:
    return f"CAST(trunc(({end} - {start}) / 30.44) AS INTEGER)"
