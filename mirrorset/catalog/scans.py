"""Sources, sinks, schemas, projections and filters."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mirrorset import schema, sources
from mirrorset.catalog.registry import query
from mirrorset.catalog.roles import AS_OF, LACTATIONS, lactations, table
from mirrorset.operators import calendar, joins, sequence

_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _new_folder(spark: SparkSession) -> str:
    return f"{sources.staging_root(spark)}/copy-{uuid.uuid4().hex}"


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in _NAMES))
def load_tables(spark: SparkSession, sf: str) -> DataFrame:
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
        for name, df in sources.load_tables(spark, sf, _NAMES).items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


@query("SELECT * FROM customer")
def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer")


_JOINED = """SELECT c_mktsegment, o_orderstatus, count(*) AS n, max(o_totalprice) AS top_price
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 1000 GROUP BY c_mktsegment, o_orderstatus"""


@query(_JOINED)
def scan_sql(spark: SparkSession, sf: str) -> DataFrame:
    sources.register_tables(sources.load_tables(spark, sf, ["orders", "customer"]))
    return spark.sql(_JOINED)


@query("SELECT DISTINCT c_mktsegment FROM customer")
def dictionary_values(spark: SparkSession, sf: str) -> DataFrame:
    return sources.dictionary_values(table(spark, sf, "customer"), "c_mktsegment")


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def copy_tables(spark: SparkSession, sf: str) -> DataFrame:
    tables = sources.load_tables(spark, sf, ["nation", "region"])
    out = sources.copy_tables(tables, ["nation", "region"], _new_folder(spark))
    both = out["nation"].join(out["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return both.select("n_nationkey", "n_name", "r_name")


@query("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(NULL AS VARCHAR) AS c_note FROM customer")
def write_table(spark: SparkSession, sf: str) -> DataFrame:
    target = StructType.fromDDL("c_custkey bigint, c_name string, c_nationkey bigint, c_note string")
    return sources.write_table(table(spark, sf, "customer"), _new_folder(spark), target)


@query("SELECT * FROM customer")
def empty_like(spark: SparkSession, sf: str) -> DataFrame:
    """An empty frame with the columns of a table, filled with the table's rows."""
    customers = table(spark, sf, "customer")
    return sources.empty_like(customers).unionByName(customers)


@query(
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate, "
    "CAST(NULL AS VARCHAR) AS l_comment FROM lineitem"
)
def enforce_schema(spark: SparkSession, sf: str) -> DataFrame:
    target = "l_orderkey bigint, l_linenumber int, l_quantity int, l_shipdate date, l_comment string"
    return schema.enforce_schema(table(spark, sf, "lineitem"), StructType.fromDDL(target))


@query(
    "SELECT s_suppkey AS c_custkey, s_name AS c_name, s_nationkey AS c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, "
    "CAST(NULL AS VARCHAR) AS c_mktsegment FROM supplier"
)
def conform_to(spark: SparkSession, sf: str) -> DataFrame:
    renamed = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name")
    )
    return schema.conform_to(renamed, table(spark, sf, "customer"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    return schema.check_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "SELECT user_id, count(*) AS n FROM events WHERE user_id IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM supplier WHERE s_suppkey = user_id) GROUP BY user_id"
)
def check_refs(spark: SparkSession, sf: str) -> DataFrame:
    return schema.check_refs(table(spark, sf, "events"), table(spark, sf, "supplier"), "user_id", "s_suppkey")


@query("SELECT o_orderstatus, o_custkey, o_orderkey, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def select_first(spark: SparkSession, sf: str) -> DataFrame:
    return joins.select_first(table(spark, sf, "orders"), "o_orderstatus", "o_custkey")


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").drop("c_acctbal", "c_mktsegment", "not_there")


@query("SELECT c_custkey AS noan, c_mktsegment AS actiel, 'F' AS sexean FROM customer")
def rename_with_constant(spark: SparkSession, sf: str) -> DataFrame:
    renamed = table(spark, sf, "customer").withColumnRenamed("c_custkey", "noan")
    return renamed.select("noan", F.col("c_mktsegment").alias("actiel"), F.lit("F").alias("sexean"))


@query(
    "SELECT o_orderkey, o_custkey, m AS o_totalprice FROM orders LEFT JOIN "
    "(SELECT l_orderkey, max(l_extendedprice) AS m FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey"
)
def replace_column(spark: SparkSession, sf: str) -> DataFrame:
    dearest = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    updates = dearest.agg(F.max("l_extendedprice").alias("o_totalprice"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.replace_column(orders, updates, "o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders")
def conditional_assign(spark: SparkSession, sf: str) -> DataFrame:
    price = F.when(F.col("o_orderstatus") == "P", 0.0).otherwise(F.col("o_totalprice"))
    return table(spark, sf, "orders").select("o_orderkey", price.alias("o_totalprice"))


@query("SELECT s_suppkey, s_nationkey FROM supplier WHERE s_nationkey <> 0 AND s_suppkey <> 7")
def sentinel_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = table(spark, sf, "supplier").where((F.col("s_nationkey") != 0) & (F.col("s_suppkey") != 7))
    return kept.select("s_suppkey", "s_nationkey")


@query(f"WITH {LACTATIONS} SELECT id, noan, tar FROM lact WHERE tar IS NOT NULL")
def not_null_filter(spark: SparkSession, sf: str) -> DataFrame:
    return lactations(spark, sf).where(F.col("tar").isNotNull()).select("id", "noan", "tar")


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('view', 'click')")
def in_list_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").where(F.col("event_type").isin("view", "click")).select("event_id", "event_type")


@query(
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate BETWEEN "
    "(SELECT max(o_orderdate) - INTERVAL 12 MONTH FROM orders) AND (SELECT max(o_orderdate) FROM orders)"
)
def last_period(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.last_period(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", 12)


@query(
    f"WITH {LACTATIONS} SELECT a.id, a.noan, a.nolact FROM lact a WHERE EXISTS "
    "(SELECT 1 FROM lact b WHERE b.noan = a.noan AND b.nolact = a.nolact + 1)"
)
def exists_next(spark: SparkSession, sf: str) -> DataFrame:
    rows = lactations(spark, sf).select("id", "noan", "nolact")
    later = rows.select(F.col("noan").alias("_n"), (F.col("nolact") - 1).alias("_o"))
    return rows.join(later, (F.col("noan") == F.col("_n")) & (F.col("nolact") == F.col("_o")), "left_semi")


@query(f"WITH {LACTATIONS} SELECT id, vel FROM lact WHERE vel IS NULL OR vel < DATE '2000-01-01'")
def drop_future(spark: SparkSession, sf: str) -> DataFrame:
    return sequence.drop_future(lactations(spark, sf), "vel", date(2000, 1, 1)).select("id", "vel")


@query(f"WITH {LACTATIONS} SELECT id, CASE WHEN tar <= DATE '{AS_OF}' THEN tar END AS tar FROM lact")
def censor_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return sequence.censor_as_of(lactations(spark, sf), "tar", AS_OF).select("id", "tar")


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def normalise_dates(spark: SparkSession, sf: str) -> DataFrame:
    return sequence.normalise_dates(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey > 10 AND c_mktsegment >= 'F'")
def sqlite_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The table as SQLite files, one a partition, read back by ranges of rowids with the comparisons pushed down."""
    path = sources.staged_path(spark, "customer")
    sources.write_sqlite(table(spark, sf, "customer").repartition(4, "c_custkey"), path, "customer")
    rows = sources.read_sqlite(spark, path, "customer", rows=2_000)
    kept = rows.where("c_nationkey > 10 AND c_mktsegment >= 'F'")
    return kept.select("c_custkey", "c_name", "c_acctbal")
