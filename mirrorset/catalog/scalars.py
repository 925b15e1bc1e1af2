"""Codes, dates, numbers and random draws."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorset import functions as fn
from mirrorset.catalog.registry import query
from mirrorset.catalog.roles import SEED, hash_sql, months_sql, scale_sql, table
from mirrorset.functions.draws import TWO60
from mirrorset.operators import keys
from mirrorset.operators.cohort import ANIMAL_HIGH, ANIMAL_LOW

_RAW = """CASE p_partkey % 5 WHEN 0 THEN CAST(p_size AS {text}) WHEN 1 THEN concat(CAST(p_size AS {text}), '.0')
  WHEN 2 THEN concat(' ', CAST(p_size AS {text}), ' ') WHEN 3 THEN upper(substr(p_name, 1, 2)) END"""


@query(
    f"SELECT p_partkey, CASE WHEN regexp_full_match(c, '[0-9]+') AND length(c) < 2 THEN lpad(c, 2, '0') ELSE c END AS code "
    f"FROM (SELECT p_partkey, regexp_replace(trim({_RAW.format(text='VARCHAR')}), '\\.0$', '') AS c FROM part)"
)
def canonical_code(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr(_RAW.format(text="STRING"))
    return table(spark, sf, "part").select("p_partkey", fn.canonical_code(raw).alias("code"))


@query("SELECT p_partkey, CAST((p_partkey // 100) * 100 AS INTEGER) AS area FROM part")
def area_of(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", fn.area_of(F.col("p_partkey"), 100).alias("area"))


@query(
    "SELECT o_orderkey, CAST(try_strptime(CAST(n AS VARCHAR), '%Y%m%d') AS DATE) AS born FROM (SELECT o_orderkey, "
    "CASE WHEN o_orderkey % 7 = 0 THEN 20010231 ELSE year(o_orderdate) * 10000 + month(o_orderdate) * 100 "
    "+ day(o_orderdate) END AS n FROM orders)"
)
def parse_yyyymmdd(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate")
    number = F.when(F.col("o_orderkey") % 7 == 0, 20010231).otherwise(
        F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    )
    return table(spark, sf, "orders").select("o_orderkey", fn.parse_yyyymmdd(number).alias("born"))


@query("SELECT c_custkey, 'ACTIEL_' || trim(c_mktsegment) AS label, trim(CAST(c_nationkey AS VARCHAR)) AS place FROM customer")
def text_columns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey",
        fn.prefixed("ACTIEL_", fn.clean_text(F.col("c_mktsegment"))).alias("label"),
        fn.clean_text(F.col("c_nationkey")).alias("place"),
    )


@query(
    "SELECT o_orderkey, CAST(DATE '2001-08-02' - d AS INTEGER) AS days, d + CAST(o_orderkey % 90 AS INTEGER) AS later, "
    "CAST(d - INTERVAL 60 MONTH AS DATE) AS five_years_before, CAST(month(d) AS INTEGER) AS month, "
    "strftime(d, '%Y-%m-%d') AS iso FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"
)
def day_arithmetic(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.datediff(F.lit("2001-08-02").cast("date"), day).alias("days"),
        fn.add_days(day, F.col("o_orderkey") % 90).alias("later"),
        fn.subtract_years(day, 5).alias("five_years_before"),
        F.month(day).alias("month"),
        F.date_format(day, "yyyy-MM-dd").alias("iso"),
    )


@query(
    f"SELECT o_orderkey, {months_sql('CAST(o_orderdate AS DATE)', chr(39).join(['DATE ', '1998-01-15', '']))} AS months "
    "FROM orders"
)
def months_trunc(spark: SparkSession, sf: str) -> DataFrame:
    months = fn.months_between_trunc(F.to_date("o_orderdate"), F.lit("1998-01-15").cast("date"))
    return table(spark, sf, "orders").select("o_orderkey", months.alias("months"))


@query(
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) - INTERVAL 2 MONTH AS DATE) "
    "+ CAST(day(o_orderdate) - 1 AS INTEGER) AS earlier, CAST(CAST(o_orderdate AS DATE) - INTERVAL 2 MONTH AS DATE) "
    "AS clamped FROM orders"
)
def months_overflow(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        fn.add_months_overflow(day, -2).alias("earlier"),
        F.add_months(day, -2).alias("clamped"),
    )


@query(
    "SELECT p_partkey, CAST(floor(p_retailprice / 7) AS BIGINT) AS lower, p_partkey // 28 AS steps, "
    "greatest(p_size, 2) AS least_two, least(p_size, 40) AS most_forty, round(p_size / 4, 0) AS half_up, "
    "round_even(p_size / 4, 0) AS half_even FROM part"
)
def number_functions(spark: SparkSession, sf: str) -> DataFrame:
    quarter = F.col("p_size") / 4
    return table(spark, sf, "part").select(
        "p_partkey",
        F.floor(F.col("p_retailprice") / 7).alias("lower"),
        F.expr("p_partkey div 28").alias("steps"),
        F.greatest("p_size", F.lit(2)).alias("least_two"),
        F.least("p_size", F.lit(40)).alias("most_forty"),
        F.round(quarter, 0).alias("half_up"),
        F.bround(quarter, 0).alias("half_even"),
    )


@query("SELECT p_partkey, unnest(range(p_partkey, p_partkey + p_size, 3)) AS id FROM part")
def stepped_range(spark: SparkSession, sf: str) -> DataFrame:
    numbers = F.sequence(F.col("p_partkey"), F.col("p_partkey") + F.col("p_size") - 1, F.lit(3))
    return table(spark, sf, "part").select("p_partkey", F.explode(numbers).alias("id"))


_U = hash_sql("draw", "c_custkey", "c_name")


@query(
    f"SELECT c_custkey, u, 99000000 + {scale_sql('u', '1000000')} AS code, u < {int(0.8 * TWO60)} AS known, "
    f"CASE WHEN u % 2 = 0 THEN 'AM' ELSE 'PM' END AS slot FROM (SELECT c_custkey, {_U} AS u FROM customer)"
)
def hash_draws(spark: SparkSession, sf: str) -> DataFrame:
    u = fn.hash_u60(SEED, "draw", F.col("c_custkey"), F.col("c_name"))
    return table(spark, sf, "customer").withColumn("u", u).select(
        "c_custkey",
        "u",
        fn.uniform_int(F.col("u"), 99_000_000, 99_999_999).alias("code"),
        fn.bernoulli(F.col("u"), 0.8).alias("known"),
        fn.coin(F.col("u"), "AM", "PM").alias("slot"),
    )


_DAM = scale_sql(hash_sql("dam", "o_orderkey"), "(SELECT count(*) FROM customer)")


@query(
    "WITH c AS (SELECT c_custkey AS picked, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer) "
    f"SELECT o_orderkey, picked FROM (SELECT o_orderkey, {_DAM} AS d FROM orders) LEFT JOIN c ON d = i"
)
def pick_existing(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_orderkey")
    return keys.pick_existing(rows, ["o_orderkey"], table(spark, sf, "customer"), "c_custkey", "picked", SEED, "dam")


_FACTOR, _SHIFT = keys.permutation(SEED, ANIMAL_HIGH - ANIMAL_LOW)


@query(
    f"SELECT o_orderkey, {ANIMAL_LOW} + CAST((CAST({_FACTOR} AS HUGEINT) * (row_number() OVER (ORDER BY o_orderkey) - 1) "
    f"+ {_SHIFT}) % {ANIMAL_HIGH - ANIMAL_LOW} AS BIGINT) AS surrogate FROM orders"
)
def surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct keys of all orders; those behind the range of animal ids go on into the next ranges."""
    rows = keys.dense_index(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])
    key = keys.surrogate_key(F.col("idx"), ANIMAL_LOW, ANIMAL_HIGH, SEED, beyond=True)
    return rows.select("o_orderkey", key.alias("surrogate"))


_SECRET = "herd book"
_SIDES = keys.feistel_sides(ANIMAL_HIGH - ANIMAL_LOW)


def _mixed_sql(digit: str, sides: int) -> str:
    text = f"'{len(_SECRET)}:{_SECRET}:' || (step % {keys.FEISTEL_ROUNDS} + 1) || ':' || {digit}"
    return f"CAST(('0x' || substr(md5({text}), 1, 15)) AS BIGINT) % {sides}"


@query(
    f"""WITH RECURSIVE walk(o_orderkey, step, l, r) AS (
  SELECT o_orderkey, 0, n // {_SIDES[1]}, n % {_SIDES[1]} FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders)
  UNION ALL
  SELECT o_orderkey, step + 1, CASE WHEN step % 2 = 0 THEN (l + {_mixed_sql("r", _SIDES[0])}) % {_SIDES[0]} ELSE l END,
    CASE WHEN step % 2 = 0 THEN r ELSE (r + {_mixed_sql("l", _SIDES[1])}) % {_SIDES[1]} END
  FROM walk WHERE step % {keys.FEISTEL_ROUNDS} > 0 OR step = 0 OR l * {_SIDES[1]} + r >= {ANIMAL_HIGH - ANIMAL_LOW})
SELECT o_orderkey, {ANIMAL_LOW} + l * {_SIDES[1]} + r AS surrogate FROM walk
WHERE step > 0 AND step % {keys.FEISTEL_ROUNDS} = 0 AND l * {_SIDES[1]} + r < {ANIMAL_HIGH - ANIMAL_LOW}"""
)
def surrogate_key_feistel(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct keys of all orders, by a permutation that known pairs do not give away; as above behind the range."""
    rows = keys.dense_index(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])
    key = keys.feistel_key(F.col("idx"), ANIMAL_LOW, ANIMAL_HIGH, _SECRET, beyond=True)
    return rows.select("o_orderkey", key.alias("surrogate"))
