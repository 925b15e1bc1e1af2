from datetime import date

import pytest
from pyspark.sql import functions as F

from mirrorset import functions as fn


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_canonical_code(spark):
    raw = ["8", "8.0", "10.0", "10", " 4 ", "XM", "123", None, "1", ""]
    assert column(spark, raw, "string", fn.canonical_code) == ["08", "08", "10", "10", "04", "XM", "123", None, "01", ""]
    assert column(spark, [8.0, 10.0], "double", fn.canonical_code) == ["08", "10"]


def test_area_of(spark):
    assert column(spark, [1325, 7050, 99, 0, None], "int", fn.area_of) == [1300, 7000, 0, 0, None]


def test_parse_yyyymmdd(spark):
    assert column(spark, [20210216, 20210231, 7, None], "int", fn.parse_yyyymmdd) == [date(2021, 2, 16), None, None, None]


@pytest.mark.parametrize(
    "start,end,months",
    [
        (date(2024, 7, 7), date(2024, 11, 21), 4),
        (date(2023, 3, 19), date(2023, 10, 31), 7),
        (date(2021, 8, 31), date(2022, 6, 20), 9),
        (date(2023, 5, 12), date(2024, 10, 10), 16),
        (date(2024, 1, 31), date(2024, 1, 1), 0),
        (date(2024, 3, 31), date(2024, 1, 1), -2),
    ],
)
def test_months_between_trunc(spark, start, end, months):
    df = spark.createDataFrame([(start, end)], "s date, e date")
    assert df.select(fn.months_between_trunc(F.col("e"), F.col("s"))).first()[0] == months


def test_month_shift_overflows_or_clamps(spark):
    days = [date(2024, 4, 30), date(2024, 5, 15), date(2023, 4, 30)]
    assert column(spark, days, "date", lambda c: fn.add_months_overflow(c, -2)) == [
        date(2024, 3, 1), date(2024, 3, 15), date(2023, 3, 2)
    ]
    assert column(spark, [date(2024, 2, 29)], "date", lambda c: fn.subtract_years(c, 1)) == [date(2023, 2, 28)]


def test_scale_u60_is_exact_for_large_sizes(spark):
    draws = [0, 1, 12345, 2**31, 2**59 + 987654321, 2**60 - 1]
    for size in (1, 7, 2**31 - 1, 2**31, 2**40 + 12345, 2**61 - 1, 2**63 - 1):
        df = spark.createDataFrame([(i, u, size) for i, u in enumerate(draws)], "i int, u bigint, s bigint")
        got = [r[0] for r in df.orderBy("i").select(fn.scale_u60(F.col("u"), F.col("s"))).collect()]
        assert got == [u * size >> 60 for u in draws]
        fixed = [r[0] for r in df.orderBy("i").select(fn.scale_u60(F.col("u"), size)).collect()]
        assert fixed == got


def test_draws_are_uniform_and_independent_of_partitioning(spark):
    ids = spark.range(20000)
    u = fn.hash_u60(1, "t", F.col("id"))
    draws = ids.select(u.alias("u"), fn.uniform_int(u, 5, 9).alias("d"), fn.bernoulli(u, 0.8).alias("b"), fn.coin(u, "AM", "PM").alias("c"))
    got = draws.agg(F.sum(F.col("u").cast("decimal(38,0)")), F.min("d"), F.max("d"), F.avg("d"), F.avg(F.col("b").cast("int")), F.avg((F.col("c") == "AM").cast("int"))).first()
    assert (got[1], got[2]) == (5, 9)
    assert abs(got[3] - 7) < 0.05 and abs(got[4] - 0.8) < 0.02 and abs(got[5] - 0.5) < 0.02
    assert ids.repartition(17).select(u.alias("u")).agg(F.sum(F.col("u").cast("decimal(38,0)"))).first()[0] == got[0]
    other = ids.select(fn.hash_u60(1, "other", F.col("id")).alias("u")).agg(F.sum(F.col("u").cast("decimal(38,0)"))).first()[0]
    assert other != got[0]


def test_different_keys_are_written_differently(spark):
    pairs = [("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), ("a1", ""), ("a", "1"), (None, None), ("N", None)]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert len({r[0] for r in df.select(fn.hash_u60(1, "t", F.col("a"), F.col("b"))).collect()}) == len(pairs)


def test_draws_reach_all_places_of_large_pools(spark):
    u = fn.hash_u60(3, "wide", F.col("id"))
    for size in (2**33, 2**40):
        places = spark.range(20_000).select(fn.scale_u60(u, F.lit(size)).alias("p"))
        odd, low, high = places.agg(F.avg((F.col("p") % 2).cast("int")), F.min("p"), F.max("p")).first()
        assert abs(odd - 0.5) < 0.02 and 0 <= low < size / 1000 and size * 0.999 < high < size
