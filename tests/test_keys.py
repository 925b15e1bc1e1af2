from collections import defaultdict

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from mirrorset.config import Limits
from mirrorset.operators import joins, keys


@pytest.fixture(autouse=True, params=["true", "false"], ids=["one part", "many parts"])
def parts_per_table(spark, request):
    """Small tables end up in one part unless Spark is told to keep all of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", request.param)
    yield request.param
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_tables_are_really_cut_into_parts(hot, parts_per_table):
    parts = {r[0] for r in keys._in_order(hot, ["g", "v", "id"]).select("_part").distinct().collect()}
    assert (len(parts) > 4) == (parts_per_table == "false")


def test_dense_index_is_contiguous_in_order(spark, hot):
    got = keys.dense_index(hot, ["v", "id"], 100).orderBy("v", "id").collect()
    assert [r.idx for r in got] == list(range(100, 2100))
    assert set(got[0].asDict()) == {"id", "g", "v", "idx"}


@pytest.mark.parametrize("parts", [1, 17])
def test_running_total_and_rank_match_brute_force(spark, hot, parts):
    weight = F.col("v") % 7
    got = keys.running_total(hot.repartition(parts), ["v", "id"], weight, "total", ["g"]).collect()
    ranks = {r.id: r["rank"] for r in keys.group_rank(hot, ["g"], ["v", "id"]).collect()}
    groups = defaultdict(list)
    for r in got:
        groups[r.g].append(r)
    assert len(got) == 2000 and len(groups["hot"]) == 667
    for rows in groups.values():
        total = 0
        for position, r in enumerate(sorted(rows, key=lambda r: (r.v, r.id)), start=1):
            total += r.v % 7
            assert (r.total, ranks[r.id]) == (total, position)


def test_counted_tables_give_the_same_numbers(spark, hot):
    for large, small in (
        (keys.group_rank(hot, ["g"], ["v", "id"]), keys.group_rank(hot, ["g"], ["v", "id"], rows=2000)),
        (keys.dense_index(hot, ["v", "id"], 5), keys.dense_index(hot, ["v", "id"], 5, rows=2000)),
        (keys.running_total(hot, ["id"], F.col("v"), "t"), keys.running_total(hot, ["id"], F.col("v"), "t", rows=2000)),
    ):
        assert large.dtypes == small.dtypes and large.exceptAll(small).count() == 0


def test_running_total_without_keys(spark, hot):
    got = keys.running_total(hot, ["id"], F.lit(2), "total").orderBy("id").collect()
    assert [r.total for r in got] == list(range(2, 4002, 2))


def test_a_group_that_spans_all_parts(spark):
    one = spark.range(5000).select("id", F.lit(1).alias("g"))
    got = keys.group_rank(one, ["g"], ["id"]).orderBy("id").collect()
    assert [r["rank"] for r in got] == list(range(1, 5001))


def test_keys_of_an_empty_table(spark, hot):
    none = hot.where("false")
    assert keys.dense_index(none, ["id"]).count() == 0
    assert keys.group_rank(none, ["g"], ["id"]).count() == 0


def test_first_per_key(spark, hot):
    got = {r.g: r.id for r in keys.first_per_key(hot, ["g"], ["v", "id"], ["id"]).collect()}
    expected = {}
    for r in sorted(hot.collect(), key=lambda r: (r.v, r.id)):
        expected.setdefault(r.g, r.id)
    assert got == expected


@pytest.mark.parametrize("span", [1, 2, 97, 1000, 5_973_842])
def test_surrogate_keys_are_distinct(spark, span):
    n = min(span, 5000)
    got = [r[0] for r in spark.range(n).select(keys.surrogate_key(F.col("id"), 50, 50 + span, 3)).collect()]
    assert len(set(got)) == n and min(got) >= 50 and max(got) < 50 + span


def test_surrogate_keys_of_a_wide_range(spark):
    span = 10**15
    got = [r[0] for r in spark.range(span - 3, span).select(keys.surrogate_key(F.col("id"), 0, span, 11)).collect()]
    assert len(set(got)) == 3 and all(0 <= k < span for k in got)


def test_surrogate_key_fails_when_the_range_is_too_small(spark):
    with pytest.raises(PySparkException, match="more than 10 keys"):
        spark.range(11).select(keys.surrogate_key(F.col("id"), 0, 10, 1)).collect()


def test_pick_existing(spark):
    pool = spark.range(7).select((F.col("id") * 10).alias("k"))
    got = keys.pick_existing(spark.range(700), ["id"], pool, "k", "picked", 1).groupBy("picked").count().collect()
    assert {r.picked for r in got} == {0, 10, 20, 30, 40, 50, 60}
    assert sum(r["count"] for r in got) == 700 and max(r["count"] for r in got) < 160


def test_neighbours_by_ordinal_stop_at_gaps(spark):
    rows = spark.createDataFrame([(1, 1, 10), (1, 2, 20), (1, 4, 40), (2, 1, 5), (3, None, 7)], "k int, o int, v int")
    previous = {(r.k, r.o): r.p for r in joins.previous_by_ordinal(rows, "k", "o", {"p": "v"}).collect()}
    following = {(r.k, r.o): r.n for r in joins.next_by_ordinal(rows, "k", "o", {"n": "v"}).collect()}
    assert previous == {(1, 1): None, (1, 2): 10, (1, 4): None, (2, 1): None, (3, None): None}
    assert following == {(1, 1): 20, (1, 2): None, (1, 4): None, (2, 1): None, (3, None): None}


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [True, False])
def test_lookup_join_is_the_same_when_salted(spark, hot, how, null_safe):
    lookup = hot.where("g is null or g <> 'g7'").groupBy(F.col("g").alias("lg")).agg(F.count("*").alias("n"))
    plain = joins.lookup_join(hot, lookup, {"g": "lg"}, how, True, null_safe=null_safe)
    for salts in (1, 10, 5000):
        salted = joins.lookup_join(hot, lookup, {"g": "lg"}, how, False, Limits(salts=salts), null_safe)
        assert salted.columns == plain.columns
        assert plain.exceptAll(salted).count() == 0 and salted.count() == plain.count()


def test_replace_column_and_pool(spark):
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, z int")
    updates = spark.createDataFrame([(1, "x")], "k int, v string")
    assert sorted(tuple(r) for r in joins.replace_column(rows, updates, "k", "v").collect()) == [(1, 1, "x"), (2, 2, None)]
    kept = joins.replace_column(rows, updates, "k", "v", keep_old=True)
    assert sorted(tuple(r) for r in kept.collect()) == [(1, 1, "x"), (2, 2, "b")]
    pooled = joins.keyed_or_pool(rows.select("k"), updates, "k", "k", "v", F.lit("pool"))
    assert sorted(tuple(r) for r in pooled.collect()) == [(1, "x"), (2, "pool")]


def test_running_total_with_nulls_is_the_same_in_both_plans(spark):
    for seed in range(4):
        rows = spark.range(600).selectExpr(
            "id",
            f"CASE WHEN xxhash64(id, {seed}) % 7 = 0 THEN NULL ELSE abs(xxhash64(id, {seed}, 1)) % 3 END AS g",
            f"CASE WHEN id < 150 OR id > 400 OR xxhash64(id, {seed}, 2) % 3 = 0 THEN NULL ELSE id END AS w",
        )
        for names in ((), ("g",)):
            spread = keys.running_total(rows, ["id"], F.col("w"), "t", names)
            plain = keys.running_total(rows, ["id"], F.col("w"), "t", names, rows=600)
            assert {tuple(r) for r in spread.collect()} == {tuple(r) for r in plain.collect()}


def test_hot_keys_that_the_lookup_lacks_are_spread(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, F.lit(-1)).when(F.col("id") % 3 > 0, F.col("id") % 500).alias("g"))
    lookup = spark.range(500).select(F.col("id").alias("lg"), (F.col("id") * 2).alias("v"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.lookup_join(rows, lookup, {"g": "lg"}, "left", False, Limits(salts=400))
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 20_000 and max(sizes) < 2 * 20_000 / 8


@pytest.mark.parametrize("span", [1, 2, 3, 7, 10, 101, 1000, 1023, 2500])
def test_feistel_keys_fill_their_range(spark, span):
    got = [r[0] for r in spark.range(span).select(keys.feistel_key(F.col("id"), 50, 50 + span, "s")).collect()]
    assert sorted(got) == list(range(50, 50 + span))


def test_feistel_keys_follow_no_stride(spark):
    """Neighbouring indexes lie at no fixed distance, and another secret gives other keys."""
    span = 10_000_019
    two = spark.range(2000).select(
        keys.feistel_key(F.col("id"), 0, span, "s").alias("a"), keys.feistel_key(F.col("id"), 0, span, "t").alias("b")
    )
    rows = [tuple(r) for r in two.collect()]
    strides = {(y[0] - x[0]) % span for x, y in zip(rows, rows[1:])}
    assert len(strides) > 1990 and sum(a == b for a, b in rows) < 5
    assert len({a for a, _ in rows}) == 2000 and 0.45 < sum(a < span / 2 for a, _ in rows) / 2000 < 0.55


def test_feistel_key_fails_when_the_range_is_too_small(spark):
    with pytest.raises(Exception, match="more than 10 keys"):
        spark.range(11).select(keys.feistel_key(F.col("id"), 0, 10, "s")).collect()


@pytest.mark.parametrize("span", [1, 10, 97])
def test_keys_behind_the_range_go_on_into_the_next_ones(spark, span):
    """Whole ranges are filled one after the other; the first holds the same keys as without."""
    n = 3 * span
    two = spark.range(n).select(
        "id",
        keys.surrogate_key(F.col("id"), 50, 50 + span, 3, beyond=True).alias("a"),
        keys.feistel_key(F.col("id"), 50, 50 + span, "s", beyond=True).alias("b"),
    )
    rows = two.orderBy("id").collect()
    plain = spark.range(span).select(
        "id", keys.surrogate_key(F.col("id"), 50, 50 + span, 3).alias("a"), keys.feistel_key(F.col("id"), 50, 50 + span, "s").alias("b")
    )
    assert rows[:span] == plain.orderBy("id").collect()
    for turn in range(3):
        part, want = rows[turn * span : (turn + 1) * span], list(range(50 + turn * span, 50 + (turn + 1) * span))
        assert sorted(r.a for r in part) == want and sorted(r.b for r in part) == want


@pytest.mark.parametrize("name", ["surrogate_key", "surrogate_key_feistel"])
def test_registered_keys_of_more_orders_than_animal_ids(spark, tmp_path, monkeypatch, name):
    from mirrorset.catalog import scalars

    spark.range(50).withColumnRenamed("id", "o_orderkey").write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(scalars, "ANIMAL_HIGH", scalars.ANIMAL_LOW + 20)
    got = [r.surrogate for r in getattr(scalars, name)(spark, str(tmp_path)).collect()]
    assert len(got) == 50 and len(set(got)) == 50
