from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from mirrorset.config import Limits
from mirrorset.functions.draws import hash_u60
from mirrorset.operators import sample
from mirrorset.operators.profile import profile

TIERS = [["cp", "breed"], ["breed"], ["cp"]]
OWN = {"cp": "cp", "breed": "breed"}


@pytest.fixture(scope="module")
def source(spark):
    """Shares 0.42/0.58, 0.5/0.5 and three times a third."""
    counts = [(1301, "04", 1, 42), (1301, "04", 2, 58), (1325, "01", 1, 1), (1325, "01", 2, 1),
              (1325, "04", 1, 1), (1325, "04", 2, 1), (1325, "04", 3, 1), (1400, None, 9, 5)]
    return spark.createDataFrame(counts, "cp int, breed string, value int, n int")


@pytest.fixture(scope="module")
def targets(spark):
    cells = [(1325, "04"), (9999, "04"), (1325, "XX"), (9999, "XX"), (None, "04"), (1325, None), (None, None), (1400, None)]
    probes = spark.createDataFrame(cells, "cp int, breed string")
    return probes.crossJoin(spark.range(6000)).withColumn("key", F.monotonically_increasing_id())


def prof(source, limits):
    return profile(source, "value", ["cp", "breed"], F.col("n"), limits)


def drawn(source, targets, limits, pool):
    return sample.sample_by_tiers(targets, prof(source, limits), TIERS, OWN, ["id", "cp", "breed"], "out", 5, "t", 1, pool)


def shares(df):
    got = defaultdict(Counter)
    for r in df.groupBy("cp", "breed", "out").count().collect():
        got[(r.cp, r.breed)][r.out] += r["count"]
    return {k: {v: n / sum(c.values()) for v, n in c.items()} for k, c in got.items()}


def close(got, want, tolerance=0.03):
    return set(got) == set(want) and all(abs(got[v] - want[v]) < tolerance for v in want)


def test_profile_shares(source, limits):
    got = {(r.cp, r.breed, r.value): (r.n, r.tot, r.share) for r in prof(source, limits).shares().collect()}
    assert got[(1301, "04", 2)] == (58, 100, 0.58)
    assert got[(1400, None, 9)] == (5, 5, 1.0)
    total = {(r.value): r.share for r in profile(source, "value", (), F.col("n"), limits).shares().collect()}
    assert total[9] == 5 / 110


def test_null_values_are_not_profiled(spark, limits):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "v string")
    assert [tuple(r) for r in profile(df, "v", limits=limits).shares().collect()] == [("a", 2, 2, 1.0)]


def test_tiers(source, targets, limits):
    dist = sample.tiered_distribution(prof(source, limits), TIERS)
    tagged = sample.tiered_lookup(targets.where("id = 0"), dist, OWN)
    got = {(r.cp, r.breed): r.tier for r in tagged.collect()}
    assert got == {(1325, "04"): 1, (9999, "04"): 2, (1325, "XX"): 3, (9999, "XX"): None, (None, "04"): 2,
                   (1325, None): 3, (None, None): None, (1400, None): 3}


def test_cell_pool(source, targets, limits):
    got = shares(drawn(source, targets, limits, "cells"))
    third = {1: 1 / 3, 2: 1 / 3, 3: 1 / 3}
    assert close(got[(1325, "04")], third)
    assert close(got[(9999, "04")], {1: 0.3767, 2: 0.4567, 3: 0.1667})
    assert close(got[(None, "04")], {1: 0.3767, 2: 0.4567, 3: 0.1667})
    assert close(got[(1325, "XX")], {1: 5 / 12, 2: 5 / 12, 3: 1 / 6})
    assert got[(9999, "XX")] == {1: 1.0} and got[(1400, None)] == {9: 1.0}


def test_row_pool(source, targets, limits):
    got = shares(drawn(source, targets, limits, "rows"))
    assert close(got[(9999, "04")], {1: 43 / 103, 2: 59 / 103, 3: 1 / 103})


def test_both_plans_and_any_partitioning_agree(source, targets):
    want = {(r.key, r.out) for r in drawn(source, targets, Limits(), "cells").collect()}
    large = drawn(source.repartition(5), targets.repartition(17), Limits(small_rows=0, salts=20), "cells")
    assert {(r.key, r.out) for r in large.collect()} == want
    assert len(want) == 48000


def test_draws_hit_the_exact_interval(spark, hot, limits):
    """Every draw against a brute-force cumulative sum, with one hot group and skewed weights."""
    source = hot.where(F.col("g").isNotNull()).withColumn("w", 1 + F.col("id") % 90 * F.col("id"))
    p = profile(source, "v", ["g"], F.col("w"), limits)
    counts = defaultdict(Counter)
    for r in source.collect():
        counts[r.g][r.v] += r.w
    rows = hot.select("id", F.col("g").alias("mine"), hash_u60(3, "d", F.col("id")).alias("u"))
    got = sample.sample_from(rows, p, {"g": "mine"}, F.col("u"), "out").collect()
    assert len(got) == 2000
    for r in got:
        if r.mine is None:
            assert r.out is None
            continue
        cells = sorted(counts[r.mine].items())
        point, seen = r.u * sum(n for _, n in cells) >> 60, 0
        for value, n in cells:
            seen += n
            if point < seen:
                break
        assert r.out == value


def test_floor_and_default(spark, limits):
    source = spark.createDataFrame([("a", 0), ("a", 1), ("b", 5)], "k string, m int")
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, id int")
    p = profile(source, "m", ["k"], limits=limits)
    out = sample.sample_by_tiers(rows, p, [["k"]], {"k": "k"}, ["id"], "m", 1, "f", 10, floor=2)
    assert {r.k: r.m for r in out.collect()} == {"a": 2, "b": 5, "c": 10}


def test_empty_source_gives_the_default(spark, source, targets, limits):
    p = prof(source.where("false"), limits)
    out = sample.sample_by_tiers(targets.where("id < 3"), p, [*TIERS, []], OWN, ["key"], "out", 1, "e", 10)
    assert {r.out for r in out.collect()} == {10} and out.count() == 24
