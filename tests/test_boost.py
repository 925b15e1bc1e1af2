"""Trees from histograms against plain loops over the rows, and against Spark's own boosted trees."""

import math
import random

import pytest
from pyspark.sql import functions as F

from mirrorset.operators import boost, model


def plain_fit(rows, settings):
    """Predictions for rows ``(y, x...)`` by loops."""
    count = len(rows[0]) - 1
    lows = [min(v for v in (r[i + 1] for r in rows) if v is not None) for i in range(count)]
    highs = [max(v for v in (r[i + 1] for r in rows) if v is not None) for i in range(count)]

    def at(i, v):
        return -1 if v is None else (v - lows[i]) * settings.ranges // (highs[i] - lows[i] + 1)

    bins = [[at(i, r[i + 1]) for i in range(count)] for r in rows]
    base = sum(r[0] for r in rows) // len(rows)
    predicted = [base] * len(rows)
    for _ in range(settings.trees):
        residual = [r[0] - p for r, p in zip(rows, predicted)]
        nodes = {1: list(range(len(rows)))}
        for level in range(settings.depth):
            for node, members in [x for x in nodes.items() if x[0] >= 1 << level]:
                total, best = sum(residual[m] for m in members), None
                for f in range(count):
                    for b in sorted({bins[m][f] for m in members}):
                        left = [m for m in members if bins[m][f] <= b]
                        if min(len(left), len(members) - len(left)) < settings.least:
                            continue
                        s = float(sum(residual[m] for m in left))
                        gain = s * s / len(left) + (total - s) * (total - s) / (len(members) - len(left))
                        if gain > float(total) * total / len(members) and (best is None or gain > best[0]):
                            best = (gain, f, b)
                if best:
                    _, f, b = best
                    del nodes[node]
                    nodes[2 * node] = [m for m in members if bins[m][f] <= b]
                    nodes[2 * node + 1] = [m for m in members if bins[m][f] > b]
        for members in nodes.values():
            value = math.floor(sum(residual[m] for m in members) / len(members)) * settings.rate[0] // settings.rate[1]
            for m in members:
                predicted[m] += value
    return predicted


def data(n):
    rng = random.Random(n)
    rows = []
    for i in range(n):
        x, z, k = rng.randrange(100), rng.choice([None, *range(-20, 20)]), rng.randrange(3)
        rows.append((i, 50 * x + (z or 0) * (z or 0) + 700 * (k == 1) + rng.randrange(-40, 40), x, z, k))
    return rows


SCHEMA = "id long, y long, x int, z int, k int"


@pytest.mark.parametrize("settings", [boost.Histograms(3, 3, 8, (1, 2), 5, 2), boost.Histograms(2, 2, 50, (1, 1), 1, 1)])
def test_equals_loops(spark, settings):
    rows = data(400)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    fitted = boost.fit_trees(df, "y", ["x", "z", "k"], settings)
    got = {r.id: r.p for r in fitted.predict(df, "p", every=2).collect()}
    assert got == dict(zip(range(400), plain_fit([r[1:] for r in rows], settings)))


def test_unseen_and_unknown_values(spark):
    rows = data(100)
    fitted = boost.fit_trees(spark.createDataFrame(rows, SCHEMA), "y", ["x", "z", "k"], boost.Histograms(2, 2))
    odd = spark.createDataFrame([(1, None, -500, 10**6, None), (2, None, None, None, 99)], SCHEMA)
    assert all(r.p is not None for r in fitted.predict(odd, "p").collect())


def test_no_rows_and_no_variance(spark):
    empty = boost.fit_trees(spark.createDataFrame([], SCHEMA), "y", ["x"])
    assert [r.p for r in empty.predict(spark.createDataFrame([(1, 2, 3, 4, 5)], SCHEMA), "p").collect()] == [0]
    same = spark.createDataFrame([(i, 7, i, i, 0) for i in range(30)], SCHEMA)
    assert {r.p for r in boost.fit_trees(same, "y", ["x"], boost.Histograms(2)).predict(same, "p").collect()} == {7}


def test_bounds_the_other_trees(spark):
    """Spark's boosted trees of the same size explain as much on rows held out, within a tenth."""
    df = model.hash_split(spark.createDataFrame(data(1500), SCHEMA), "id").fillna(0)
    train, held = df.where("is_train"), df.where("NOT is_train")
    ours = boost.fit_trees(train, "y", ["x", "z", "k"], boost.Histograms(8, 3, 32, (1, 2)))
    mine = ours.predict(held, "_out").select(F.col("y").cast("double").alias("_actual"), F.col("_out").cast("double"))
    target = model.Target("y", ("x", "z", "k"), False)
    theirs = model.fit_gbt(train, target, None, model.Boosting(trees=8, depth=3, rate=0.5)).transform(held)
    theirs = theirs.select(F.col("y").cast("double").alias("_actual"), F.col("_predicted").alias("_out"))
    a, b = model.r_squared(mine), model.r_squared(theirs)
    assert a > 0.8 and abs(a - b) < 0.1
