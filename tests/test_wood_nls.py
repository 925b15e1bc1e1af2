"""Curves on the scale of the yield against numpy's least squares."""

import math
import random

import numpy as np
import pytest

from mirrorset.operators.wood import wood_fit, wood_fit_nls

SCHEMA = "g string, h int, day int, milk double"


def curve(a, b, c, t):
    return a * t**b * math.exp(-c * t)


def rows_of(group, a, b, c, n, noise, seed):
    rng = random.Random(seed)
    return [(*group, t, max(0.1, curve(a, b, c, t) + rng.gauss(0, noise))) for t in (rng.randrange(1, 300) for _ in range(n))]


def gradient(rows, a, b, c):
    t, y = np.array([r[2] for r in rows], float), np.array([r[3] for r in rows])
    f = a * t**b * np.exp(-c * t)
    return np.array([(f * (y - f)).sum(), (f * (y - f) * np.log(t)).sum(), -(f * (y - f) * t).sum()]), ((y - f) ** 2).sum(), f


def test_squares_are_least(spark, limits):
    """The derivative of the sum of squares vanishes, and the sum is less than that of the fit of logarithms."""
    groups = {("x", 1): rows_of(("x", 1), 15, 0.2, 0.004, 300, 2.0, 1), (None, 2): rows_of((None, 2), 8, 0.3, 0.006, 250, 1.0, 2)}
    every = [r for rows in groups.values() for r in rows] + [("flat", 3, 10, 5.0)] * 4 + [("bad", 4, 0, 5.0), ("bad", 4, 5, None)]
    df = spark.createDataFrame(every, SCHEMA).repartition(6)
    got = {(r.g, r.h): r for r in wood_fit_nls(df, "day", "milk", ["g", "h"], 15, limits).collect()}
    start = {(r.g, r.h): r for r in wood_fit(df, "day", "milk", ["g", "h"]).collect()}
    assert set(got) == {*groups, ("flat", 3)} and got["flat", 3].a is None
    for key, rows in groups.items():
        r = got[key]
        slope, squares, f = gradient(rows, r.a, r.b, r.c)
        assert r.n == len(rows) and r.sse == pytest.approx(squares)
        assert np.all(np.abs(slope) < 1e-6 * np.array([1, 5, 300]) * (f * f).sum())
        assert squares < gradient(rows, start[key].a, start[key].b, start[key].c)[1]


def test_exact_curve_and_no_rows(spark):
    rows = [("x", 1, t, curve(20, 0.25, 0.005, t)) for t in range(1, 300, 7)]
    r = wood_fit_nls(spark.createDataFrame(rows, SCHEMA), "day", "milk", ["g"]).first()
    assert (r.a, r.b, r.c) == pytest.approx((20, 0.25, 0.005)) and r.sse < 1e-6
    assert wood_fit_nls(spark.createDataFrame([], SCHEMA), "day", "milk", ["g"]).collect() == []
