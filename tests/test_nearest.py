"""The nearest record against all pairs."""

import random

import pytest

from mirrorset.operators.nearest import nearest_record

SCHEMA = "id long, day int, months int, breed string"


def brute(real, synthetic, mismatch=50):
    def far(a, b):
        numbers = sum(abs((x or 0) - (y or 0)) + mismatch * ((x is None) != (y is None)) for x, y in zip(a[1:3], b[1:3]))
        return numbers + mismatch * (a[3] != b[3])

    return {s[0]: min((far(s, r), r[0]) for r in real) for s in synthetic}


def records(seed, n, start=0):
    rng = random.Random(seed)
    out = []
    for i in range(start, start + n):
        kind = rng.random()
        if kind < 0.35:  # one record that a third of all rows share
            out.append((i, 500, 5, "A"))
        elif kind < 0.7:  # a dense range
            out.append((i, 500 + rng.randrange(40), rng.randrange(12), rng.choice("AB")))
        elif kind < 0.75:
            out.append((i, None, rng.choice([None, 3]), rng.choice(["A", None])))
        else:
            out.append((i, rng.randrange(2_000) - 500, rng.randrange(60), rng.choice("ABC")))
    return out


def test_equals_all_pairs(spark, limits):
    leaf = 32 if limits.small(1) else 4
    real, synthetic = records(1, 700), records(2, 500, 10_000)
    got = nearest_record(
        spark.createDataFrame(real, SCHEMA).repartition(5), spark.createDataFrame(synthetic, SCHEMA), "id", "id",
        ["day", "months"], ["breed"], mismatch=50, leaf=leaf, limits=limits,
    ).collect()
    assert len(got) == len(synthetic)
    assert {r.id: (r.distance, r.nearest) for r in got} == brute(real, synthetic)


def test_dense_boxes_are_split(spark, monkeypatch):
    """The records of a box that pivots can split are never compared whole."""
    from mirrorset.operators import nearest

    seen = []
    compare = nearest._compare

    def watched(reached, leaves, *rest):
        seen.extend(leaf.groupBy(*[c for c in leaf.columns if c[0] == "k"]).count().agg({"count": "max"}).first()[0] or 0 for leaf in leaves)
        return compare(reached, leaves, *rest)

    monkeypatch.setattr(nearest, "_compare", watched)
    real = [(i, i % 1000 if i % 3 else 400 + i % 7, i % 11, "A") for i in range(3_000)]
    synthetic = [(i, 400 + i % 50, 3, "A") for i in range(200)]
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (real, synthetic)]
    got = nearest_record(*frames, "id", "id", ["day", "months"], ["breed"], mismatch=50, leaf=8).collect()
    assert {r.id: (r.distance, r.nearest) for r in got} == brute(real, synthetic)
    assert max(seen) <= 32


@pytest.mark.parametrize("real, synthetic", [([], records(3, 5)), (records(4, 5), []), ([(1, 2, 3, "A")], records(5, 9))])
def test_few_rows(spark, real, synthetic):
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (real, synthetic)]
    got = nearest_record(*frames, "id", "id", ["day", "months"], ["breed"], mismatch=50).collect()
    want = brute(real, synthetic) if real else {s[0]: (None, None) for s in synthetic}
    assert {r.id: (r.distance, r.nearest) for r in got} == want


def test_boxes_that_only_columns_tell_apart_are_not_entered(spark, monkeypatch):
    """Records at like distances from all pivots, but far from each other, do not meet."""
    from mirrorset.operators import nearest

    pairs = []
    compare = nearest._compare

    def watched(reached, leaves, *rest):
        pairs.extend(r.count() for r in reached)
        return compare(reached, leaves, *rest)

    monkeypatch.setattr(nearest, "_compare", watched)
    rng = random.Random(6)
    rows = [(i, rng.randrange(1_000), rng.randrange(1_000), rng.choice("ABCDE")) for i in range(3_000)]
    real, synthetic = rows[:2_000], rows[2_000:]
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (real, synthetic)]
    got = nearest_record(*frames, "id", "id", ["day", "months"], ["breed"], mismatch=500, leaf=8).collect()
    assert {r.id: (r.distance, r.nearest) for r in got} == brute(real, synthetic, 500)
    assert sum(pairs) < 3_000  # 3,677 with the ranges of the pivots alone
