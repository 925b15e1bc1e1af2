"""Distances between whole distributions against plain counts, and sampling of a stream against that of a table."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mirrorset.functions.draws import hash_u60
from mirrorset.operators import audit
from mirrorset.operators.profile import profile
from mirrorset.operators.sample import sample_conditional, tiered_distribution
from mirrorset.streaming import sample_stream


def side(seed, n, hot):
    rng = random.Random(seed)
    return [
        (rng.choice("ab") if rng.random() < 0.9 else None, hot if rng.random() < 0.34 else rng.choice([None, *range(40)]))
        for _ in range(n)
    ]


def test_ks(spark, limits):
    real, made = side(1, 900, 7), side(2, 500, 9)
    frames = [spark.createDataFrame(rows, "k string, v int").repartition(5) for rows in (real, made)]
    got = audit.ks_distance(*frames, "v", limits).first()
    a, b = (Counter(v for _, v in rows if v is not None) for rows in (real, made))
    gaps = [(abs(sum(n for x, n in a.items() if x <= v) / a.total() - sum(n for x, n in b.items() if x <= v) / b.total()), v) for v in range(40)]
    far = max(gaps)[0]
    assert (got.n_source, got.n_synthetic) == (a.total(), b.total())
    assert got.distance == pytest.approx(far) and got.at_value == min(v for g, v in gaps if g == far)


def test_ks_without_rows(spark):
    some = spark.createDataFrame([("a", 1)], "k string, v int")
    got = audit.ks_distance(some, some.limit(0), "v").first()
    assert (got.n_source, got.n_synthetic, got.distance) == (1, 0, None)
    assert audit.ks_distance(some.limit(0), some.limit(0), "v").first().n_source == 0


def information(rows):
    n, one, two = len(rows), Counter(a for a, _ in rows), Counter(b for _, b in rows)
    return sum(c / n * math.log(c * n / (one[a] * two[b])) for (a, b), c in Counter(rows).items())


def test_pairs(spark, limits):
    real, made = side(3, 800, 7), [(("a" if v else "b"), v) for _, v in side(4, 600, 7)]
    frames = [spark.createDataFrame(rows, "k string, v int").repartition(5) for rows in (real, made)]
    got = audit.pair_drift(*frames, "k", "v", limits).first()
    a, b = Counter(real), Counter(made)
    assert got.source_information == pytest.approx(information(real))
    assert got.synthetic_information == pytest.approx(information(made))
    assert got.distance == pytest.approx(sum(abs(a[p] / 800 - b[p] / 600) for p in a | b) / 2)


def test_stream_draws_as_a_table(spark, hot, limits, tmp_path):
    """Rows that come in several batches, in two runs, get the values that the table gets."""
    prof = profile(hot.withColumn("v", F.col("v") % 5), "v", ["g"], limits=limits)
    dist = tiered_distribution(prof, [["g"], []])
    rows = hot.select("id", "g")
    draw = hash_u60(3, "stream", F.col("id"))
    want = sorted(map(tuple, sample_conditional(rows, dist, {"g": "g"}, draw, "w", F.lit(-1)).collect()), key=repr)
    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for part in ("id < 900", "id >= 900"):
        rows.where(part).repartition(3).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        sample_stream(stream, dist, {"g": "g"}, draw, "w", out, state, F.lit(-1)).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).select("id", "g", "w").collect()), key=repr) == want
