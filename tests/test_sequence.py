from datetime import date

import pytest
from pyspark.sql import functions as F

from mirrorset.operators import lactation, sequence

AS_OF = date(2025, 6, 30)


def d(text):
    return date.fromisoformat(text) if text else None


def frame(spark, rows):
    data = [(a, o, d(s), d(e)) for a, o, s, e in rows]
    return spark.createDataFrame(data, "noan int, nolact int, vel date, tar date")


@pytest.mark.parametrize("short", [True, False])
def test_repair(spark, short):
    rows = frame(spark, [
        (1, 1, "2022-01-10", "2023-05-01"), (1, 2, "2023-03-15", "2023-12-01"),
        (2, 1, "2022-01-10", "2023-03-15"), (2, 2, "2023-03-15", None),
        (3, 1, "2022-01-10", "2023-03-01"), (3, 2, "2023-03-15", None),
        (4, 1, "2022-01-10", "2024-01-01"), (4, 3, "2023-03-15", None),
        (5, 1, "2023-01-10", "2024-05-01"), (5, 2, "2024-04-30", None),
    ])

    def ends(**flags):
        out = sequence.repair_overlap(rows, "noan", "nolact", "vel", "tar", short=short, **flags)
        return {(r.noan, r.nolact): r.tar for r in out.collect()}

    got = ends()
    assert got[(1, 1)] == d("2023-01-15") and got[(2, 1)] == d("2023-01-15")
    assert got[(3, 1)] == d("2023-03-01") and got[(4, 1)] == d("2024-01-01")
    assert got[(5, 1)] == d("2024-02-29") and got[(1, 2)] == d("2023-12-01")
    assert ends(overflow=True)[(5, 1)] == d("2024-03-01")
    assert ends(strict=True)[(3, 1)] == d("2023-01-15")


def test_future_rows_and_running_ends(spark):
    rows = frame(spark, [
        (1, 1, "2024-01-01", "2025-06-29"), (1, 2, "2025-06-30", "2025-09-01"), (2, 1, "2025-06-29", "2025-07-01"),
        (3, 1, "2024-01-01", "2025-06-30"), (4, 1, None, None),
    ])
    repaired = sequence.repair_overlap(rows, "noan", "nolact", "vel", "tar", strict=True)
    kept = sequence.censor_as_of(sequence.drop_future(repaired, "vel", AS_OF), "tar", AS_OF)
    got = {(r.noan, r.nolact): r.tar for r in kept.collect()}
    assert got == {(1, 1): d("2025-04-30"), (2, 1): None, (3, 1): d("2025-06-30"), (4, 1): None}


@pytest.mark.parametrize("short", [True, False])
def test_running_dates(spark, short):
    gaps = [27, 12, 12, 12, 12]
    rows = spark.createDataFrame([(7, i, g, d("2021-12-16")) for i, g in enumerate(gaps, 1)], "noan int, nolact int, gap int, born date")
    out = sequence.cumulative_dates(rows, "noan", "nolact", "gap", "born", "vel", short=short).orderBy("nolact").collect()
    assert [r.gap_total for r in out] == [27, 39, 51, 63, 75]
    assert [r.vel.isoformat() for r in out] == ["2024-03-05", "2025-02-28", "2026-02-23", "2027-02-18", "2028-02-13"]


def test_end_dates_use_the_own_duration_or_the_running_sum(spark):
    rows = spark.createDataFrame([(7, 1, 10), (7, 2, 5)], "noan int, nolact int, months int").withColumn("vel", F.lit(d("2024-01-01")))
    own = sequence.end_dates(rows, "noan", "nolact", "vel", "months", "tar").orderBy("nolact").collect()
    assert [r.tar.isoformat() for r in own] == ["2024-10-27", "2024-05-30"]
    running = sequence.end_dates(rows, "noan", "nolact", "vel", "months", "tar", cumulative=True).orderBy("nolact").collect()
    assert [r.tar.isoformat() for r in running] == ["2024-10-27", "2025-03-26"]


def test_expansion(spark):
    rows = spark.createDataFrame([(15994855, 4), (15994856, 2), (15994857, 0), (15994858, 2500)], "noan int, nb int")
    got = sequence.explode_counter(rows, "noan", "nb").orderBy("id_laitlact").collect()
    assert [r.nolact for r in got[:6]] == [1, 2, 3, 4, 1, 2]
    assert [r.nolact for r in got[6:]] == list(range(1, 2501))
    assert [r.id_laitlact for r in got] == list(range(3531047, 3531047 + 2506))
    assert "_end" not in got[0].asDict() and "_from" not in got[0].asDict()


@pytest.fixture(scope="module")
def herd(spark):
    animals = spark.createDataFrame(
        [(1, "01", 1400, d("2019-01-01")), (2, "01", 1400, d("2019-06-01")), (3, None, None, None)],
        "noan int, breed string, area int, birth date",
    )
    lact = frame(spark, [
        (1, 1, "2021-03-01", "2022-01-01"), (1, 2, "2022-03-15", "2023-01-01"), (1, 3, "2023-05-01", None),
        (2, 1, "2021-08-01", "2022-06-20"), (2, 3, "2024-01-01", "2024-09-01"), (9, 1, "2021-01-01", "2021-09-01"),
    ])
    return lact, animals


def test_parity_profile_counts_animals_or_rows(herd, limits):
    lact, animals = herd
    per_cow = lactation.parity_profile(lact, animals, "noan", "nolact", ["area", "breed"], limits=limits)
    assert {(r.nb_lact, r.n) for r in per_cow.shares().collect()} == {(3, 2)}
    assert lactation.longest(per_cow) == 3
    per_row = lactation.parity_profile(lact, animals, "noan", "nolact", ["area", "breed"], True, limits)
    assert {(r.nb_lact, r.n) for r in per_row.shares().collect()} == {(1, 2), (2, 1), (3, 2)}


def test_gap_profile_falls_back_to_the_mean_and_then_to_ten(herd, limits):
    lact, animals = herd
    got = lactation.gap_profile(lact, animals, "noan", "nolact", "vel", "tar", "birth", ["breed", "area"], limits)
    # 790 and 792 days give 25 and 26 months; 379 days give 12; the third lactation of animal 2 has no second.
    assert {(r.nolact, r.gap, r.n, r.share) for r in got.shares().collect()} == {
        (1, 25, 1, 0.5), (1, 26, 1, 0.5), (2, 12, 1, 1.0), (3, 10, 1, 1.0)
    }


def test_mean_of_distinct_values_fills_null(spark, limits):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", 3), ("a", None), ("b", None)], "k string, m int")
    got = lactation.month_counts(rows, F.col("m"), ["k"], "months", 10, limits).cells
    assert {tuple(r) for r in got.collect()} == {("a", 1, 2), ("a", 3, 1), ("a", 2, 1), ("b", 10, 1)}


def test_duration_profile(herd, limits):
    lact, animals = herd
    got = lactation.duration_profile(lact, animals, "noan", "nolact", "vel", "tar", ["breed", "area"], limits)
    assert {(r.nolact, r.duration, r.n) for r in got.shares().collect()} == {(1, 10, 2), (2, 9, 1), (3, 8, 1)}


def test_repair_is_the_same_in_both_plans_with_nulls_and_repeats(spark):
    rows = spark.range(400).selectExpr(
        "id",
        "CASE WHEN xxhash64(id) % 6 = 0 THEN NULL ELSE abs(xxhash64(id, 1)) % 20 END AS k",
        "CASE WHEN xxhash64(id, 2) % 9 = 0 THEN NULL ELSE cast(abs(xxhash64(id, 3)) % 8 AS int) END AS o",
        "date_add(DATE '2020-01-01', cast(abs(xxhash64(id, 4)) % 900 AS int)) AS s",
        "date_add(DATE '2020-06-01', cast(abs(xxhash64(id, 5)) % 900 AS int)) AS e",
    )
    for strict in (False, True):
        plans = [sequence.repair_overlap(rows, "k", "o", "s", "e", strict=strict, short=short) for short in (True, False)]
        assert {tuple(r) for r in plans[0].collect()} == {tuple(r) for r in plans[1].collect()}
    loose = rows.withColumn("gap", F.when(F.col("id") % 3 > 0, F.col("id") % 5)).where("o IS NOT NULL").dropDuplicates(["k", "o"])
    plans = [sequence.cumulative_dates(loose, "k", "o", "gap", "s", "d", short=short) for short in (True, False)]
    assert {tuple(r) for r in plans[0].collect()} == {tuple(r) for r in plans[1].collect()}
