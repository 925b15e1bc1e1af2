from collections import Counter

import pytest
from pyspark.sql import functions as F

from mirrorset.operators import cohort
from mirrorset.operators.profile import profile


@pytest.fixture(scope="module")
def source_farms(spark):
    """Area 1300 has three farms, 1400 one, 1500 one without animals; one has no address, one lies in area 0."""
    rows = [(1, 1301), (2, 1325), (3, 1399), (4, 1400), (5, 1501), (6, 0), (7, 99), (111111, 1300)]
    return spark.createDataFrame(rows, "farm bigint, code int")


@pytest.fixture(scope="module")
def source_animals(spark):
    """Farm 1 holds more than a third; farm 9 does not exist; 111111 is the exit farm."""
    farms = [1] * 40 + [2] * 20 + [3] * 10 + [4] * 15 + [6] * 5 + [7] * 3 + [9] * 2 + [111111] * 9
    rows = [(1000 + i, f, 20200101 + i % 28, "04" if i % 2 else "XM") for i, f in enumerate(farms)]
    return spark.createDataFrame(rows, "noan bigint, farm bigint, born int, breed string")


@pytest.fixture(scope="module")
def source_herds(source_farms, source_animals):
    return cohort.herds(source_animals, cohort.with_area(source_farms, "code"), "farm", "farm", "area")


def test_areas_leave_out_unknown_places(source_farms):
    got = Counter(r.area for r in cohort.with_area(source_farms, "code").collect())
    assert got == {1300: 4, 1400: 1, 1500: 1}


def test_generated_farms(spark, source_farms, limits):
    p = profile(cohort.with_area(source_farms, "code"), "area", limits=limits)
    farms = cohort.generate_entities(spark, 600, p, 1, "farm", "area", max_n=2000).collect()
    assert sorted(r.farm for r in farms) == list(range(200000, 200600))
    assert abs(Counter(r.area for r in farms)[1300] / 600 - 4 / 6) < 0.08
    for n in (0, 2001):
        with pytest.raises(ValueError):
            cohort.generate_entities(spark, n, p, 1, "farm", "area", max_n=2000)


def test_herds(source_herds):
    assert sorted(tuple(r) for r in source_herds.collect()) == [(1300, 1, 40), (1300, 2, 20), (1300, 3, 10), (1400, 4, 15)]
    slots = {(r.area, r.herd): r.slot for r in cohort.herd_slots(source_herds).collect()}
    assert slots == {(1300, 1): 1, (1300, 2): 2, (1300, 3): 3, (1400, 4): 1}


@pytest.fixture(scope="module")
def targets(spark):
    areas = [1300] * 7 + [1400] * 3 + [1500] * 5 + [1600] * 1
    return spark.createDataFrame([(200000 + i, a) for i, a in enumerate(areas)], "farm bigint, place int")


def test_assignment_uses_the_own_area_and_goes_round(targets, source_herds, limits):
    got = cohort.assign_cohorts(targets, source_herds, "farm", "place", 4, 16, limits).collect()
    assert len(got) == 16
    by_area = {a: Counter(r.herd for r in got if r.place == a) for a in (1300, 1400, 1500, 1600)}
    assert sorted(by_area[1300].values()) == [2, 2, 3] and set(by_area[1300]) == {1, 2, 3}
    assert by_area[1400] == {4: 3}
    assert set(by_area[1500]) == {1, 2, 3, 4} and sum(by_area[1600].values()) == 1
    assert all(r.n_members == {1: 40, 2: 20, 3: 10, 4: 15}[r.herd] for r in got)


def test_assignment_without_any_herd(targets, source_herds):
    assert cohort.assign_cohorts(targets, source_herds.where("false"), "farm", "place", 4).count() == 0


def test_assignment_does_not_depend_on_partitioning(targets, source_herds, limits):
    def run(n):
        out = cohort.assign_cohorts(targets.repartition(n), source_herds.repartition(n), "farm", "place", 4, 16, limits)
        return sorted(tuple(r) for r in out.collect())

    assert run(1) == run(17)


def test_clones_and_pedigree(targets, source_herds, source_animals, limits):
    assigned = cohort.assign_cohorts(targets, source_herds, "farm", "place", 4, 16, limits)
    members = source_animals.withColumnRenamed("farm", "home")
    clones = cohort.clone_members(assigned, members, "farm", "noan", "home", limits=limits)
    rows = clones.collect()
    total = sum(r.n_members for r in assigned.collect())
    assert sorted(r.idx for r in rows) == list(range(total))
    herd = {r.farm: r.herd for r in assigned.collect()}
    assert all(herd[r.farm] == r.home for r in rows)
    sizes = Counter(r.farm for r in rows)
    assert sizes == {r.farm: r.n_members for r in assigned.collect()}

    count = assigned.agg(F.sum("n_members").alias("n")).scalar()
    new = cohort.pedigree(clones.drop("noan"), count, 9, no_self=True).collect()
    ids = {r.noan for r in new}
    assert len(ids) == total and min(ids) >= cohort.ANIMAL_LOW and max(ids) < cohort.ANIMAL_HIGH
    dams = [r.noanmere for r in new if r.noanmere is not None]
    assert set(dams) <= ids and 0.7 < len(dams) / total < 0.9
    assert all(r.noanmere != r.noan for r in new)
    assert all(cohort.SIRE_LOW <= r.noanpere <= cohort.SIRE_HIGH for r in new)


def test_single_animal_has_no_other_dam(spark):
    one = spark.createDataFrame([(0,)], "idx bigint")
    new = cohort.pedigree(one, F.lit(1), 9, dam_known=1.0, no_self=True).first()
    assert new.noanmere is None
    assert cohort.pedigree(one, F.lit(1), 9, dam_known=1.0).first().noanmere is not None


def test_too_many_animals_for_the_key_range_fail(spark):
    many = spark.range(20).withColumnRenamed("id", "idx")
    with pytest.raises(Exception, match="keys are needed"):
        cohort.pedigree(many, F.lit(20), 1, low=0, high=10).collect()


def test_jitter_stays_within_its_range(spark):
    day = F.lit("2020-06-15").cast("date")
    df = spark.range(500).select(F.datediff(cohort.jittered(day, 10, 1, F.col("id")), day).alias("d"))
    got = [r.d for r in df.collect()]
    assert min(got) == -10 and max(got) == 10
