from datetime import date, timedelta

from pyspark.sql import functions as F

from mirrorset.operators import calendar as cal

AS_OF = date(2025, 6, 30)


def test_number_of_visits(spark):
    firsts = [(1, date(2025, 6, 30), 28), (2, date(2020, 6, 30), 28), (3, date(2020, 6, 30), 42), (4, date(2025, 6, 2), 28)]
    df = spark.createDataFrame(firsts, "farm int, first date, step int")
    plan = cal.visit_plan(df, "farm", AS_OF, F.col("step"), 1)
    room = F.floor(F.datediff(F.lit(AS_OF), F.col("first")) / F.col("step")) + 1
    fixed = plan.withColumn("first_visit", F.col("first")).withColumn(
        "n_visits", F.least(room, F.floor(F.lit(1825) / F.col("step")) + 1).cast("int")
    )
    got = {r.farm: r["count"] for r in cal.visit_calendar(fixed).groupBy("farm").count().collect()}
    assert got == {1: 1, 2: 66, 3: 44, 4: 2}


def test_calendar_stays_in_the_period(spark):
    farms = spark.range(400).select(F.col("id").alias("farm"), F.when(F.col("id") % 2 == 0, 1).otherwise(10).alias("t"))
    plan = cal.visit_plan(farms, "farm", AS_OF, cal.step_days(F.col("t")), 3)
    visits = cal.visit_ids(plan, "farm").collect()
    assert sorted(v.visit_id for v in visits) == list(range(700000, 700000 + len(visits)))
    assert [v.visit_id for v in sorted(visits, key=lambda v: (v.farm, v.visit_date))] == sorted(v.visit_id for v in visits)
    by_farm = {}
    for v in sorted(visits, key=lambda v: v.pos):
        by_farm.setdefault(v.farm, []).append(v.visit_date)
    assert len(by_farm) == 400
    for farm, days in by_farm.items():
        step = timedelta(days=28 if farm % 2 == 0 else 42)
        assert days[0] >= date(2020, 6, 30) and days[-1] <= AS_OF < days[-1] + step or len(days) in (66, 44)
        assert all(b - a == step for a, b in zip(days, days[1:]))


def test_control_types_filter_before_or_after_the_first(spark, limits):
    visits = spark.createDataFrame(
        [(1, 5, 1), (1, 9, 2), (2, None, 1), (2, 2, 2), (3, 1, 1)], "farm int, kind int, at int"
    )
    farms = spark.range(900).select(F.col("id").alias("new"))
    for filter_first, kinds in ((True, {9, 2, 1}), (False, {1})):
        out = cal.control_types(farms, visits, "new", "farm", "kind", ["at"], 1, filter_first=filter_first)
        assert {r.control_type for r in out.collect()} == kinds


def test_mean_lag_rounds_half_to_even_over_the_last_year(spark):
    rows = [("2020-01-01", "2021-01-01"), ("2024-06-30", "2024-07-02"), ("2025-06-30", "2025-07-03"), ("2025-06-01", None)]
    df = spark.createDataFrame(rows, "a string, b string").select(F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    assert cal.mean_lag(df, "a", "b").first()[0] == 2  # mean of 2 and 3 days
    assert cal.last_period(df, "a", 12).count() == 3
    dated = cal.lab_dates(df, "a", cal.mean_lag(df, "a", "b"), "lab").orderBy("a").collect()
    assert dated[-1].lab == date(2025, 7, 2)


def test_slots_by_share_or_in_turn(spark):
    source = spark.createDataFrame([(1, "AM")] * 3 + [(2, "PM")] * 1 + [(9, "PM")] * 50, "kind int, slot string")
    visits = spark.range(40).crossJoin(spark.range(20).withColumnRenamed("id", "pos")).select(
        F.col("id").alias("farm"), "pos", F.element_at(F.array(F.lit(1), F.lit(2), F.lit(9), F.lit(10)), (F.col("id") % 4 + 1).cast("int")).alias("kind")
    )
    got = cal.slots(visits, source, "kind", "slot", "kind", "farm", 2).collect()
    shared = [r.slot for r in got if r.kind in (1, 2)]
    assert abs(shared.count("AM") / len(shared) - 0.75) < 0.08
    starts = set()
    for farm in {r.farm for r in got if r.kind in (9, 10)}:
        run = [r.slot for r in sorted((r for r in got if r.farm == farm), key=lambda r: r.pos)]
        starts.add(run[0])
        assert all(a != b for a, b in zip(run, run[1:]))
    assert starts == {"AM", "PM"}
