import math

import pytest
from pyspark.sql import functions as F

from mirrorset.catalog import measures
from mirrorset.config import Limits
from mirrorset.operators import audit, model, wood

SMALL = model.Boosting(trees=3)


@pytest.fixture(scope="module")
def features(spark):
    """Milk depends on breed and duration, the other measures on milk; some are missing."""
    rows = spark.range(1500).select(
        F.col("id"),
        (F.col("id") % 5 + 1).cast("int").alias("nolact"),
        F.element_at(F.array(F.lit("01"), F.lit("04"), F.lit("XM")), (F.col("id") % 3 + 1).cast("int")).alias("code"),
        (F.col("id") % 12 + 1).cast("int").alias("month"),
        (F.col("id") * 37 % 400).cast("int").alias("duration"),
    )
    milk = F.col("duration") * 20.0 + F.when(F.col("code") == "04", 3000.0).otherwise(0.0)
    return rows.withColumn("lait", milk).withColumns(
        {
            "mg": F.when(F.col("id") % 7 != 0, F.col("lait") * 0.04),
            "prot": F.col("lait") * 0.03,
            "pic": F.col("lait") / 100,
            "persistance": F.col("month") * 1.0,
        }
    )


def test_split_is_stable_and_close_to_four_fifths(spark):
    rows = spark.range(5000)
    got = model.hash_split(rows, "id")
    assert abs(got.agg(F.avg(F.col("is_train").cast("int"))).first()[0] - 0.8) < 0.02
    assert got.exceptAll(model.hash_split(rows.repartition(9), "id")).count() == 0


def test_chain_beats_the_mean_and_scores_every_row(spark, features):
    codes = model.code_index(spark.createDataFrame([("01",), ("04",), ("99",), ("XM",)], "c string"), "c")
    chain = model.fit_chain(features, codes, SMALL)
    r2 = {r.target: r.r2 for r in chain.metrics.collect()}
    assert set(r2) == {"lait", "mg", "prot", "pic", "persistance"}
    assert r2["lait"] > 0.5 and r2["mg"] > 0.5
    new = features.select("id", "nolact", F.when(F.col("id") == 3, "unseen").otherwise(F.col("code")).alias("code"), "month",
                          F.when(F.col("id") != 4, F.col("duration")).alias("duration"))
    scored = model.score_chain(new, chain)
    rows = {r.id: r for r in scored.collect()}
    assert len(rows) == 1500 and rows[3].lait is not None
    assert rows[4].lait is None and rows[4].mg is None
    out = model.attach_predictions(new.select(F.col("id").alias("key"), F.lit(None).cast("double").alias("LAIT")), scored, "key", ["lait", "mg"])
    assert out.columns == ["key", "lait", "mg"] and out.count() == 1500


def test_codes_are_numbered_in_order_and_unknown_ones_last(spark, features):
    codes = model.code_index(features, "code")
    assert codes.size == 3 and [r._known for r in codes.index.orderBy("_code").collect()] == ["01", "04", "XM"]
    rows = spark.createDataFrame([(1, "XM"), (2, None), (3, "other"), (4, "01")], "id int, code string")
    for limits in (Limits(), Limits(small_rows=0)):
        assert {r.id: r._code for r in model.with_codes(rows, codes, limits).collect()} == {1: 2.0, 2: 3.0, 3: 3.0, 4: 0.0}


def test_fidelity_and_drift(spark):
    a = spark.createDataFrame([(1.0, "x"), (3.0, "y")], "v double, c string")
    b = spark.createDataFrame([(2.0, "x"), (2.0, "z"), (None, None)], "v double, c string")
    assert tuple(audit.fidelity(a, b, ["v"]).first()) == ("v", 2.0, math.sqrt(2), 2.0, 0.0)
    got = {r.value: (r.source_share, r.synthetic_share, r.drift) for r in audit.share_drift(a, b, "c").collect()}
    assert got == {"x": (0.5, 0.5, 0.0), "y": (0.5, 0.0, 0.5), "z": (0.0, 0.5, 0.5)}


def test_anonymity(spark):
    real = spark.createDataFrame([(1, "a", 10), (2, "b", None)], "k int, q string, r int")
    fake = spark.createDataFrame([(2, "a", 10), (8, "a", 10), (9, "b", None), (7, "c", 1)], "k int, q string, r int")
    assert tuple(audit.anonymity(real, fake, ["k"], ["q", "r"]).first()) == (4, 1, 3, 3, 1)
    assert tuple(audit.anonymity(real, fake.where("false"), ["k"], ["q", "r"]).first()) == (0, 0, 0, 0, None)


def test_distribution_reports(hot):
    sizes = {r.n_rows: r.n_keys for r in audit.group_size_distribution(hot, "g").collect()}
    assert sizes[667] == 1
    bins = {r.bin: r.n for r in audit.histogram(hot, "v", 250).collect()}
    assert set(bins) == {0, 250, 500, 750} and sum(bins.values()) == 2000


def test_wood_curve_is_recovered(spark):
    days = spark.range(1, 301).select(F.col("id").alias("day"))
    breeds = spark.createDataFrame([("01", 15.0, 0.2, 0.004), ("04", 20.0, 0.15, 0.003)], "breed string, a double, b double, c double")
    rows = days.crossJoin(breeds)
    milk = rows.select("breed", "day", wood.wood_value(F.col("a"), F.col("b"), F.col("c"), F.col("day")).alias("milk"))
    fitted = wood.wood_fit(milk, "day", "milk", ["breed"])
    got = {r.breed: (r.n, round(r.a, 6), round(r.b, 6), round(r.c, 6)) for r in fitted.collect()}
    assert got == {"01": (300, 15.0, 0.2, 0.004), "04": (300, 20.0, 0.15, 0.003)}
    curve = wood.wood_curve(milk, fitted, ["breed"], "day")
    assert curve.where(F.abs(F.col("predicted") - F.col("milk")) > 1e-6).count() == 0
    flat = wood.wood_fit(milk.where("day = 5"), "day", "milk", ["breed"]).first()
    assert flat.b is None and flat.c is None


def test_registered_models_have_full_size(spark, sf, monkeypatch):
    sizes = []
    monkeypatch.setattr(measures.model, "fit_chain", lambda features, codes, boosting: sizes.append(boosting.trees))
    monkeypatch.setattr(measures, "synthesize", lambda s, tables, settings: sizes.append(settings.boosting.trees) or {"CL_LAITLACT": None})
    measures._chain(spark, sf)  # of gbt_chain and hold_out_r2
    measures.synthetic_database(spark, sf)
    assert sizes == [200, 200]


def test_trees_are_fitted_on_cells_of_ranges(spark, monkeypatch):
    """Many rows are fitted as one weighted row per combination of ranges; the predictions are those of the rows."""
    fitted, fit = [], model.Pipeline.fit
    monkeypatch.setattr(model.Pipeline, "fit", lambda self, rows, *rest: fitted.append(rows.count()) or fit(self, rows, *rest))
    rows = spark.range(12_000).select(
        ((F.col("id") % 30) * 10.0).alias("lait"),
        (F.pow(F.lit(1.3), F.col("id") % 30) + F.col("id") % 7 / 10).alias("mg"),  # no two cuts are equally good
    )
    target = model.Target("mg", ("lait",), False)
    cells = model.fit_gbt(rows, target, None, model.Boosting(trees=4))
    assert fitted == [30]
    monkeypatch.setattr(model, "PLAIN_ROWS", 100_000)
    plain = model.fit_gbt(rows, target, None, model.Boosting(trees=4))
    assert fitted == [30, 12_000]
    some = spark.createDataFrame([(x,) for x in (None, -5.0, 0.0, 4.0, 10.0, 155.0, 290.0, 400.0)], "lait double")
    a, b = ([r._predicted for r in m.transform(some).collect()] for m in (cells, plain))
    assert a[1:3] == pytest.approx(b[1:3], abs=1e-6) and a[4] == pytest.approx(b[4], abs=1e-6)
    assert a[0] == pytest.approx(b[0], abs=1e-6) and a[6:] == pytest.approx(b[6:], abs=1e-6)


def test_rows_of_one_cell_are_predicted_once(spark, features, monkeypatch):
    """The trees are walked per combination of ranges and code, and each row gets what they give for the row itself."""
    codes = model.code_index(features, "code")
    monkeypatch.setattr(model, "PLAIN_ROWS", 100)
    chain = model.fit_chain(features, codes, model.Boosting(trees=3))
    monkeypatch.setattr(model, "PLAIN_ROWS", 100_000)
    numbered = model.with_codes(features, codes)
    plain_mg, plain_pic = (
        (target, model.fit_gbt(numbered, target, codes, model.Boosting(trees=3)))
        for target in (model.CHAIN[1], model.Target("pic", ("nolact", "lait"), True))
    )
    odd = features.select(
        "id",
        F.when(F.col("id") % 50 != 1, F.col("nolact")).alias("nolact"),
        F.when(F.col("id") % 50 == 2, "unseen").when(F.col("id") % 50 != 3, F.col("code")).alias("code"),
        "month",
        F.when(F.col("id") % 50 == 4, -9999).when(F.col("id") % 50 != 5, F.col("duration")).alias("duration"),
    )
    rows = odd.unionByName(odd.withColumn("id", F.col("id") + 10_000)).unionByName(odd)  # ids repeat, too
    walked, predict = [], model._predict
    monkeypatch.setattr(model, "_predict", lambda df, *rest: walked.append(df.count()) or predict(df, *rest))
    for at, other in ((1, plain_mg), (3, plain_pic), (None, None)):  # models of values beside those of ranges, and ranges alone
        models = tuple(other if i == at else fitted for i, fitted in enumerate(chain.models))
        got = model.score_chain(rows, model.Chain(models, chain.metrics, codes))
        want = model.with_codes(rows, codes)
        for target, fitted in models:
            want = predict(want, target, fitted, target.name)
        want = want.drop("_code")
        assert got.columns == want.columns and got.schema == want.schema
        assert got.count() == 4500 and got.exceptAll(want).count() == want.exceptAll(got).count() == 0
        assert len(walked) == 5 and max(walked) <= 1500
        walked.clear()
    cells = model.score_chain(rows.withColumn("duration", F.lit(100)).withColumn("month", F.lit(2)), chain)
    assert cells.count() == 4500 and max(walked) <= 6 * 40


def test_few_cells_are_one_task(spark):
    rows = spark.range(12_000).select((F.col("id") % 30).cast("double").alias("lait"), F.col("id").cast("double").alias("mg"))
    target = model.Target("mg", ("lait",), False)
    cells = model._cells(rows.repartition(8), target, model.binned(rows, ["lait"]))
    assert cells.count() == 30 and cells.rdd.getNumPartitions() == 1


def test_ranges_of_a_feature_without_values(spark):
    rows = spark.createDataFrame([(None, 1.0, float(i)) for i in range(40)], "a int, b double, c double")
    ends = [s[1:-1] for s in model.binned(rows, ["a", "b", "c"]).getSplitsArray()]
    assert ends[:2] == [[0.0], [0.0]]  # one range has all there is
    assert len(ends[2]) == model.BINS - 1 and ends[2] == sorted(set(ends[2]))
