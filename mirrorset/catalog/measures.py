"""Models, audits and curves."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorset.catalog import generators
from mirrorset.catalog.registry import query
from mirrorset.catalog.roles import (
    ANIMALS, AS_OF, EXIT, LACTATIONS, SEED, animals, farms, hash_sql, lactations, scale_sql, table, visits,
)
from mirrorset.catalog.sampling import SEGMENT_BY_NATION, sample_segment_by_nation
from mirrorset.functions.draws import TWO60
from mirrorset.operators import audit, boost, cohort, model, nearest, wood
from mirrorset.operators.keys import permutation
from mirrorset.plans import synthesis
from mirrorset.plans.synthesis import Settings, synthesize
from mirrorset.sources.staging import stage

_TRAIN = f"""WITH {LACTATIONS}, {ANIMALS}, train AS (SELECT id, nolact, breed AS code, CAST(month(vel) AS INTEGER) AS month,
  CAST(tar - vel AS INTEGER) AS duration, lait FROM lact l JOIN animals a ON l.noan = a.noan
  WHERE tar IS NOT NULL AND lait IS NOT NULL)"""
_BOOSTING = model.Boosting()


def _measured(spark: SparkSession, sf: str) -> DataFrame:
    """Lactations with measures that depend on the price; one in eleven lacks the second."""
    price = F.col("lait")
    return lactations(spark, sf).withColumns(
        {
            "mg": F.when(F.col("id") % 11 != 0, price / 25),
            "prot": price / 30,
            "pic": price / 200 + F.col("nolact"),
            "persistance": F.lit(50.0) + F.month("vel"),
        }
    )


def _train(spark: SparkSession, sf: str) -> DataFrame:
    return model.training_set(
        _measured(spark, sf), animals(spark, sf), "noan", "breed", "id", "nolact", "vel", "tar", "lait",
        ["mg", "prot", "pic", "persistance"],
    )


@query(_TRAIN + " SELECT * FROM train")
def training_set(spark: SparkSession, sf: str) -> DataFrame:
    return _train(spark, sf).drop("mg", "prot", "pic", "persistance")


@query(
    f"WITH {LACTATIONS}, {ANIMALS} SELECT id, nolact, breed AS code, CAST(month(vel) AS INTEGER) AS month, "
    f"CAST(coalesce(tar, DATE '{AS_OF}') - vel AS INTEGER) AS duration FROM lact l JOIN animals a ON l.noan = a.noan"
)
def scoring_set(spark: SparkSession, sf: str) -> DataFrame:
    return model.scoring_set(
        lactations(spark, sf), animals(spark, sf), "noan", "breed", "id", "nolact", "vel", "tar", AS_OF
    )


@query(f"SELECT o_orderkey, {hash_sql('split', 'o_orderkey', seed=42)} % 10 < 8 AS is_train FROM orders")
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    return model.hash_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "SELECT c_custkey, c_mktsegment AS code, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS hot, 1.0::DOUBLE AS total FROM customer"
)
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """The one-hot vector of each customer's segment: its hot place, and the sum of all places."""
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("code"))
    codes = model.code_index(customers, "code")
    target = model.Target("none", (), True)
    numbered = model.with_codes(customers, codes)
    encoded = Pipeline(stages=model.feature_stages(target, codes)).fit(numbered).transform(numbered)
    places = vector_to_array("_features")
    total = F.aggregate(places, F.lit(0.0), lambda a, x: a + x)
    hot = (F.array_position(places, F.lit(1.0)) - 1).cast("bigint")
    return encoded.select("c_custkey", "code", hot.alias("hot"), total.alias("total"))


@query(
    "SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_samp(o_totalprice) OVER (), 4) AS scaled "
    "FROM orders"
)
def scaled_feature(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    stages = model.feature_stages(model.Target("none", ("o_totalprice",), False), None, scale=True)
    scaled = Pipeline(stages=stages).fit(orders).transform(orders)
    return scaled.select("o_orderkey", F.round(vector_to_array("_features")[0], 4).alias("scaled"))


def _chain(spark: SparkSession, sf: str) -> model.Chain:
    codes = model.code_index(table(spark, sf, "customer"), "c_mktsegment")
    return model.fit_chain(stage(_train(spark, sf), "training"), codes, _BOOSTING)


_SHALLOW = boost.Histograms(trees=3, depth=3, ranges=16, rate=(1, 2), least=5, keep=2)
_SHALLOW_FEATURES = ["nolact", "month", "duration", "code_number"]


def _trees_sql(settings: boost.Histograms, features: list[str]) -> str:
    """The same trees, level by level, from the table ``measured`` (``id, y`` and the features)."""
    count = len(features)
    ranges = ", ".join(
        f"CASE WHEN {f} IS NULL THEN -1 ELSE ({f} - min({f}) OVER ()) * {settings.ranges} "
        f"// (max({f}) OVER () - min({f}) OVER () + 1) END AS b{i}"
        for i, f in enumerate(features)
    )
    bs = ", ".join(f"b{i}" for i in range(count))
    steps = [f"t0 AS (SELECT id, y, floor(avg(y) OVER ())::BIGINT AS pred, {ranges} FROM measured)"]
    for t in range(settings.trees):
        last = f"t{t}"
        steps.append(f"n{t}_0 AS (SELECT *, y - pred AS r, 1 AS node FROM {last})")
        for d in range(settings.depth):
            rows, cells = f"n{t}_{d}", f"{t}_{d}"
            steps += [
                f"c{cells} AS (SELECT node, f, b, count(*) AS n, sum(r) AS s FROM (SELECT node, r, "
                f"unnest(range({count})) AS f, unnest([{bs}]) AS b FROM {rows}) GROUP BY ALL)",
                f"s{cells} AS (SELECT node, f, b, sum(n) OVER upto AS ln, (sum(s) OVER upto)::DOUBLE AS ls, "
                f"sum(n) OVER (PARTITION BY node, f) AS n, (sum(s) OVER (PARTITION BY node, f))::DOUBLE AS s FROM c{cells} "
                "WINDOW upto AS (PARTITION BY node, f ORDER BY b ROWS UNBOUNDED PRECEDING))",
                f"g{cells} AS (SELECT *, ls * ls / ln::DOUBLE + (s - ls) * (s - ls) / (n - ln)::DOUBLE AS gain FROM s{cells} "
                f"WHERE ln >= {settings.least} AND n - ln >= {settings.least})",
                f"x{cells} AS (SELECT node, f, b FROM g{cells} WHERE gain > s * s / n::DOUBLE "
                "QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b) = 1)",
                f"n{t}_{d + 1} AS (SELECT {rows}.* EXCLUDE (node), CASE WHEN x{cells}.f IS NULL THEN {rows}.node "
                f"ELSE 2 * {rows}.node + CASE WHEN [{bs}][x{cells}.f + 1] <= x{cells}.b THEN 0 ELSE 1 END END AS node "
                f"FROM {rows} LEFT JOIN x{cells} ON {rows}.node = x{cells}.node)",
            ]
        leaves = f"n{t}_{settings.depth}"
        value = f"floor(floor(sum(r) OVER (PARTITION BY node)::DOUBLE / (count(*) OVER (PARTITION BY node))::DOUBLE) * {settings.rate[0]} / {settings.rate[1]})"
        steps.append(f"t{t + 1} AS (SELECT id, y, pred + {value}::BIGINT AS pred, {bs} FROM {leaves})")
    return ", ".join(steps)


@query(
    f"{_TRAIN}, measured AS (SELECT id, CAST(round(lait * 100) AS BIGINT) AS y, nolact, month, duration, "
    f"dense_rank() OVER (ORDER BY code) AS code_number FROM train), {_trees_sql(_SHALLOW, _SHALLOW_FEATURES)} "
    f"SELECT id, pred AS predicted FROM t{_SHALLOW.trees}"
)
def tree_by_histograms(spark: SparkSession, sf: str) -> DataFrame:
    """A shallow boosted model of the milk yield in hundredths, from exact histograms of the residuals."""
    train = stage(_train(spark, sf), "training")
    codes = model.code_index(train.select("code"), "code")
    rows = model.with_codes(train, codes).select(
        "id", "nolact", "month", "duration", F.col("_code").cast("int").alias("code_number"),
        F.round(F.col("lait") * 100).cast("bigint").alias("y"),
    )
    rows = stage(rows, "measured")
    return boost.fit_trees(rows, "y", _SHALLOW_FEATURES, _SHALLOW).predict(rows, "predicted").select("id", "predicted")


@query()
def gbt_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Measures of every lactation, predicted in order by five models."""
    chain = _chain(spark, sf)
    rows = lactations(spark, sf).select("id", "noan", "vel", "tar")
    scored = model.score_chain(scoring_set(spark, sf), chain)
    return model.attach_predictions(rows, scored, "id", [t.name for t, _ in chain.models])


@query(
    "SELECT o_orderkey AS id, o_orderdate, CAST(o_custkey % 100 AS DOUBLE) AS o_totalprice FROM orders"
)
def attach_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A given column takes the place of the measure, put into its row by id."""
    orders = table(spark, sf, "orders")
    scored = orders.select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 100).cast("double").alias("o_totalprice"))
    rows = orders.select(F.col("o_orderkey").alias("id"), "o_orderdate", "o_totalprice")
    return model.attach_predictions(rows, scored, "id", ["o_totalprice"])


@query(
    "SELECT 'price' AS target, round(1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)), 6) AS r2 FROM "
    "(SELECT l_extendedprice AS y, l_quantity * 1500.0::DOUBLE AS p, avg(l_extendedprice) OVER () AS m FROM lineitem)"
)
def r2_of_prediction(spark: SparkSession, sf: str) -> DataFrame:
    """R² of a given column as the prediction."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").cast("double").alias("_actual"), (F.col("l_quantity") * 1500.0).alias("_out")
    )
    return spark.createDataFrame([("price", round(model.r_squared(rows), 6))], "target string, r2 double")


@query()
def hold_out_r2(spark: SparkSession, sf: str) -> DataFrame:
    return _chain(spark, sf).metrics


_FINISHED, _RUNNING = "orders WHERE o_orderstatus <> 'O'", "orders WHERE o_orderstatus = 'O'"


def _moment_sql(column: str) -> str:
    parts = [
        f"(SELECT round({f}({column}), 4) FROM {where}) AS {side}_{name}"
        for side, where in (("source", _FINISHED), ("synthetic", _RUNNING))
        for f, name in (("avg", "mean"), ("stddev_samp", "sd"))
    ]
    return f"SELECT '{column}' AS measure, {', '.join(parts)}"


@query(f"{_moment_sql('o_totalprice')} UNION ALL {_moment_sql('o_custkey')}")
def fidelity(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    source, other = orders.where("o_orderstatus <> 'O'"), orders.where("o_orderstatus = 'O'")
    out = audit.fidelity(source, other, ["o_totalprice", "o_custkey"])
    return out.select("measure", *[F.round(c, 4).alias(c) for c in out.columns if c != "measure"])


@query(
    f"WITH {SEGMENT_BY_NATION}, a AS (SELECT c_mktsegment AS value, count(*) / sum(count(*)) OVER () AS s FROM customer GROUP BY ALL), "
    "b AS (SELECT segment AS value, count(*) / sum(count(*)) OVER () AS s FROM sampled GROUP BY ALL) "
    "SELECT coalesce(a.value, b.value) AS value, round(coalesce(a.s, 0), 6) AS source_share, "
    "round(coalesce(b.s, 0), 6) AS synthetic_share, round(abs(coalesce(a.s, 0) - coalesce(b.s, 0)), 6) AS drift "
    "FROM a FULL JOIN b ON a.value = b.value"
)
def share_drift(spark: SparkSession, sf: str) -> DataFrame:
    source = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("segment"))
    out = audit.share_drift(source, sample_segment_by_nation(spark, sf), "segment")
    return out.select("value", *[F.round(c, 6).alias(c) for c in out.columns if c != "value"])


@query(
    f"""WITH {SEGMENT_BY_NATION}, synth AS (SELECT o_orderkey AS k, c_nationkey AS area, segment AS breed FROM sampled),
g AS (SELECT area, breed, count(*) AS n FROM synth GROUP BY ALL)
SELECT (SELECT count(*) FROM synth) AS n_rows,
  (SELECT count(*) FROM synth WHERE k IN (SELECT c_custkey FROM customer)) AS shared_keys,
  (SELECT count(*) FROM synth WHERE (area, breed) IN (SELECT (c_nationkey, c_mktsegment) FROM customer)) AS shared_rows,
  (SELECT count(*) FROM g) AS n_groups, (SELECT min(n) FROM g) AS smallest_group"""
)
def anonymity(spark: SparkSession, sf: str) -> DataFrame:
    source = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("area"), F.col("c_mktsegment").alias("breed")
    )
    synthetic = sample_segment_by_nation(spark, sf).select(
        F.col("o_orderkey").alias("k"), F.col("c_nationkey").alias("area"), F.col("segment").alias("breed")
    )
    return audit.anonymity(source, synthetic, ["k"], ["area", "breed"])


@query(
    "SELECT n_rows, count(*) AS n_keys FROM (SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY o_custkey) GROUP BY n_rows"
)
def lactations_per_animal(spark: SparkSession, sf: str) -> DataFrame:
    return audit.group_size_distribution(table(spark, sf, "orders"), "o_custkey")


@query("SELECT CAST(floor(o_totalprice / 10000) * 10000 AS BIGINT) AS bin, count(*) AS n FROM orders GROUP BY ALL")
def milk_histogram(spark: SparkSession, sf: str) -> DataFrame:
    out = audit.histogram(table(spark, sf, "orders"), "o_totalprice", 10000)
    return out.select(F.col("bin").cast("bigint").alias("bin"), "n")


# Milk of a control day: order price over the day of the lactation, per customer segment.
_CONTROLS = """controls AS (SELECT o_orderkey AS id, c_mktsegment AS breed, 1 + o_orderkey % 300 AS day,
  o_totalprice * exp(-0.004 * (o_orderkey % 300)) AS milk,
  CAST(o_custkey % 3 + 1 AS INTEGER) AS parity, CAST(quarter(CAST(o_orderdate AS DATE)) AS INTEGER) AS season,
  CAST(o_orderkey % 2 AS INTEGER) AS duration_class FROM orders JOIN customer ON o_custkey = c_custkey)"""
_FIT = f"""{_CONTROLS}, s AS (SELECT breed, count(*) AS n, avg(ln(day)) AS m1, avg(CAST(day AS DOUBLE)) AS m2, avg(ln(milk)) AS my,
  var_pop(ln(day)) AS s11, var_pop(CAST(day AS DOUBLE)) AS s22, covar_pop(ln(day), day) AS s12,
  covar_pop(ln(day), ln(milk)) AS s1y, covar_pop(day, ln(milk)) AS s2y FROM controls WHERE day > 0 AND milk > 0 GROUP BY breed),
f AS (SELECT breed, n, m1, m2, my, (s1y * s22 - s2y * s12) / det AS b, -(s2y * s11 - s1y * s12) / det AS c FROM
  (SELECT *, CASE WHEN s11 * s22 - s12 * s12 > 1e-9 * s11 * s22 THEN s11 * s22 - s12 * s12 END AS det FROM s)),
fit AS (SELECT breed, n, exp(my - b * m1 + c * m2) AS a, b, c FROM f)"""


def _controls(spark: SparkSession, sf: str) -> DataFrame:
    breeds = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("breed"))
    day = F.col("o_orderkey") % 300
    return table(spark, sf, "orders").join(breeds, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"),
        "breed",
        (day + 1).alias("day"),
        (F.col("o_totalprice") * F.exp(day * -0.004)).alias("milk"),
        (F.col("o_custkey") % 3 + 1).cast("int").alias("parity"),
        F.quarter(F.to_date("o_orderdate")).alias("season"),
        (F.col("o_orderkey") % 2).cast("int").alias("duration_class"),
    )


def _rounded(value: Column, digits: int) -> Column:
    """Rounded, with one zero: the sign of what was rounded away does not count."""
    return F.when(F.round(value, digits) == 0, F.lit(0.0)).otherwise(F.round(value, digits))


def _rounded_sql(value: str, digits: int) -> str:
    return f"CASE WHEN round({value}, {digits}) = 0 THEN 0.0::DOUBLE ELSE round({value}, {digits}) END"


def _parameters(digits: int) -> list[Column]:
    return [_rounded(v, digits).alias(name) for v, name in ((F.ln("a"), "ln_a"), (F.col("b"), "b"), (F.col("c"), "c"))]


def _parameters_sql(digits: int) -> str:
    return ", ".join(f"{_rounded_sql(v, digits)} AS {name}" for v, name in (("ln(a)", "ln_a"), ("b", "b"), ("c", "c")))


@query(f"WITH {_FIT} SELECT breed, n, {_parameters_sql(6)} FROM fit")
def wood_fit(spark: SparkSession, sf: str) -> DataFrame:
    fitted = wood.wood_fit(_controls(spark, sf), "day", "milk", ["breed"])
    return fitted.select("breed", "n", *_parameters(6))


@query(
    f"WITH {_FIT} SELECT id, round(ln(a * pow(day, b) * exp(-c * day)), 6) AS ln_milk FROM controls r LEFT JOIN fit f ON r.breed = f.breed"
)
def wood_curve(spark: SparkSession, sf: str) -> DataFrame:
    rows = _controls(spark, sf)
    curve = wood.wood_curve(rows, wood.wood_fit(rows, "day", "milk", ["breed"]), ["breed"], "day")
    return curve.select("id", F.round(F.ln("predicted"), 6).alias("ln_milk"))


class _Text(str):
    """SQL that is put together by the operators of columns."""

    def __add__(self, other):
        return _Text(f"({self} + {other})")

    def __radd__(self, other):
        return _Text(f"({other} + {self})")

    def __sub__(self, other):
        return _Text(f"({self} - {other})")

    def __mul__(self, other):
        return _Text(f"({self} * {other})")


_ROUNDS = 12


def _nls_sql(rounds: int) -> str:
    sums = wood._SUMS
    terms = ["f * f", "f * f * x1", "f * f * x2", "f * f * x1 * x1", "f * f * x1 * x2", "f * f * x2 * x2", "f * r", "f * r * x1", "f * r * x2", "r * r"]
    step = wood.step_of({h: _Text(h) for h in wood._PAIRS}, [_Text(g) for g in ("g1", "g2", "g3")], _Text("damping"),
                        lambda a, b: f"{a} / nullif({b}, 0)")
    empty = ", ".join(f"NULL::DOUBLE AS {c}" for c in ("t1", "t2", "t3", *sums))
    out = [
        "points AS (SELECT breed, ln(day) AS x1, -day::DOUBLE AS x2, milk::DOUBLE AS y FROM controls WHERE day > 0 AND milk > 0)",
        f"k0 AS (SELECT breed, n, {empty}, 0.1::DOUBLE AS damping, ln(a) AS u1, b AS u2, c AS u3 FROM fit)",
    ]
    for i in range(rounds):
        columns = ", ".join(f"sum({t}) AS _{name}" for t, name in zip(terms, sums))
        out.append(
            f"e{i} AS (SELECT breed, {columns} FROM (SELECT *, y - f AS r FROM (SELECT p.breed, x1, x2, y, exp(u1 + u2 * x1 + u3 * x2) AS f "
            f"FROM points p JOIN k{i} k ON p.breed = k.breed)) GROUP BY breed)"
        )
        better = "CASE WHEN coalesce(sse IS NULL OR _sse <= sse, false) THEN {0} ELSE {1} END AS {2}"
        kept = ", ".join(
            [better.format(f"u{j}", f"t{j}", f"t{j}") for j in (1, 2, 3)]
            + [better.format(f"_{name}", name, name) for name in sums]
            + [better.format("damping / 10", "damping * 10", "damping")]
        )
        out.append(f"b{i} AS (SELECT k.breed, n, {kept} FROM k{i} k LEFT JOIN e{i} e ON k.breed = e.breed)")
        out.append(f"k{i + 1} AS (SELECT *, " + ", ".join(f"t{j} + {d} AS u{j}" for j, d in zip((1, 2, 3), step)) + f" FROM b{i})")
    return ", ".join(out)


@query(
    f"WITH {_FIT}, {_nls_sql(_ROUNDS)} SELECT breed, n, round(t1, 4) AS ln_a, {_rounded_sql('t2', 4)} AS b, {_rounded_sql('t3', 5)} AS c, "
    f"round(sqrt(sse / n), 3) AS left_over FROM k{_ROUNDS}"
)
def wood_fit_nls(spark: SparkSession, sf: str) -> DataFrame:
    """Curves fitted to the yields themselves, by damped steps of Gauss and Newton."""
    fitted = wood.wood_fit_nls(_controls(spark, sf), "day", "milk", ["breed"], _ROUNDS)
    left_over = F.round(F.sqrt(F.col("sse") / F.col("n")), 3).alias("left_over")
    return fitted.select("breed", "n", F.round(F.ln("a"), 4).alias("ln_a"), _rounded(F.col("b"), 4).alias("b"), _rounded(F.col("c"), 5).alias("c"), left_over)


_DAYS = "DATE '1970-01-01'"


@query(
    f"""WITH {generators._ENDED}, real AS (SELECT id, breed, vel - {_DAYS} AS day, tar - vel AS lasted, nolact
  FROM lact JOIN animals ON lact.noan = animals.noan),
made AS (SELECT id_laitlact, breed, date_vel - {_DAYS} AS day, date_tar - date_vel AS lasted, nolact FROM ended),
far AS (SELECT id_laitlact, id, abs(m.day - r.day) + abs(coalesce(m.lasted, 0) - coalesce(r.lasted, 0)) + abs(m.nolact - r.nolact)
  + CASE WHEN (m.lasted IS NULL) <> (r.lasted IS NULL) THEN 1000 ELSE 0 END + CASE WHEN m.breed <> r.breed THEN 1000 ELSE 0 END AS d
  FROM made m, real r)
SELECT id_laitlact, min(d)::BIGINT AS distance, arg_min(id, d * 1000000000 + id) AS nearest FROM far GROUP BY id_laitlact"""
)
def nearest_record(spark: SparkSession, sf: str) -> DataFrame:
    """For each lactation of a run the nearest real one, by dates, number and breed."""
    breeds = animals(spark, sf).select(F.col("noan").alias("_noan"), "breed")
    source = stage(lactations(spark, sf), "lactations")
    real = source.join(breeds, F.col("noan") == F.col("_noan")).select(
        "id", "breed", F.unix_date("vel").alias("day"), F.datediff("tar", "vel").alias("lasted"), "nolact"
    )
    made = generators._ended(spark, sf)[0].select(
        "id_laitlact", "breed", F.unix_date("date_vel").alias("day"), F.datediff("date_tar", "date_vel").alias("lasted"), "nolact"
    )
    found = nearest.nearest_record(real, made, "id", "id_laitlact", ["day", "lasted", "nolact"], ["breed"])
    return found.select("id_laitlact", "distance", "nearest")


# The stated cohort: breed, parity, calving season and class of duration.
_COHORT = ["breed", "parity", "season", "duration_class"]
_COHORT_FIT = (
    _FIT.replace("breed, count(*)", f"{', '.join(_COHORT)}, count(*)")
    .replace("GROUP BY breed", f"GROUP BY {', '.join(_COHORT)}")
    .replace("SELECT breed, n,", f"SELECT {', '.join(_COHORT)}, n,")
)


@query(f"WITH {_COHORT_FIT} SELECT {', '.join(_COHORT)}, n, {_parameters_sql(4)} FROM fit")
def wood_fit_cohort(spark: SparkSession, sf: str) -> DataFrame:
    fitted = wood.wood_fit(_controls(spark, sf), "day", "milk", _COHORT)
    return fitted.select(*_COHORT, "n", *_parameters(4))


@query(
    f"WITH {_COHORT_FIT} SELECT id, round(ln(a * pow(day, b) * exp(-c * day)), 4) AS ln_milk "
    f"FROM controls LEFT JOIN fit USING ({', '.join(_COHORT)})"
)
def wood_curve_cohort(spark: SparkSession, sf: str) -> DataFrame:
    rows = _controls(spark, sf)
    curve = wood.wood_curve(rows, wood.wood_fit(rows, "day", "milk", _COHORT), _COHORT, "day")
    return curve.select("id", F.round(F.ln("predicted"), 4).alias("ln_milk"))


def domain_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The eight source tables of a full run, derived from the test tables."""
    herd = animals(spark, sf)
    control = visits(spark, sf)
    return {
        "AIDACTIEL": herd.select(F.col("breed").alias("ACTIEL")).distinct(),
        "CL_AIDE_ETAPE_CTRL": control.select(F.ascii("step_code").alias("CD_ETAPE_CTRL")).distinct(),
        "CL_AIDE_TYPE_CTRL": control.select(F.col("control_type").alias("CD_TYPE_CTRL")).distinct(),
        "EXPLOITATION": farms(spark, sf).select(F.col("farm").alias("NOINTEXPL"), F.col("postcode").alias("CODPOST")),
        "IDENTANV": herd.select(
            F.col("noan").alias("NOAN"),
            F.lit("F").alias("SEXEAN"),
            F.date_format("birth", "yyyyMMdd").cast("int").alias("DTNAISANINV"),
            F.col("farm").alias("NOINTSANIT"),
            F.col("breed").alias("ACTIEL"),
        ),
        "CL_LAITEXPL": control.select(
            F.col("visit_id").alias("ID_LAITEXPL"),
            F.col("farm").alias("NOINTEXPL"),
            F.col("visit_date").alias("DATE_CTRL"),
            F.col("slot").alias("TRAIT1"),
            F.col("control_type").alias("CD_TYPE_CTRL"),
            F.col("lab_date").alias("DATE_RECEPT_ANALYSE"),
            F.ascii("step_code").alias("CD_ETAPE_CTRL"),
        ),
        "CL_LAITLACT": _measured(spark, sf).select(
            F.col("id").alias("ID_LAITLACT"),
            F.col("noan").alias("NOAN"),
            F.col("nolact").alias("NOLACT"),
            F.col("vel").alias("DATE_VEL"),
            F.col("tar").alias("DATE_TAR"),
            F.col("lait").alias("LAIT"),
            F.col("mg").alias("MG"),
            F.col("prot").alias("PROT"),
            F.col("pic").alias("PIC"),
            F.col("persistance").alias("PERSISTANCE"),
        ),
    }


@query()
def synthetic_database(spark: SparkSession, sf: str) -> DataFrame:
    """A full run with one farm per supplier and models of full size; the synthetic lactations."""
    n = table(spark, sf, "supplier").count()
    settings = Settings(as_of=AS_OF, n_farms=n, max_farms=None, seed=SEED, boosting=_BOOSTING)
    return synthesize(spark, domain_tables(spark, sf), settings)["CL_LAITLACT"]


def _settings(spark: SparkSession, sf: str) -> Settings:
    return Settings(as_of=AS_OF, n_farms=table(spark, sf, "supplier").count(), seed=SEED, boosting=_BOOSTING)


@query(f"WITH {generators._NEW_FARMS} SELECT new_farm AS farm, area FROM new_farms")
def synthetic_farms(spark: SparkSession, sf: str) -> DataFrame:
    """The farms of a full run."""
    made = synthesis.make_farms(spark, domain_tables(spark, sf), _settings(spark, sf))
    return made.select(F.col("NOINTEXPL").alias("farm"), F.col("CODPOST").alias("area"))


_ID_SPAN = cohort.ANIMAL_HIGH - cohort.ANIMAL_LOW
_ID_FACTOR, _ID_SHIFT = permutation(SEED, _ID_SPAN)


def _animal_id(idx: str) -> str:
    return f"{cohort.ANIMAL_LOW} + CAST((CAST({_ID_FACTOR} AS HUGEINT) * ({idx}) + {_ID_SHIFT}) % {_ID_SPAN} AS BIGINT)"


_RUN_CLONES = generators._CLONES.replace(generators._FAR_TARGETS, "").replace(
    f"farm <> {EXIT}", f"farm <> {cohort.EXIT_FARM}"
)
_ANY_DAM = scale_sql(hash_sql("dam", "idx"), "(SELECT count(*) FROM clones)")


@query(
    f"WITH {_RUN_CLONES} SELECT {_animal_id('idx')} AS noan, new_farm AS farm, breed, strftime(birth, '%Y%m%d') AS birth, "
    f"{cohort.SIRE_LOW} + {scale_sql(hash_sql('sire', 'idx'), '1000000')} AS sire, "
    f"CASE WHEN {hash_sql('dam known', 'idx')} < {int(0.8 * TWO60)} THEN {_animal_id(_ANY_DAM)} END AS dam FROM clones"
)
def synthetic_animals(spark: SparkSession, sf: str) -> DataFrame:
    """The animals of a full run, on its own farms."""
    settings = _settings(spark, sf)
    src = domain_tables(spark, sf)
    made_farms = stage(synthesis.make_farms(spark, src, settings), "farms")
    made = synthesis.make_animals(src, made_farms, settings)
    return made.select(
        F.col("NOAN").cast("bigint").alias("noan"),
        F.col("NOINTSANIT").cast("bigint").alias("farm"),
        F.col("ACTIEL").alias("breed"),
        F.col("DTNAISANINV").cast("string").alias("birth"),
        F.col("NOANPERE").cast("bigint").alias("sire"),
        F.col("NOANMERE").cast("bigint").alias("dam"),
    )
