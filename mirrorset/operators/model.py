"""Dependent measures predicted by a chain of gradient-boosted trees."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from math import ceil

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Bucketizer, OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from mirrorset.config import DEFAULT_LIMITS, Limits
from mirrorset.functions.draws import hash_u60
from mirrorset.operators.joins import all_of, lookup_join
from mirrorset.operators.keys import dense_index
from mirrorset.sources.staging import stage, staging_root
from mirrorset.sources.tables import dictionary_values


@dataclass(frozen=True)
class Target:
    """A measure and what it is predicted from; ``by_code`` adds the one-hot breed."""

    name: str
    numeric: tuple[str, ...]
    by_code: bool


# The measures in the order in which they feed each other.
CHAIN = (
    Target("lait", ("nolact", "month", "duration"), True),
    Target("mg", ("lait",), False),
    Target("prot", ("lait",), False),
    Target("pic", ("nolact", "month", "duration", "lait"), True),
    Target("persistance", ("nolact", "month", "duration", "lait", "pic"), True),
)


@dataclass(frozen=True)
class Boosting:
    """Size of the models (fixed values of the original as defaults)."""

    trees: int = 200
    depth: int = 4
    rate: float = 0.05
    seed: int = 42
    scale: bool = False


def training_set(
    lactations: DataFrame,
    animals: DataFrame,
    key: str,
    code: str,
    id_column: str,
    ordinal: str,
    start: str,
    end: str,
    first_target: str,
    targets: Sequence[str] = (),
) -> DataFrame:
    """Finished lactations with the first measure: ordinal, code, month, duration and the measures."""
    finished = lactations.where(F.col(end).isNotNull() & F.col(first_target).isNotNull())
    owners = animals.select(F.col(key).alias("_animal"), F.col(code).alias("code"))
    return finished.join(owners, F.col(key) == F.col("_animal")).select(
        F.col(id_column).alias("id"),
        F.col(ordinal).alias("nolact"),
        "code",
        F.month(start).alias("month"),
        F.datediff(end, start).alias("duration"),
        F.col(first_target),
        *targets,
    )


def scoring_set(
    lactations: DataFrame,
    animals: DataFrame,
    key: str,
    code: str,
    id_column: str,
    ordinal: str,
    start: str,
    end: str,
    as_of: date,
) -> DataFrame:
    """The same features for every lactation; running ones last until ``as_of``."""
    owners = animals.select(F.col(key).alias("_animal"), F.col(code).alias("code"))
    return lactations.join(owners, F.col(key) == F.col("_animal")).select(
        F.col(id_column).alias("id"),
        F.col(ordinal).alias("nolact"),
        "code",
        F.month(start).alias("month"),
        F.datediff(F.coalesce(F.col(end), F.lit(as_of)), F.col(start)).alias("duration"),
    )


def hash_split(df: DataFrame, key: str, seed: int = 42, parts: int = 8, of: int = 10) -> DataFrame:
    """Add ``is_train``: ``parts`` of ``of`` rows, chosen by a hash of the key."""
    return df.withColumn("is_train", hash_u60(seed, "split", F.col(key)) % of < parts)


@dataclass(frozen=True)
class Codes:
    """A dictionary's codes ``_known`` numbered from 0 in ``_code``, and how many there are."""

    index: DataFrame
    size: int


def code_index(dictionary: DataFrame, column: str, limits: Limits = DEFAULT_LIMITS) -> Codes:
    """Number the codes of a dictionary in their order, however many there are."""
    known = dictionary_values(dictionary, column).select(F.col(column).alias("_known"))
    index = stage(dense_index(known, ["_known"], 0, "_code", limits=limits), "codes")
    return Codes(index, index.count())


def with_codes(df: DataFrame, codes: Codes, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Add the number ``_code`` of each row's ``code``; unknown and missing codes share the number behind the last."""
    small = limits.small(codes.size)
    joined = lookup_join(df, codes.index, {"code": "_known"}, "left", small, limits).drop("_known")
    return joined.withColumn("_code", F.coalesce("_code", F.lit(codes.size)).cast("double"))


def feature_stages(target: Target, codes: Codes | None, scale: bool = False) -> list:
    """Stages that build ``_features``; codes are encoded on the full dictionary."""
    stages, inputs = [], list(target.numeric)
    if target.by_code:
        last = codes.index.sparkSession.createDataFrame([(float(codes.size),)], "_code double")
        stages.append(OneHotEncoder(inputCols=["_code"], outputCols=["_codes"], dropLast=False).fit(last))
        inputs = ["_codes", *inputs]
    raw = "_raw" if scale else "_features"
    stages.append(VectorAssembler(inputCols=inputs, outputCol=raw, handleInvalid="keep"))
    if scale:
        stages.append(StandardScaler(inputCol=raw, outputCol="_features", withMean=True))
    return stages


BINS = 32  # ranges of a feature that the trees tell apart, as in GBTRegressor
PLAIN_ROWS = 10_000  # up to here, GBTRegressor draws the bounds of its ranges from all rows, behind it from some of them
CELLS_PER_TASK = 25_000  # a level of a tree is one short job: more tasks than this asks for cost more than they save
_WEIGHT = "_weight"


def _bounds(rows: DataFrame, column: str, quantiles: Sequence[float]) -> list[float]:
    """Where the ranges of a feature begin: at each of its values, or at quantiles if it has more than ``BINS`` of them."""
    starts = sorted(set(quantiles))
    if len(starts) < BINS - 1:
        values = rows.where(F.col(column).isNotNull()).select(F.col(column).cast("double")).distinct()
        few = [r[0] for r in values.limit(BINS + 1).collect()]
        starts = sorted(few)[1:] if len(few) <= BINS else starts
    return [float("-inf"), *(starts or [0.0]), float("inf")]


def binned(rows: DataFrame, numeric: Sequence[str]) -> Bucketizer:
    """A stage that puts the number of its range, ``_bin_<name>``, beside each feature; unknown values stay unknown."""
    shares = [i / BINS for i in range(1, BINS)]
    quantiles = rows.select(*[F.col(c).cast("double").alias(c) for c in numeric]).approxQuantile(list(numeric), shares, 0.001)
    return Bucketizer(
        inputCols=list(numeric),
        outputCols=[f"_bin_{c}" for c in numeric],
        splitsArray=[_bounds(rows, c, q) for c, q in zip(numeric, quantiles)],
        handleInvalid="keep",
    )


def _cells(rows: DataFrame, target: Target, bins: Bucketizer) -> DataFrame:
    """One row per combination of ranges and code: the mean of the measure, weighted by the number of rows.

    Trees see nothing but the ranges, and with squared errors a cut's gain and a leaf's value depend only on number and
    sum of the residuals on each side. So trees of these rows are those of the rows themselves, whose number no longer counts.
    """
    keys = [*bins.getOutputCols(), *(["_code"] if target.by_code else [])]
    means = [F.avg(target.name).alias(target.name), F.count(F.lit(1)).cast("double").alias(_WEIGHT)]
    ordered = {c: F.col(c).alias(c, metadata={"ml_attr": {"type": "numeric"}}) for c in bins.getOutputCols()}  # else nominal
    cells = stage(bins.transform(rows).groupBy(*keys).agg(*means).withColumns(ordered), "cells")
    return cells.coalesce(max(1, ceil(cells.count() / CELLS_PER_TASK)))


def fit_gbt(train: DataFrame, target: Target, codes: Codes, boosting: Boosting = Boosting()) -> PipelineModel:
    """Features and boosted trees for one measure, on the rows that have it.

    More than ``PLAIN_ROWS`` rows are cut into ranges first, with bounds from all of them, and fitted as weighted cells.
    """
    trees = GBTRegressor(
        featuresCol="_features",
        labelCol=target.name,
        predictionCol="_predicted",
        maxIter=boosting.trees,
        maxDepth=boosting.depth,
        stepSize=boosting.rate,
        seed=boosting.seed,
        checkpointInterval=10,
    )
    usable = train.where(F.col(target.name).isNotNull()).withColumn(target.name, F.col(target.name).cast("double"))
    if usable.count() <= PLAIN_ROWS:
        return Pipeline(stages=[*feature_stages(target, codes, boosting.scale), trees]).fit(usable)
    bins = binned(usable, target.numeric)
    ranges = Target(target.name, tuple(bins.getOutputCols()), target.by_code)
    weighted = trees.setMaxBins(BINS).setWeightCol(_WEIGHT)
    fitted = Pipeline(stages=[*feature_stages(ranges, codes, boosting.scale), weighted]).fit(_cells(usable, target, bins))
    return PipelineModel([bins, *fitted.stages])


def _predict(df: DataFrame, target: Target, model: PipelineModel, name: str) -> DataFrame:
    complete = all_of([F.col(c).isNotNull() for c in target.numeric])
    kept = [c for c in df.columns if c != name]
    predicted = F.when(complete, F.col("_predicted")).alias(name)
    return model.transform(df).select(*kept, predicted)


def _given(models: Sequence[tuple[Target, PipelineModel, str]]) -> dict[str, list[float] | None]:
    """The features that no earlier model predicts, each with all bounds of its ranges; None where a model takes the value itself."""
    out: dict[str, list[float] | None] = {}
    made: set[str] = set()
    for target, model, name in models:
        ranges = model.stages[0] if isinstance(model.stages[0], Bucketizer) else None
        own = dict(zip(target.numeric, ranges.getSplitsArray())) if ranges else {}
        for c in [c for c in target.numeric if c not in made]:
            known = out.get(c, [])
            out[c] = sorted({*known, *own[c]}) if c in own and known is not None else None
        made.add(name)
    return out


def _predict_cells(
    rows: DataFrame, models: Sequence[tuple[Target, PipelineModel, str]], limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Add the predictions of the models, in order, to rows with ``_code``; each may be a feature of the next ones.

    Where trees see ranges, all rows of one code whose features lie in the same ranges of all models have the same
    predictions. The trees are then walked once per such cell, and the rows look their cell up. Models of the values
    themselves (see ``fit_gbt``) add these values to the cell.
    """
    given, names = _given(models), [name for _, _, name in models]
    ranged = [c for c, splits in given.items() if splits]
    if not ranged:
        out = rows
        for target, model, name in models:
            out = _predict(out, target, model, name)
        return out
    keys = {c: f"_in_{c}" for c in given}
    bins = Bucketizer(
        inputCols=ranged,
        outputCols=[keys[c] for c in ranged],
        splitsArray=[given[c] for c in ranged],
        handleInvalid="keep",
    )
    placed = bins.transform(rows).withColumns({keys[c]: F.col(c) for c in given if c not in ranged})
    on = ["_code", *keys.values()]
    cells = stage(placed.groupBy(*on).agg(*[F.min(c).alias(c) for c in given]), "cells")
    few = limits.small(cells.count())
    for target, model, name in models:
        cells = _predict(cells, target, model, name)
    found = stage(cells.select(*[F.col(k).alias(f"_of{k}") for k in on], *[F.col(n).alias(f"_made_{n}") for n in names]), "predicted")
    joined = lookup_join(placed, found, {k: f"_of{k}" for k in on}, "left", few, limits, null_safe=True)
    kept = [c for c in rows.columns if c not in names]
    return joined.select(*kept, *[F.col(f"_made_{n}").alias(n) for n in names])


def r_squared(tested: DataFrame) -> float:
    """R² of the predictions ``_out`` of ``_actual``."""
    return float(RegressionEvaluator(labelCol="_actual", predictionCol="_out", metricName="r2").evaluate(tested))


@dataclass(frozen=True)
class Chain:
    models: tuple[tuple[Target, PipelineModel], ...]
    metrics: DataFrame
    codes: Codes


def fit_chain(
    features: DataFrame,
    codes: Codes,
    boosting: Boosting = Boosting(),
    targets: Sequence[Target] = CHAIN,
) -> Chain:
    """Fit every measure on 80% of the rows and report R² on the rest.

    The split rows are staged, and the models are fitted side by side.
    """
    context = features.sparkSession.sparkContext
    if not context.getCheckpointDir():  # else the trees keep their whole lineage
        context.setCheckpointDir(staging_root(features.sparkSession))
    split = stage(hash_split(with_codes(features, codes), "id", boosting.seed), "split")
    train, held = split.where("is_train"), split.where(~F.col("is_train"))

    def fitted(target: Target) -> tuple[PipelineModel, float]:
        model = fit_gbt(train, target, codes, boosting)
        usable = held.where(F.col(target.name).isNotNull()).withColumn(
            "_actual", F.col(target.name).cast("double")
        )
        tested = _predict_cells(usable, [(target, model, "_out")]).where(F.col("_out").isNotNull())
        return model, r_squared(tested)

    # Measures are learned from the true values of the ones before, so no model waits for another.
    with ThreadPoolExecutor(max(1, len(targets))) as pool:
        done = list(pool.map(inheritable_thread_target(features.sparkSession)(fitted), targets))
    models = [(target, model) for target, (model, _) in zip(targets, done)]
    scores = [(target.name, r2) for target, (_, r2) in zip(targets, done)]
    metrics = features.sparkSession.createDataFrame(scores, "target string, r2 double")
    return Chain(tuple(models), metrics, codes)


def score_chain(features: DataFrame, chain: Chain) -> DataFrame:
    """Predict the measures in order; each prediction is a feature of the next ones."""
    models = [(target, model, target.name) for target, model in chain.models]
    return _predict_cells(with_codes(features, chain.codes), models).drop("_code")


def attach_predictions(rows: DataFrame, scored: DataFrame, id_column: str, columns: Sequence[str]) -> DataFrame:
    """Put predictions into their rows by id, in place of columns of the same name."""
    lower = {c.lower() for c in columns}
    kept = [c for c in rows.columns if c.lower() not in lower]
    predicted = scored.select(F.col("id").alias("_id"), *columns)
    return rows.select(*kept).join(predicted, F.col(id_column) == F.col("_id"), "left").drop("_id")
