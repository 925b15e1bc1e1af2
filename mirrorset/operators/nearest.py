"""The real record nearest to each synthetic one, without comparing all pairs.

Records lie at the sum of the absolute differences of their whole-number columns, plus a fixed step for each
category that differs. Distances to a few pivot records are kept with every real record and bound all other
distances from below (triangle inequality). Ranges of the pivot distances are halved, all pivots at once, wherever a
box of ranges holds more than ``leaf`` records; so dense ranges are split deeper than others. Synthetic
records go down from box to box: a record of each box bounds the nearest distance from above, and a box whose ranges
lie farther away than that bound is not entered. The ranges of a box are those of the pivot distances and, summed up, those
of the columns themselves, which shells around the pivots leave much wider than the records in them. Only the records of
the boxes that are left are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorset.config import DEFAULT_LIMITS, Limits
from mirrorset.operators.joins import all_of, lookup_join
from mirrorset.sources.staging import stage

PIVOTS = 3
LEAF = 32
MISMATCH = 1_000
_TOO_FAR = 1 << 62
_STEP = 2


def _coordinates(df: DataFrame, numbers: Sequence[str], categories: Sequence[str]) -> list[Column]:
    """Distinct records are told apart by these columns: numbers, whether each is known, and categories."""
    values = [F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(f"x{i}") for i, c in enumerate(numbers)]
    known = [F.col(c).isNull().alias(f"u{i}") for i, c in enumerate(numbers)]
    kinds = [F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(categories)]
    return [*values, *known, *kinds]


def _names(numbers: Sequence[str], categories: Sequence[str]) -> list[str]:
    return [f"{k}{i}" for k, n in (("x", len(numbers)), ("u", len(numbers)), ("c", len(categories))) for i in range(n)]


def _distance(names: Sequence[str], mine, theirs, mismatch: int) -> Column:
    """Distance between the records whose columns ``mine(name)`` and ``theirs(name)`` give."""
    parts = []
    for name in names:
        a, b = mine(name), theirs(name)
        parts.append(F.abs(a - b) if name[0] == "x" else F.when(a.eqNullSafe(b), 0).otherwise(mismatch))
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total.cast("bigint")


def _pivots(real: DataFrame, names: Sequence[str], count: int, mismatch: int) -> list:
    """Records far from each other: each is the farthest from those before it. A row each, by one aggregate each."""
    record = F.struct(*names)
    chosen = [real.agg(F.min_by(record, "rid").alias("r")).first().r]
    while len(chosen) < count:
        far = F.least(*_to(chosen, names, mismatch)) if len(chosen) > 1 else _to(chosen, names, mismatch)[0]
        chosen.append(real.agg(F.max_by(record, F.struct(far, "rid")).alias("r")).first().r)
    return chosen


def _to(pivots: Sequence, names: Sequence[str], mismatch: int) -> list[Column]:
    return [_distance(names, F.col, lambda n, p=p: F.lit(p[n]), mismatch).alias(f"d{j}") for j, p in enumerate(pivots)]


def _below(bounds: Sequence[Column]) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), *bounds)


def _extent(names: Sequence[str]) -> list[Column]:
    """Least and greatest value of each column in a box; an unknown category is told from the known ones by ``_known``."""
    ends = [f(n).alias(f"_{side}_{n}") for n in names for f, side in ((F.min, "from"), (F.max, "to"))]
    return [*ends, *[F.count(n).alias(f"_known_{n}") for n in names if n[0] == "c"]]


def _outside(names: Sequence[str], mismatch: int) -> Column:
    """How far a record lies at least from all records of a box, by the values of its columns in there."""
    total = F.lit(0).cast("bigint")
    for n in names:
        low, high = F.col(f"_from_{n}"), F.col(f"_to_{n}")
        if n[0] == "x":
            gap = _below([low - F.col(n), F.col(n) - high])
        elif n[0] == "u":
            gap = F.when((F.col(n) < low) | (F.col(n) > high), mismatch).otherwise(0)
        else:
            missing = F.when(F.col(n).isNull(), F.col(f"_known_{n}") == F.col("_n"))
            absent = missing.otherwise(F.coalesce((F.col(n) < low) | (F.col(n) > high), F.lit(True)))
            gap = F.when(absent, mismatch).otherwise(0)
        total = total + gap
    return total


def nearest_record(
    source: DataFrame,
    synthetic: DataFrame,
    source_key: str,
    synthetic_key: str,
    numbers: Sequence[str],
    categories: Sequence[str] = (),
    mismatch: int = MISMATCH,
    pivots: int = PIVOTS,
    leaf: int = LEAF,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """``synthetic_key, nearest, distance`` for each synthetic row; ties go to the least source key.

    An unknown number counts as zero, at ``mismatch`` from every known one; unknown categories are alike. Records that
    repeat on either side are searched for once. Without source rows, ``nearest`` and ``distance`` are NULL.
    """
    names = _names(numbers, categories)
    real = source.select(F.col(source_key).alias("rid"), *_coordinates(source, numbers, categories))
    real = stage(real.groupBy(*names).agg(F.min("rid").alias("rid")), "real")
    asked = synthetic.select(F.col(synthetic_key).alias("_key"), *_coordinates(synthetic, numbers, categories))
    asked = stage(asked, "asked")
    records = stage(asked.select(*names).distinct().withColumn("sid", F.monotonically_increasing_id()), "records")
    rid_type = real.schema["rid"].dataType
    if real.isEmpty():
        nothing = [F.lit(None).cast(rid_type).alias("nearest"), F.lit(None).cast("bigint").alias("distance")]
        return asked.select(F.col("_key").alias(synthetic_key), *nothing)
    found = _search(real, records, names, mismatch, pivots, leaf, limits)
    named = records.join(found, "sid").select(*[F.col(n).alias(f"_{n}") for n in names], "nearest", "distance")
    matched = lookup_join(asked, named, {n: f"_{n}" for n in names}, "left", False, limits, null_safe=True)
    return matched.select(F.col("_key").alias(synthetic_key), "nearest", "distance")


def _search(
    real: DataFrame, records: DataFrame, names: Sequence[str], mismatch: int, pivots: int, leaf: int, limits: Limits
) -> DataFrame:
    """``sid, nearest, distance`` of every record."""
    chosen = _pivots(real, names, pivots, mismatch)
    ds = [f"d{j}" for j in range(pivots)]
    codes = [f"k{j}" for j in range(pivots)]
    to_pivots = _to(chosen, names, mismatch)
    open_real = stage(real.select("rid", *names, *to_pivots), "open")
    widest = open_real.agg(F.max(F.greatest(*ds)) if pivots > 1 else F.max(ds[0])).first()[0]
    bits = max(1, int(widest).bit_length())
    best = F.least(*to_pivots, F.lit(_TOO_FAR).cast("bigint")).alias("best")  # pivots are real records
    front = records.select("sid", *names, *to_pivots, best, *[F.lit(0).cast("bigint").alias(k) for k in codes])
    of_record = Window.partitionBy("sid")
    reached, leaves = [], []
    before = 0
    for level in [*range(_STEP, bits, _STEP), bits]:
        coded = open_real.withColumns({k: F.shiftright(d, bits - level) for k, d in zip(codes, ds)})
        boxes = coded.groupBy(*codes).agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.min(d).alias(f"_low{j}") for j, d in enumerate(ds)],
            *[F.max(d).alias(f"_high{j}") for j, d in enumerate(ds)],
            *_extent(names),
            F.min_by(F.struct(*names), "rid").alias("_some"),
        )
        is_leaf = (F.col("_n") <= leaf) | F.lit(level == bits)
        boxes = stage(
            boxes.select(
                *[F.col(k).alias(f"_{k}") for k in codes],
                *[F.shiftright(k, level - before).alias(f"_parent_{k}") for k in codes],
                *[c for c in boxes.columns if c not in codes],
                is_leaf.alias("_leaf"),
            ),
            "boxes",
        )
        small = limits.small(boxes.count())
        inside = lookup_join(front, boxes, {k: f"_parent_{k}" for k in codes}, "inner", small, limits)
        above = _distance(names, F.col, lambda n: F.col("_some")[n], mismatch)
        gaps = [g for j, d in enumerate(ds) for g in (F.col(f"_low{j}") - F.col(d), F.col(d) - F.col(f"_high{j}"))]
        bounded = (
            inside.withColumn("_least", _below([*gaps, _outside(names, mismatch)]))
            .where("_least <= best")  # by the bound so far, so that fewer rows are shuffled for the next one
            .withColumn("best", F.min(F.least("best", above)).over(of_record))
            .where("_least <= best")
        )
        kept = bounded.select("sid", *names, *ds, "best", *[F.col(f"_{k}").alias(k) for k in codes], "_leaf", "_least")
        kept = stage(kept, "front")
        reached.append(kept.where("_leaf").drop("_leaf").withColumn("level", F.lit(level)))
        front = kept.where("NOT _leaf").drop("_leaf", "_least")
        marks = boxes.select(*[f"_{k}" for k in codes], "_leaf")
        marked = stage(lookup_join(coded, marks, {k: f"_{k}" for k in codes}, "inner", small, limits), "marked")
        leaves.append(marked.where("_leaf").select("rid", *names, *ds, *codes).withColumn("level", F.lit(level)))
        open_real = marked.where("NOT _leaf").select("rid", *names, *ds)
        before = level
        if open_real.isEmpty():
            break
    return _compare(reached, leaves, names, ds, codes, mismatch, limits)


def _compare(
    reached: Sequence[DataFrame],
    leaves: Sequence[DataFrame],
    names: Sequence[str],
    ds: Sequence[str],
    codes: Sequence[str],
    mismatch: int,
    limits: Limits,
) -> DataFrame:
    """The nearest record among those of the boxes reached; pivots are looked at before the records themselves."""
    pairs, boxed = reached[0], leaves[0]
    for more, boxes in zip(reached[1:], leaves[1:]):
        pairs, boxed = pairs.unionByName(more), boxed.unionByName(boxes)
    pairs = pairs.withColumn("best", F.min("best").over(Window.partitionBy("sid"))).where("_least <= best")
    pairs = stage(pairs.drop("_least"), "pairs")
    theirs = boxed.select(*[F.col(c).alias(f"_{c}") for c in boxed.columns])
    small = limits.small(theirs.count())
    met = lookup_join(pairs, theirs, {k: f"_{k}" for k in [*codes, "level"]}, "inner", small, limits)
    near = all_of([F.abs(F.col(d) - F.col(f"_{d}")) <= F.col("best") for d in ds])
    distance = _distance(names, F.col, lambda n: F.col(f"_{n}"), mismatch)
    least = F.min(F.struct(distance.alias("distance"), F.col("_rid").alias("nearest"))).alias("m")
    return met.where(near).groupBy("sid").agg(least).select("sid", "m.nearest", "m.distance")
