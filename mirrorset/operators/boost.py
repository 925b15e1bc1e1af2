"""Boosted regression trees from whole numbers, which any engine with integer sums can recompute.

Features are cut into ranges of equal width, the measure is a whole number. A level of a tree is one aggregate: number and
sum of the residuals per node, feature and range, combined before the shuffle. The best cut of each node is then found in
running sums over that table, whose size depends on depth, features and ranges and not on the rows. Sums are exact,
so neither the partitioning nor the order of the rows changes a tree.

A model is a list of trees; predicting is one column expression a tree.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorset.sources.staging import stage


@dataclass(frozen=True)
class Histograms:
    """How many trees of what depth over how many ranges a feature; a tree counts ``rate[0] / rate[1]`` of its value.

    Each side of a cut has at least ``least`` rows. Rows are written anew every ``keep`` trees.
    """

    trees: int = 20
    depth: int = 3
    ranges: int = 32
    rate: tuple[int, int] = (1, 4)
    least: int = 5
    keep: int = 5


@dataclass(frozen=True)
class Feature:
    name: str
    low: int
    high: int

    def range(self, ranges: int) -> Column:
        """Number of the range a value lies in; values outside those learned from lie in the first or the last, unknown ones in -1."""
        at = F.call_function("div", (F.col(self.name).cast("bigint") - self.low) * ranges, F.lit(self.high - self.low + 1))
        held = F.greatest(F.lit(0), F.least(F.lit(ranges - 1), at))
        return F.when(F.col(self.name).isNull(), F.lit(-1)).otherwise(held).cast("int")


@dataclass(frozen=True)
class Tree:
    """Cuts ``node -> (feature, range)``: up to the range go to node 2n, the others to 2n + 1. Values of the leaves."""

    cuts: Mapping[int, tuple[int, int]]
    values: Mapping[int, int]

    def walk(self, at, node: int = 1) -> Column:
        """``at(node)`` of the leaf that a row ends in."""
        if node not in self.cuts:
            return at(node)
        feature, last = self.cuts[node]
        return F.when(F.col(f"_b{feature}") <= last, self.walk(at, 2 * node)).otherwise(self.walk(at, 2 * node + 1))

    def leaf(self) -> Column:
        return self.walk(lambda node: F.lit(node))

    def value(self) -> Column:
        return self.walk(lambda node: F.lit(self.values.get(node, 0)).cast("bigint"))


@dataclass(frozen=True)
class BoostedTrees:
    features: tuple[Feature, ...]
    ranges: int
    base: int
    trees: tuple[Tree, ...]

    def with_ranges(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"_b{i}": f.range(self.ranges) for i, f in enumerate(self.features)})

    def predict(self, df: DataFrame, name: str, every: int = 25) -> DataFrame:
        """Add the prediction ``name``. Trees are added up by ``every``, so that no expression gets long."""
        out = self.with_ranges(df).withColumn(name, F.lit(self.base).cast("bigint"))
        for start in range(0, len(self.trees), every):
            total = F.col(name)
            for tree in self.trees[start : start + every]:
                total = total + tree.value()
            out = out.withColumn(name, total)
        return out.drop(*[f"_b{i}" for i in range(len(self.features))])


def _floor_share(total: Column, count: Column) -> Column:
    return F.floor(total.cast("double") / count.cast("double")).cast("bigint")


def _cuts(rows: DataFrame, nodes: Column, features: int, least: int) -> dict[int, tuple[int, int]]:
    """The best cut of each node that has one: one aggregate over the rows, then running sums over its bounded result.

    Of cuts with equal gain, the first feature and its lowest range count.
    """
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"_b{i}").alias("b")) for i in range(features)]))
    cells = rows.select(nodes.alias("node"), "_r", each.alias("e")).groupBy("node", "e.f", "e.b")
    counts = cells.agg(F.count(F.lit(1)).alias("n"), F.sum("_r").alias("s"))
    feature = Window.partitionBy("node", "f")
    upto = feature.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    sums = counts.select(
        "node",
        "f",
        "b",
        F.sum("n").over(upto).alias("left_n"),
        F.sum("s").over(upto).cast("double").alias("left_s"),
        F.sum("n").over(feature).alias("n"),
        F.sum("s").over(feature).cast("double").alias("s"),
    ).where((F.col("left_n") >= least) & (F.col("n") - F.col("left_n") >= least))
    right_n, right_s = F.col("n") - F.col("left_n"), F.col("s") - F.col("left_s")
    gain = F.col("left_s") * F.col("left_s") / F.col("left_n") + right_s * right_s / right_n
    better = sums.withColumn("gain", gain).where(F.col("gain") > F.col("s") * F.col("s") / F.col("n"))
    best = better.groupBy("node").agg(F.min_by(F.struct("f", "b"), F.struct(-F.col("gain"), "f", "b")).alias("cut"))
    return {r.node: (r.cut.f, r.cut.b) for r in best.collect()}


def fit_trees(train: DataFrame, measure: str, features: Sequence[str], settings: Histograms = Histograms()) -> BoostedTrees:
    """Trees for the whole-number column ``measure``, on the rows that have it. Without such rows, the prediction is 0."""
    usable = train.where(F.col(measure).isNotNull()).select(F.col(measure).cast("bigint").alias("_y"), *features)
    bounds = [f(F.col(c).cast("bigint")).alias(f"{side}{i}") for i, c in enumerate(features) for f, side in ((F.min, "low"), (F.max, "high"))]
    seen = usable.agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("s"), *bounds).first()
    known = tuple(Feature(c, seen[f"low{i}"] or 0, seen[f"high{i}"] or 0) for i, c in enumerate(features))
    base = seen.s // seen.n if seen.n else 0
    model = BoostedTrees(known, settings.ranges, base, ())
    if not seen.n:
        return model
    ranges = [f"_b{i}" for i in range(len(features))]
    rows = stage(model.with_ranges(usable).select(*ranges, (F.col("_y") - base).alias("_r")), "residuals")
    trees: list[Tree] = []
    for number in range(settings.trees):
        cuts: dict[int, tuple[int, int]] = {}
        for level in range(settings.depth):
            found = _cuts(rows, Tree(cuts, {}).leaf(), len(features), settings.least)
            new = {node: cut for node, cut in found.items() if node >= 1 << level}
            if not new:
                break
            cuts |= new
        shape = Tree(cuts, {})
        sums = rows.groupBy(shape.leaf().alias("node")).agg(_floor_share(F.sum("_r"), F.count(F.lit(1))).alias("v")).collect()
        up, down = settings.rate
        tree = Tree(cuts, {r.node: r.v * up // down for r in sums})
        trees.append(tree)
        rows = rows.withColumn("_r", F.col("_r") - tree.value())
        if (number + 1) % settings.keep == 0 and number + 1 < settings.trees:
            rows = stage(rows, "residuals")
    return BoostedTrees(known, settings.ranges, base, tuple(trees))
