"""Connected components by alternating large-star and small-star rounds over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorset.sources.staging import stage


def _stars(edges: DataFrame) -> DataFrame:
    """Each node of ``u`` with the least of its neighbours and itself, joined to its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
    return edges.join(least, "u")


def _round(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _stars(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stars = _stars(down)
    small = stars.select(F.col("v").alias("u"), F.col("m").alias("v")).union(stars.select("u", F.col("m").alias("v")))
    return small.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of an edge table ``u, v``; the root is the least node of its component.

    Every round is written to the shared folder. A round's number of edges and hash, two numbers,
    tell whether it changed anything. Nodes without an edge to another node are not listed.
    """
    current = stage(edges.where("u <> v").distinct(), "edges")

    def mark(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = mark(current)
    while before[0]:
        current = stage(_round(current), "edges")
        after = mark(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
