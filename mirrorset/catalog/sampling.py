"""Sampling from profiles, with fallback tiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorset.catalog.registry import query
from mirrorset.catalog.roles import SEED, hash_sql, scale_sql, table
from mirrorset.functions.draws import hash_u60
from mirrorset.operators import sample
from mirrorset.operators.profile import profile


def _over(keys: Sequence[str], order: str = "") -> str:
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    return f"OVER ({part} {order})"


def sample_sql(
    name: str,
    cells: str,
    keys: Sequence[str],
    tiers: Sequence[Sequence[str]],
    pool: str,
    rows: str,
    columns: Mapping[str, str],
    u: str,
    value: str,
    default: str = "NULL",
) -> str:
    """Common table expressions that end in ``name``: the rows with ``tier`` and the drawn ``value``.

    ``cells`` holds (keys…, value, n).
    """
    out = [f"{name}_tot AS (SELECT *, sum(n) {_over(keys)} AS tot FROM {cells})"]
    heads, picks = [], []
    for t, used in enumerate(tiers, start=1):
        fine = set(used) == set(keys)
        weight = "n" if fine or pool == "rows" else "greatest(1, (2000000 * n + tot) // (2 * tot))"
        listed = "".join(f"{k}, " for k in used)
        usable = " AND ".join(["true", *[f"{k} IS NOT NULL" for k in used]])
        out.append(
            f"{name}_w{t} AS (SELECT {listed}value, sum({weight}) AS w FROM {name}_tot WHERE {usable} GROUP BY ALL)"
        )
        out.append(
            f"{name}_d{t} AS (SELECT *, sum(w) {_over(used, 'ORDER BY value')} - w AS lo, "
            f"sum(w) {_over(used, 'ORDER BY value')} AS hi, sum(w) {_over(used)} AS tot FROM {name}_w{t})"
        )
        on = " AND ".join(["true", *[f"r.{columns[k]} = h{t}.{k}" for k in used]])
        heads.append(f"LEFT JOIN (SELECT DISTINCT {listed}tot FROM {name}_d{t}) h{t} ON {on}")
        match = "".join(f" AND x.{columns[k]} = d{t}.{k}" for k in used)
        picks.append(f"LEFT JOIN {name}_d{t} d{t} ON x.tier = {t}{match} AND x._x >= d{t}.lo AND x._x < d{t}.hi")
    numbers = range(1, len(tiers) + 1)
    tier = " ".join(f"WHEN h{t}.tot IS NOT NULL THEN {t}" for t in numbers)
    tot = ", ".join(f"h{t}.tot" for t in numbers)
    values = ", ".join(f"d{t}.value" for t in numbers)
    out.append(
        f"{name}_t AS (SELECT r.*, {u} AS _u, CASE {tier} END AS tier, coalesce({tot}, NULL) AS tot FROM {rows} r {' '.join(heads)})"
    )
    out.append(f"{name}_x AS (SELECT *, {scale_sql('_u', 'tot')} AS _x FROM {name}_t)")
    out.append(
        f"{name} AS (SELECT x.* EXCLUDE (_u, tot, _x), coalesce({values}, {default}) AS {value} "
        f"FROM {name}_x x {' '.join(picks)})"
    )
    return ", ".join(out)


_SEGMENTS = "cells AS (SELECT c_nationkey, c_mktsegment AS value, count(*) AS n FROM customer GROUP BY ALL)"
_BUYERS = "buyers AS (SELECT o_orderkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey)"
SEGMENT_BY_NATION = ", ".join(
    [
        _SEGMENTS,
        _BUYERS,
        sample_sql(
            "sampled", "cells", ["c_nationkey"], [["c_nationkey"]], "rows", "buyers",
            {"c_nationkey": "c_nationkey"}, hash_sql("segment", "r.o_orderkey"), "segment",
        ),
    ]
)


@query(f"WITH {SEGMENT_BY_NATION} SELECT o_orderkey, c_nationkey, segment FROM sampled")
def sample_segment_by_nation(spark: SparkSession, sf: str) -> DataFrame:
    """Each order gets a market segment drawn from the mix of its customer's nation."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    prof = profile(customers, "c_mktsegment", ["c_nationkey"])
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    buyers = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    draw = hash_u60(SEED, "segment", F.col("o_orderkey"))
    return sample.sample_from(buyers, prof, {"c_nationkey": "c_nationkey"}, draw, "segment")


_TYPES = sample_sql(
    "sampled", "cells", [], [[]], "rows", "orders", {}, hash_sql("type", "r.o_orderkey"), "event_type"
)


@query(
    f"WITH cells AS (SELECT event_type AS value, count(*) AS n FROM events GROUP BY ALL), {_TYPES} "
    "SELECT o_orderkey, event_type FROM sampled"
)
def sample_global(spark: SparkSession, sf: str) -> DataFrame:
    prof = profile(table(spark, sf, "events"), "event_type")
    draw = hash_u60(SEED, "type", F.col("o_orderkey"))
    return sample.sample_from(table(spark, sf, "orders").select("o_orderkey"), prof, {}, draw, "event_type")


# Orders per customer by nation and segment; the targets hold nations and segments that are not in the profile.
_TIERS = [["c_nationkey", "c_mktsegment"], ["c_mktsegment"], ["c_nationkey"]]
_KEYS = ["c_nationkey", "c_mktsegment"]
_OWN = {"c_nationkey": "place", "c_mktsegment": "kind"}
_CELLS = """per AS (SELECT o_custkey, count(*) AS value FROM orders GROUP BY o_custkey),
cells AS (SELECT c_nationkey, c_mktsegment, value, count(*) AS n FROM per JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""
_TARGET = """target AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN c_nationkey + 100
  WHEN c_custkey % 11 = 0 THEN NULL ELSE c_nationkey END AS place,
  CASE WHEN c_custkey % 3 = 0 THEN 'NONE' ELSE c_mktsegment END AS kind FROM customer)"""


def _tiered(pool: str) -> str:
    drawn = sample_sql(
        "sampled", "cells", _KEYS, _TIERS, pool, "target", _OWN, hash_sql("count", "r.c_custkey"), "n_orders", "1"
    )
    return f"WITH {_CELLS}, {_TARGET}, {drawn} SELECT c_custkey, n_orders FROM sampled"


def _count_profile(spark: SparkSession, sf: str):
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    customers = table(spark, sf, "customer")
    return profile(per.join(customers, F.col("o_custkey") == F.col("c_custkey")), "n_orders", _KEYS)


def _target(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    place = F.when(key % 5 == 0, F.col("c_nationkey") + 100).when(key % 11 != 0, F.col("c_nationkey"))
    kind = F.when(key % 3 == 0, "NONE").otherwise(F.col("c_mktsegment"))
    return table(spark, sf, "customer").select(key, place.alias("place"), kind.alias("kind"))


def _sampled(spark: SparkSession, sf: str, pool: str) -> DataFrame:
    out = sample.sample_by_tiers(
        _target(spark, sf), _count_profile(spark, sf), _TIERS, _OWN, ["c_custkey"], "n_orders", SEED, "count", 1, pool
    )
    return out.select("c_custkey", "n_orders")


@query(
    f"WITH {_CELLS}, {_TARGET}, "
    + sample_sql("sampled", "cells", _KEYS, _TIERS, "cells", "target", _OWN, "0", "n_orders", "1")
    + " SELECT c_custkey, tier FROM sampled"
)
def tier_hit(spark: SparkSession, sf: str) -> DataFrame:
    dist = sample.tiered_distribution(_count_profile(spark, sf), _TIERS)
    return sample.tiered_lookup(_target(spark, sf), dist, _OWN).select("c_custkey", "tier")


@query(_tiered("cells"))
def sample_tiered_cells(spark: SparkSession, sf: str) -> DataFrame:
    return _sampled(spark, sf, "cells")


@query(_tiered("rows"))
def sample_tiered_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _sampled(spark, sf, "rows")


@query(
    f"""WITH {_CELLS}, t AS (SELECT *, sum(n) OVER (PARTITION BY c_nationkey, c_mktsegment) AS tot FROM cells),
w AS (SELECT c_mktsegment, value, sum(greatest(1, (2000000 * n + tot) // (2 * tot))) AS w FROM t GROUP BY ALL)
SELECT c_mktsegment, value, w / sum(w) OVER (PARTITION BY c_mktsegment) AS share FROM w"""
)
def renormalised_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of the fine cells pooled per segment and brought back to a sum of one."""
    dist = sample.tiered_distribution(_count_profile(spark, sf), [["c_mktsegment"]])
    share = ((F.col("hi") - F.col("lo")) / F.col("tot")).alias("share")
    return dist.intervals.select(F.col("d_1").alias("c_mktsegment"), "value", share)
