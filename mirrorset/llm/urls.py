"""URL rules by a sort-merge range join over reversed hosts.

A host is written with its labels reversed and a dot after each (``net.example.www.``), so a rule's
host and all its subdomains are one interval of keys, and intervals nest or are disjoint. Pages and
rules are cut into the same ranges of keys, sorted together, and swept once with a stack of the
rules whose interval is open. A rule reaches every range that its interval meets, and nothing else.

A hot host is cut like any other range, by a hash of the page behind the key. The ranges come from a
bounded sample of keys; they decide the balance only, not the result.

Defined cases: a null url, or one without ``://``, has an empty host and path; a rule with an empty
host fits every host; of two rules as long as each other the one with the longer host wins, then
``block``; null rule parts count as empty; repeated pages are judged each.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys sampled per range to place the cuts.
SAMPLE_PER_RANGE = 20
_LEAST = -(1 << 63)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels in reverse order, each with a dot behind it; the empty host has the empty key."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, "[.]")), "."), F.lit(".")))


def _after(key: str) -> str:
    """The least key beyond all that begin with ``key``."""
    return key[:-1] + "/" if key else "\U0010ffff"


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", ranges: int | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per page; ``rules`` has ``host, path, verdict``."""
    spark = pages.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or 4 * tasks
    parsed = pages.select(
        F.col("page_id").cast("bigint"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "url"
    ).select(
        "page_id", "host", "path", host_key(F.col("host")).alias("key"), F.xxhash64("page_id", "url").alias("tie")
    )
    rows = parsed.count()
    share = min(1.0, ranges * SAMPLE_PER_RANGE / max(rows, 1))
    sampled = parsed.select("key", "tie").sample(share, seed=7).toArrow()
    keys = sorted(zip(sampled["key"].to_pylist(), sampled["tie"].to_pylist()))
    cuts = sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)}) if keys else []

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [bisect_right(cuts, x) for x in zip(batch.column("key").to_pylist(), batch.column("tie").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(places, pa.int32())], ["page_id", "host", "path", "key", "part"])

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, parts = [], []
            for i, key in enumerate(batch.column("key").to_pylist()):
                meets = range(bisect_left(cuts, (key, _LEAST)), bisect_left(cuts, (_after(key), _LEAST)) + 1)
                source += [i] * len(meets)
                parts += meets
            columns = [c.take(pa.array(source, pa.int64())) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.int32())], [*batch.schema.names, "part"])

    text = lambda name: F.coalesce(F.col(name), F.lit(""))
    ruled = rules.select(F.translate(text("host"), UPPER, LOWER).alias("host"), text("path").alias("path"), "verdict")
    ruled = ruled.withColumn("key", host_key(F.col("host")))
    placed_rules = ruled.mapInArrow(spread, "host string, path string, verdict string, key string, part int")
    placed_pages = parsed.mapInArrow(place, "page_id long, host string, path string, key string, part int")
    both = placed_rules.select(F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("page_id"), "host", "path", "key", "part", "verdict")
    both = both.unionByName(placed_pages.select(F.lit(1).alias("kind"), "*", F.lit(None).cast("string").alias("verdict")))

    def sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, str, str, tuple]] = []
        part = None
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            names = ("kind", "page_id", "host", "path", "key", "part", "verdict")
            for kind, page, host, path, key, here, verdict in zip(*[batch.column(n).to_pylist() for n in names]):
                if here != part:
                    part, stack = here, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    stack.append((key, path, verdict, (len(host) + len(path), len(host), verdict == "block"), host + path))
                    continue
                fits = [s for s in stack if path.startswith(s[1])]
                best = max(fits, key=lambda s: s[3]) if fits else None
                row = (page, host, path, best[4] if best else None, best[2] if best else default)
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int64(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, kinds)], ["page_id", "host", "path", "rule", "verdict"]
            )

    ordered = both.repartition(tasks, "part").sortWithinPartitions("part", "key", "kind")
    return ordered.mapInArrow(sweep, "page_id long, host string, path string, rule string, verdict string")
