"""Shards against a plain running sum over the sorted rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from mirrorset.llm.sharding import assign


def brute(rows, shards=16, whole=64):
    keyed = []
    for doc_id, text in rows:
        data = (text or "").encode()
        keyed.append((hashlib.md5(data).hexdigest(), doc_id is not None, doc_id or 0, len(data) + 1, zlib.crc32(data)))
    keyed.sort()
    total, groups, first = sum(k[3] for k in keyed), Counter(), {}
    for k in keyed:
        groups[k[0]] += k[3]
    out, at, slots = [], 0, Counter()
    for group, has_id, doc_id, size, crc in keyed:
        first.setdefault(group, at)
        start = first[group] if groups[group] * shards * whole <= total else at
        shard = start * shards // total
        out.append((doc_id if has_id else None, size, crc, "bytes", shard, slots[shard], None))
        slots[shard] += 1
        at += size
    return out


def check(df, rows, **options):
    got = [tuple(r) for r in assign(df, **options).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows, options.get("shards", 16), options.get("whole", 64)), key=repr)
    return got


def mixed_rows(n):
    rng = random.Random(5)
    rows = [(i, "the same text " * 20) for i in range(n // 3)]
    rows += [(7, "one row, many times")] * (n // 10) + [(i, None if i % 2 else "") for i in range(n // 5)]
    rows += [(i, "".join(rng.choices("abc é\n", k=rng.randrange(400)))) for i in range(n // 2)]
    return rows + [(None, "no id"), (None, None), (3, "long " * 40_000)]


@pytest.mark.parametrize("options", [{}, {"least_rows": 10, "draws": 4}, {"least_rows": 10, "shards": 5, "whole": 1}])
def test_equals_running_sums(make_documents, options):
    rows = mixed_rows(900)
    check(make_documents(rows).repartition(7), rows, **options)


def test_sizes_near_equal_and_groups_whole(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = check(documents, rows, least_rows=20)
    sizes, shards = defaultdict(int), defaultdict(set)
    for (doc_id, size, *_, shard, _, _) in got:
        sizes[shard] += size
    mean, largest = sum(sizes.values()) / 16, max(r[1] for r in got)
    assert max(sizes.values()) <= mean * (1 + 2 / 64) + largest
    texts = dict(rows)
    for r in got:
        shards[texts[r[0]]].add(r[4])
    small = sum(sizes.values()) / 16 / 64
    assert all(len(s) == 1 for t, s in shards.items() if sum(x[1] for x in rows and got if texts[x[0]] == t) <= small)


def test_ranges_are_subdivided(spark, make_documents):
    """A text that all rows share, so that every splitter falls into it, still makes many ranges."""
    from mirrorset.llm import sharding

    rows = [(i % 50, "x") for i in range(3_000)]
    check(make_documents(rows), rows, least_rows=10)
    keyed = make_documents(rows).selectExpr("doc_id AS id", "2L AS size", "'g' AS _group", "monotonically_increasing_id() AS _row")
    bounds, count = sharding._splitters(keyed, 3_000, 6_000, 100, 16, 10)
    parts = sharding._in_ranges(keyed, bounds, count).groupBy("_part").count().collect()
    assert count > 50 and max(r["count"] for r in parts) <= 60


def test_empty_and_clashing_columns(spark, make_documents):
    assert assign(make_documents([])).collect() == []
    rows = [(1, "a"), (2, None)]
    df = make_documents(rows).selectExpr("*", "1 AS shard", "2 AS size", "3 AS _part", "4 AS _group", "5 AS _row", "6 AS id")
    check(df, rows)


def test_no_python_in_the_plan(make_documents):
    plan = assign(make_documents([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
