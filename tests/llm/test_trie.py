"""The prefix trie against dictionaries of whole prefixes."""

import hashlib
import heapq
import math
import random
import zlib
from collections import defaultdict

import pytest

from mirrorset.llm import timeforward, trie
from mirrorset.llm.spilling import SpillingQueue

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    members = defaultdict(list)
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = convs.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not children[node]
        if node:
            saved[node] += (len(members[node]) - 1) * len(node[-1][1].decode())
            for totals in (leaves, saved):
                totals[node[:-1]] += totals[node]
            children[node[:-1]] += 1
    out = []
    for node, ms in members.items():
        ends = ",".join(map(str, sorted(c for c in ms if len(rebuilt[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(ms), len(node), parent, len(ms), children[node], leaves[node], saved[node], digest))
    return sorted(out)


def check(df, rows, **options):
    turns = trie.ranked_turns(df)
    got = trie.prefix_trie(*trie.rebuilt(turns), **options)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


@pytest.mark.parametrize("options", [{}, {"shard_rows": 40, "queue_rows": 3}])
def test_equals_dictionaries(spark, sf, options):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    check(df, [tuple(r) for r in df.collect()], **options)


def odd_rows():
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é", "", None])) for c in range(400) for t in range(rng.randrange(1, 5))]
    rows += [(950, t, "user", f"{t % 7}") for t in range(1500)]  # one conversation with half of all turns
    rows += [(951, t, "user", f"{t % 7}") for t in range(1200)]
    rows += [(600 + c, 0, "system", "the same") for c in range(300)]  # all alike
    rows += [(None, 1, "user", "x"), (-5, None, None, None), (-5, 2, "user", "z"), (-100, 1, "a", "b"), (12345, 0, "only", "one")]
    rows += [(1002, 3, "b", "tie"), (1002, 3, "a", "tie"), (1002, None, "c", "first"), (1002, None, "c", "first")]
    return rows


@pytest.mark.parametrize("options", [{}, {"shard_rows": 60, "queue_rows": 5}])
def test_odd_rows(spark, options):
    rows = odd_rows()
    df = spark.createDataFrame(rows, TURNS).repartition(9).selectExpr("*", "1 AS depth", "2 AS conv", "3 AS rn", "4 AS part")
    check(df, rows, **options)


def test_empty_and_turnless(spark):
    check(spark.createDataFrame([], TURNS), [])
    single = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6)  # its head is absent, its turn is replaced
    rows = [(single, 0, "user", "gone"), (250, 0, "user", "x")]
    check(spark.createDataFrame(rows, TURNS), rows)
    check(spark.createDataFrame(rows[:1], TURNS), rows[:1])


def test_long_text(spark):
    rows = [(1, 0, "user", "long " * 200_000), (2, 0, "user", "long " * 200_000), (101, 0, "user", "y")]
    check(spark.createDataFrame(rows, TURNS), rows)


def random_tree(n, chain):
    rng, parents = random.Random(n), [None]
    for i in range(1, n):
        parents.append(i - 1 if rng.random() < chain else rng.randrange(i))
    return parents


@pytest.mark.parametrize("chain", [0.0, 0.7, 1.0])
def test_subtree_totals(spark, chain):
    """Random trees, down to a single chain, over many small shards; few parents lie in their child's shard."""
    parents = random_tree(800, chain)
    levels = [0]
    for p in parents[1:]:
        levels.append(levels[p] + 1)
    leaves, saved, children = [i % 3 for i in range(800)], [i % 11 for i in range(800)], [0] * 800
    rows = [
        (0, i, 0, *((None,) * 3 if p is None else (0, p, 0)), levels[i], None if p is None else levels[p], leaves[i], saved[i], i, None)
        for i, p in enumerate(parents)
    ]
    for i in range(799, 0, -1):
        for values in (leaves, saved):
            values[parents[i]] += values[i]
        children[parents[i]] += 1
    tree = spark.createDataFrame(rows, timeforward._schema(timeforward._TREE))
    got = timeforward.subtree_totals(tree, 50, 4).select("o2", "children", "leaves", "saved", "n_convs").collect()
    assert sorted(tuple(r) for r in got) == [(i, children[i], leaves[i], saved[i], i) for i in range(800)]


def test_queue_spills_in_order():
    rng, queue, plain, out = random.Random(1), SpillingQueue(10), [], []
    for step in range(3_000):
        if plain and rng.random() < 0.45:
            assert queue.peek() == plain[0]
            out.append(queue.pop())
            assert out[-1] == heapq.heappop(plain)
        else:
            entry = ((out[-1][0] if out else 0) + rng.randrange(50), step % 5)
            queue.push(entry)
            heapq.heappush(plain, entry)
    while plain:
        assert queue.pop() == heapq.heappop(plain)
    assert queue.peek() is None and queue.runs > 5
