"""Totals over the subtrees of a tree of any shape, by time-forward processing.

Nodes are sorted externally into reverse level order, deepest first, and each passes its total to
its parent through a priority queue that spills. Since the parent's turn always comes later, one sweep does it.

The tree is cut into shards, which are ranges of an order in which parents precede their children; they have
a bounded size whatever the tree looks like, so a chain that holds a third of all nodes, or a node with a third of all
children, is spread over many. What a shard's sweep has left over in its queue are the totals of
its shard roots, added up by the node outside that they go to. These form a smaller tree (one node for each shard
and outside parent), which is solved in the same way. A second sweep over the shards starts
from the messages that come in from other shards.

Columns of a tree: ``o1, o2, o3`` (longs, the unique order), ``p1, p2, p3`` (the parent's, null for a root), ``level``
and ``plevel`` (less), ``leaves`` and ``saved`` (a node's own share) and two columns that are only passed on, ``n_convs, key``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorset.llm.spilling import SpillingQueue
from mirrorset.sources.staging import stage

SHARD_ROWS = 100_000
QUEUE_ROWS = 50_000
_ORDER = ["o1", "o2", "o3"]
_PARENT = ["p1", "p2", "p3"]
_TREE = [*_ORDER, *_PARENT, "level", "plevel", "leaves", "saved", "n_convs", "key"]
_LABEL = ["r1", "r2", "r3", "rlevel"]
_TYPES = {"key": "binary"}
#: ``kind`` 0 is a node, 1 a message to the node ``o1, o2, o3``.
_PLACED = ["shard", "kind", "nid", *_TREE, "children", *_LABEL]


def _schema(names: list[str]) -> str:
    return ", ".join(f"{n} {_TYPES.get(n, 'long')}" for n in names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    types = [pa.binary() if _TYPES.get(n) == "binary" else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _tuples(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple]:
    return zip(*[batch.column(n).to_pylist() for n in names])


def _labelled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's nodes with shard, number and label: the node outside the shard that their chain of parents leads to."""
    shard, count = TaskContext.get().partitionId(), 0
    labels: dict[tuple, tuple] = {}
    for batch in batches:
        out = []
        for row in _tuples(batch, _TREE):
            own, parent = row[:3], row[3:6]
            if parent[0] is None:
                label = (None,) * 4
            else:
                label = labels.get(parent) or (*parent, row[7])
            labels[own] = label
            out.append((shard, 0, (shard << 33) + count, *row, 0, *label))
            count += 1
        yield _batch(out, _PLACED)


def _sweep(batches: Iterable[pa.RecordBatch], limit: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Shards of nodes and messages in reverse level order.

    The first sweep returns the rows as they come, and what is left for outside nodes as messages. The ``last``
    one returns the nodes with their totals.
    """
    queue, current = SpillingQueue(limit), None
    at = {name: i for i, name in enumerate(_PLACED)}
    own, parent = slice(at["o1"], at["o3"] + 1), slice(at["p1"], at["p3"] + 1)

    def left_over(upto: tuple | None) -> Iterator[tuple]:
        """Entries for nodes that did not come, each node's added up."""
        held = None
        while (head := queue.peek()) is not None and (upto is None or head[:4] < upto):
            entry = queue.pop()
            if held is not None and held[:4] == entry[:4]:
                held = (*held[:4], *(a + b for a, b in zip(held[4:], entry[4:])))
                continue
            if held is not None:
                yield held
            held = entry
        if held is not None:
            yield held

    def message(entry: tuple) -> tuple:
        minus_level, *target, children, leaves, saved = entry
        return (current, 1, None, *target, None, None, None, -minus_level, None, leaves, saved, None, None, children, *(None,) * 4)

    for batch in batches:
        out: list[tuple] = []
        for row in _tuples(batch, _PLACED):
            if row[0] != current:
                rest = [message(e) for e in left_over(None)]
                out += [] if last else rest
                current = row[0]
            place = (-row[at["level"]], *row[own])
            rest = [message(e) for e in left_over(place)]
            out += [] if last else rest
            if row[1]:
                queue.push((*place, row[at["children"]], row[at["leaves"]], row[at["saved"]]))
                continue
            children, leaves, saved = 0, row[at["leaves"]], row[at["saved"]]
            while (head := queue.peek()) is not None and head[:4] == place:
                entry = queue.pop()
                children, leaves, saved = children + entry[4], leaves + entry[5], saved + entry[6]
            if row[at["p1"]] is not None:
                queue.push((-row[at["plevel"]], *row[parent], 1, leaves, saved))
            if last:
                total = list(row)
                total[at["children"]], total[at["leaves"]], total[at["saved"]] = children, leaves, saved
                out.append(tuple(total))
            else:
                out.append(row)
        yield _batch(out, _PLACED)
    if not last and current is not None:
        yield _batch([message(e) for e in left_over(None)], _PLACED)


def _by_level(rows: DataFrame, *first: str) -> DataFrame:
    return rows.sortWithinPartitions(*first, F.desc("level"), *_ORDER, F.desc("kind"))


def subtree_totals(tree: DataFrame, shard_rows: int = SHARD_ROWS, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """The nodes with ``children`` and, over their subtrees, the sums of ``leaves`` and ``saved``.

    A task's memory is bounded by ``shard_rows`` nodes and ``queue_rows`` entries. If less than half of a tree's
    nodes have their parent in the same shard, the next tree's shards are four times as large.
    """
    nodes = tree.count()
    shards = max(1, math.ceil(nodes / shard_rows))

    def first(batches):
        return _sweep(batches, queue_rows, False)

    def last(batches):
        return _sweep(batches, queue_rows, True)

    schema = _schema(_PLACED)
    ranges = tree.select(*_TREE).repartitionByRange(shards, *_ORDER).sortWithinPartitions(*_ORDER)
    labelled = ranges.mapInArrow(_labelled, schema)
    if shards == 1:
        return _by_level(labelled).mapInArrow(last, schema)
    placed = stage(_by_level(labelled).mapInArrow(first, schema), "shards")
    messages = placed.where("kind = 1").select("shard", *_ORDER, "level", "children", "leaves", "saved")
    targets = messages.select(*_ORDER).distinct()
    known = stage(
        placed.where("kind = 0")
        .join(targets, _ORDER)
        .select(*_ORDER, F.col("nid").alias("t"), F.col("shard").alias("t_shard"), *_LABEL),
        "targets",
    )
    labels = known.select(*[F.col(o).alias(r) for o, r in zip(_ORDER, _LABEL)], F.col("t").alias("r"))
    resolved = known.join(labels, _LABEL[:3], "left").select(*_ORDER, "t", "t_shard", "r", "rlevel")
    sent = stage(messages.join(resolved, _ORDER), "messages")
    parent_shard = F.when(F.col("r").isNotNull(), F.col("t_shard"))
    above = sent.select(
        F.col("shard").alias("o1"),
        F.col("t").alias("o2"),
        F.lit(0).cast("bigint").alias("o3"),
        parent_shard.alias("p1"),
        F.col("r").alias("p2"),
        F.when(F.col("r").isNotNull(), F.lit(0)).cast("bigint").alias("p3"),
        "level",
        F.col("rlevel").alias("plevel"),
        "leaves",
        "saved",
        F.lit(None).cast("bigint").alias("n_convs"),
        F.lit(None).cast("binary").alias("key"),
    )
    larger = shard_rows * (4 if sent.count() > nodes / 2 else 1)
    totals = subtree_totals(above, larger, queue_rows).select(
        F.col("o1").alias("shard"), F.col("o2").alias("t"), F.col("leaves").alias("_leaves"), F.col("saved").alias("_saved")
    )
    full = sent.join(totals, ["shard", "t"])
    names = {"shard": "t_shard", "leaves": "_leaves", "saved": "_saved"}
    empty = [c for c in _PLACED if c not in (*_ORDER, "shard", "kind", "level", "children", "leaves", "saved")]
    incoming = full.select(
        *[F.col(names.get(c, c)).alias(c) for c in ("shard", *_ORDER, "level", "children", "leaves", "saved")],
        F.lit(1).cast("bigint").alias("kind"),
        *[F.lit(None).cast(_TYPES.get(c, "bigint")).alias(c) for c in empty],
    )
    both = placed.where("kind = 0").unionByName(incoming.select(*_PLACED))
    return _by_level(both.repartition(shards, "shard"), "shard").mapInArrow(last, schema)
