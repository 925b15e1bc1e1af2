"""Prefix trie of conversations: which prefixes are shared, by whom, and what sharing saves.

A node is a distinct sequence of first turns. Turns are ranked and prefixes are hashed in ranges of (conversation,
turn); only the state at the end of each range is carried to the next, so a conversation of any
length is spread over many tasks. A prefix's hash is a polynomial modulo 2^127 - 1 over the turns' digests, so that the hashes of
two stretches can be joined. A node is named by its smallest member and its depth; sums over subtrees are
formed by time-forward processing (``timeforward``).

Defined cases: null roles and texts are empty; null turns come first; turns with one number go by role, then
text; rows without a conversation id take no part; a turn that occurs twice counts twice; an empty
table has no nodes, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorset.llm.timeforward import QUEUE_ROWS, SHARD_ROWS, subtree_totals
from mirrorset.operators.joins import lookup_join
from mirrorset.sources.staging import stage

# A prime modulus, a base below it and the root's key.
_PRIME = (1 << 127) - 1
_BASE = 0x5BD1E9955BD1E9953C6EF372FE94F82B
_ROOT = bytes(16)
_FIRST = -(1 << 63)
CHUNK_BYTES = 1 << 16


def _number(key: bytes) -> int:
    return int.from_bytes(key, "big") % _PRIME


def _bytes(number: int) -> bytes:
    return number.to_bytes(16, "big")


def _runs(conv: np.ndarray) -> np.ndarray:
    """Position of the first row of each row's run of equal values."""
    starts = np.concatenate(([True], conv[1:] != conv[:-1]))
    return np.maximum.accumulate(np.where(starts, np.arange(len(conv)), 0))


def ranked_turns(conversations: DataFrame) -> DataFrame:
    """``conv, rn, key, chars``: every turn's rank in its conversation, digest and length; texts are left behind."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn"), role.alias("role"), text.alias("text")
    )
    order = ["conv", "turn", "role", "text"]
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    digested = sorted_rows.select("conv", digest.alias("key"), F.length("text").cast("bigint").alias("chars"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv").to_numpy()
            first = _runs(conv)
            rank = np.arange(1, len(conv) + 1) - first
            if conv[0] == last:
                rank[first == 0] += count
            last, count = conv[-1], int(rank[-1])
            columns = [pa.array(np.full(len(conv), part, np.int64)), *batch.columns, pa.array(rank)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "conv", "key", "chars", "rank"])

    placed = stage(digested.mapInArrow(work, "part long, conv long, key binary, chars long, rank long"), "turns")
    ends = _ends(placed, "rank")
    carried, before = [], {}
    for part, first, last, state in ends:
        held = before.get(first, 0)
        if held:
            carried.append((part, first, held))
        before = {last: state.rank + (held if first == last else 0)}
    offsets = F.broadcast(conversations.sparkSession.createDataFrame(carried, "part long, conv long, held long"))
    rank = (F.col("rank") + F.coalesce("held", F.lit(0))).alias("rn")
    return placed.join(offsets, ["part", "conv"], "left").select("conv", rank, "key", "chars")


def _ends(placed: DataFrame, *state: str) -> list[tuple]:
    """Per range in order: its number, its first and last conversation and the state at its end; one row a range."""
    last = F.max_by(F.struct(*state), F.struct("conv", state[0])).alias("state")
    parts = placed.groupBy("part").agg(F.min("conv").alias("a"), F.max("conv").alias("b"), last).collect()
    return sorted(((r.part, r.a, r.b, r.state) for r in parts), key=lambda r: r[0])


def rebuilt(turns: DataFrame, group: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Turns with heads exchanged, all conversations, and the conversations left without a turn.

    Conversation c takes the first h turns of conversation c - c % ``group``, with h = crc32(c) %
    (``most`` + 1), and goes on with its own turns after its first h. A head has at most ``most`` turns and
    is taken by at most ``group`` conversations, so the join is bounded by key.
    """
    taken = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(most + 1))
    convs = turns.groupBy("conv").agg(F.max("rn").alias("len"))
    asked = convs.select(F.col("conv").alias("c"), taken.alias("h"), (F.col("conv") - F.col("conv") % group).alias("b"), "len")
    firsts = turns.where(F.col("rn") <= most)
    on = (F.col("b") == F.col("conv")) & (F.col("rn") <= F.col("h"))
    heads = asked.where("h > 0").join(firsts, on).select(F.col("c").alias("conv"), "rn", "key", "chars")
    tails = turns.where(F.col("rn") > taken)
    there = convs.select(F.col("conv").alias("b"))
    turnless = asked.where("len <= h").join(there, "b", "left_anti").select(F.col("c").alias("conv"))
    return heads.unionByName(tails), convs.select("conv"), turnless


_PREFIX = "conv long, depth long, key binary, parent binary, chars long, top long, is_end boolean"


def prefixes(turns: DataFrame) -> DataFrame:
    """One row for each conversation and depth: hash of the prefix and of the one before, and whether it is the whole."""
    rows = turns.repartitionByRange("conv", "rn").sortWithinPartitions("conv", "rn").select("conv", "key", "chars")

    def local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, current, pending = TaskContext.get().partitionId(), None, None
        depth = total = power = top = 0
        names = [c.split()[0] for c in _PREFIX.split(", ")] + ["part"]

        def batch_of(rows: list[list]) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            out = []
            for conv, key, chars in zip(*[batch.column(c).to_pylist() for c in ("conv", "key", "chars")]):
                if conv != current:
                    current, depth, total, power = conv, 0, 0, 1
                    top = int.from_bytes(key[:8], "big", signed=True)
                    ended = True
                else:
                    ended = False
                if pending:
                    pending[6] = ended
                    out.append(pending)
                before, depth = total, depth + 1
                total = (total + _number(key) * power) % _PRIME
                power = power * _BASE % _PRIME
                pending = [conv, depth, _bytes(total), _bytes(before), chars, top, None, part]
            if out:
                yield batch_of(out)
        if pending:
            yield batch_of([pending])

    placed = stage(rows.mapInArrow(local, f"{_PREFIX}, part long"), "prefixes")
    ends = _ends(placed, "depth", "key", "top")
    carried: dict[int, tuple] = {}
    closes = {part: i + 1 == len(ends) or ends[i + 1][1] != last for i, (part, _, last, _) in enumerate(ends)}
    before: dict[int, tuple] = {}
    for part, first, last, state in ends:
        held = before.get(first)
        if held:
            carried[part] = (first, *held)
        own = (state.depth, _number(state.key), state.top)
        if held and first == last:
            own = (held[0] + own[0], (held[1] + pow(_BASE, held[0], _PRIME) * own[1]) % _PRIME, held[2])
        before = {last: own}

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = {part: pow(_BASE, held[1], _PRIME) for part, held in carried.items()}
        for batch in batches:
            part, conv = (batch.column(c).to_numpy() for c in ("part", "conv"))
            columns = {c: batch.column(c) for c in batch.schema.names if c != "part"}
            later = np.flatnonzero([carried.get(p, (None,))[0] == c for p, c in zip(part.tolist(), conv.tolist())])
            if len(later):
                lists = {c: columns[c].to_pylist() for c in ("depth", "key", "parent", "top")}
                for i in later.tolist():
                    _, depth, total, top = carried[part[i]]
                    lists["depth"][i] += depth
                    for c in ("key", "parent"):
                        lists[c][i] = _bytes((total + shifts[part[i]] * _number(lists[c][i])) % _PRIME)
                    lists["top"][i] = top
                columns |= {c: pa.array(v, columns[c].type) for c, v in lists.items()}
            if columns["is_end"].null_count:
                shown = columns["is_end"].to_pylist()
                columns["is_end"] = pa.array([closes[p] if e is None else e for e, p in zip(shown, part.tolist())], pa.bool_())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return placed.mapInArrow(joined, _PREFIX)


def end_digests(ends: DataFrame) -> DataFrame:
    """``depth, key, ends_sha256``: digest of the comma-joined conversations ``conv`` that end at each node.

    Each range of (node, conversation) joins its ids to pieces of text; a node's pieces are then hashed one after
    the other. No list is held whole, however many conversations end at a node.
    """

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.binary(), pa.int64(), pa.string()]
        node, first, texts, size = None, None, [], 0
        out: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], ["depth", "key", "first", "piece"]
            )

        for batch in batches:
            for depth, key, conv in zip(*[batch.column(c).to_pylist() for c in ("depth", "key", "conv")]):
                if (depth, key) != node or size > CHUNK_BYTES:
                    if texts:
                        out.append((*node, first, ",".join(texts)))
                    node, first, texts, size = (depth, key), conv, [], 0
                texts.append(str(conv))
                size += len(texts[-1]) + 1
            if out:
                yield batch_of(out)
                out = []
        if texts:
            yield batch_of([(*node, first, ",".join(texts))])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.binary(), pa.string()]
        node, state = None, None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], ["depth", "key", "ends_sha256"]
            )

        for batch in batches:
            out = []
            for depth, key, piece in zip(*[batch.column(c).to_pylist() for c in ("depth", "key", "piece")]):
                if (depth, key) == node:
                    state.update(b"," + piece.encode())
                    continue
                if node:
                    out.append((*node, state.hexdigest()))
                node, state = (depth, key), hashlib.sha256(piece.encode())
            if out:
                yield batch_of(out)
        if node:
            yield batch_of([(*node, state.hexdigest())])

    order = ["depth", "key", "conv"]
    ranges = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    joined = ranges.mapInArrow(pieces, "depth long, key binary, first long, piece string")
    together = joined.repartition("depth", "key").sortWithinPartitions("depth", "key", "first").select("depth", "key", "piece")
    return together.mapInArrow(digest, "depth long, key binary, ends_sha256 string")


def _long(value) -> Column:
    return F.lit(value).cast("bigint")


def prefix_trie(
    turns: DataFrame,
    convs: DataFrame,
    turnless: DataFrame,
    shard_rows: int = SHARD_ROWS,
    queue_rows: int = QUEUE_ROWS,
) -> DataFrame:
    """One row per node of the trie of ``turns`` (``conv, rn, key, chars``), which are the turns of ``convs`` but ``turnless``."""
    rows = prefixes(turns)
    inner = rows.groupBy("depth", "key", "parent").agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv").alias("conv_id"),
        F.min("chars").alias("chars"),
        F.count_if("is_end").alias("n_ends"),
        F.min("top").alias("top"),
    )
    none = turnless.agg(F.count(F.lit(1)).alias("n")).scalar()
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id")).where("n_convs > 0")
    root = root.select(
        _long(0).alias("depth"),
        F.lit(_ROOT).alias("key"),
        F.lit(None).cast("binary").alias("parent"),
        "n_convs",
        "conv_id",
        _long(0).alias("chars"),
        none.alias("n_ends"),
        _long(_FIRST).alias("top"),
    )
    nodes = stage(inner.unionByName(root), "nodes")
    parents = nodes.select(
        F.col("key").alias("_key"), (F.col("depth") + 1).alias("_depth"), F.col("conv_id").alias("parent_conv_id")
    )
    linked = lookup_join(nodes, parents, {"parent": "_key", "depth": "_depth"}, "left", False)
    has_parent = F.col("parent").isNotNull()
    above = F.when(F.col("depth") == 1, _long(_FIRST)).otherwise(F.col("top"))
    tree = linked.select(
        F.col("top").alias("o1"),
        F.col("conv_id").alias("o2"),
        F.col("depth").alias("o3"),
        F.when(has_parent, above).alias("p1"),
        F.col("parent_conv_id").alias("p2"),
        F.when(has_parent, F.col("depth") - 1).alias("p3"),
        F.col("depth").alias("level"),
        F.when(has_parent, F.col("depth") - 1).alias("plevel"),
        (F.col("n_ends") == F.col("n_convs")).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        "n_convs",
        "key",
    )
    totals = subtree_totals(stage(tree, "tree"), shard_rows, queue_rows)
    whole = rows.where("is_end").select("depth", "key", "conv")
    at_root = turnless.select(_long(0).alias("depth"), F.lit(_ROOT).alias("key"), "conv")
    ends = end_digests(whole.unionByName(at_root))
    return totals.join(ends, [totals.o3 == ends.depth, totals.key == ends.key], "left").select(
        F.col("o2").alias("conv_id"),
        F.col("o3").alias("depth"),
        F.col("p2").alias("parent_conv_id"),
        "n_convs",
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
