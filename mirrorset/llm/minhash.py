"""Near-duplicate classes by ProbMinHash, banding and exact verification.

A text is its five-word shingles, each weighted by how often it occurs. Each shingle is a Poisson process
whose rate is its weight: its arrivals hit random registers, a register keeps the earliest, and a
shingle is left as soon as its next arrival is later than all registers hold. Two texts agree in a
register with their probability Jaccard similarity. Registers are banded; texts that share a band are compared by
that similarity, computed exactly, and the classes are the connected components of the pairs at or above the threshold.

Two texts that differ in how often a line repeats may have the same shingles and yet a low probability Jaccard
similarity. They are near duplicates too: a text with a repeated shingle is also sketched with weight 1 for each,
which makes the probability Jaccard similarity that of the sets, and the greater of the two counts.

Equal texts are grouped first and go on as one. In each bucket all texts are compared with its least
text; where the rest of a bucket then still lies in several classes, its texts are compared with
each other in square blocks of bounded size, so no candidate pair between classes is left out and
no group is expanded into pairs.

Defined cases: a null text counts as empty; texts without words are alike only if they are equal; texts
of fewer than five words have one shingle; the class id is the least doc_id of the class (null if it has none);
repeated rows are kept, in the same class. Other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mirrorset.llm.common import blocks, mix64, ragged, signed
from mirrorset.llm.components import components
from mirrorset.llm.shingles import shingles, similarity, similarity_of
from mirrorset.operators.joins import lookup_join
from mirrorset.sources.staging import stage

SIZE = 5
THRESHOLD = 0.8
BANDS, ROWS = 20, 5
#: Texts of one side of a block in which all pairs are compared.
BLOCK_TEXTS = 128
_NO_ID = np.iinfo(np.int64).min


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """The shingle kept by each register of each text (0 where a text has none)."""
    earliest = np.full(texts * registers, np.inf)
    kept = np.zeros(texts * registers, np.uint64)
    arrival = np.zeros(len(element))
    turn = 0
    while len(element):
        turn += 1
        random = mix64(element + np.uint64(turn * 0x9E3779B97F4A7C15 % (1 << 64)))
        arrival = arrival - np.log(((random >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)) / weight
        register = (mix64(random ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(registers)).astype(np.int64)
        slot = owner * registers + register
        hits = np.flatnonzero(arrival < earliest[slot])
        if len(hits):
            order = hits[np.lexsort((element[hits], arrival[hits], slot[hits]))]
            head = np.ones(len(order), bool)
            head[1:] = slot[order[1:]] != slot[order[:-1]]
            won = order[head]
            earliest[slot[won]] = arrival[won]
            kept[slot[won]] = element[won]
        concerned, place = np.unique(owner, return_inverse=True)
        latest = earliest.reshape(texts, registers)[concerned].max(axis=1)
        active = arrival < latest[place]
        owner, element, weight, arrival = owner[active], element[active], weight[active], arrival[active]
    return kept.reshape(texts, registers)


def band_keys(kept: np.ndarray, bands: int) -> np.ndarray:
    """One hash per text and band, different for different bands."""
    parts = kept.reshape(len(kept), bands, kept.shape[1] // bands)
    keys = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for i in range(parts.shape[2]):
        keys = mix64(keys * np.uint64(0x100000001B3) + parts[:, :, i])
    return keys


def _signed(documents: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, k`` (digest of the text) and the band keys of each row."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            owner, element, often = shingles(block.column("text"), size)
            kept = signatures(owner, element, often.astype(float), block.num_rows, bands * rows)
            keys = signed(band_keys(kept, bands))
            filled = np.bincount(owner, minlength=block.num_rows) > 0
            uneven = np.bincount(owner, often > 1, block.num_rows) > 0
            some = uneven[owner]
            sets = signatures((np.cumsum(uneven) - 1)[owner[some]], element[some], np.ones(int(some.sum())), int(uneven.sum()), bands * rows)
            set_keys = iter(signed(band_keys(sets, bands)).tolist())
            digests = [hashlib.md5((t or "").encode("utf-8", "surrogatepass")).digest() for t in block.column("text").to_pylist()]
            lists = [
                ([*dict.fromkeys(x + next(set_keys))] if u else x) if f else [] for x, f, u in zip(keys.tolist(), filled, uneven)
            ]
            columns = [block.column("doc_id"), pa.array(digests), pa.array(lists, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "k", "bands"])

    given = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return given.mapInArrow(work, "doc_id long, k binary, bands array<long>")


def _id(name: str = "doc_id"):
    return F.coalesce(F.col(name).cast("bigint"), F.lit(_NO_ID))


def _digest():
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def _similar(pairs: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """The pairs ``u, v`` whose texts are similar enough."""
    left = texts.select(F.col("node").alias("_left"), F.col("text").alias("left_text"))
    right = texts.select(F.col("node").alias("_right"), F.col("text").alias("right_text"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(blocks(batches, "left_text"), "right_text"):
            alike = similarity(block.column("left_text"), block.column("right_text"), size)
            yield block.select(["u", "v"]).filter(pa.array(alike >= threshold - 1e-9))

    # A bucket's least text meets all others of it: such texts are given out by salts.
    found = pairs.join(left, F.col("u") == F.col("_left"))
    found = lookup_join(found, right, {"v": "_right"}, "inner", False, counted=pairs)
    return found.select("u", "v", "left_text", "right_text").mapInArrow(work, "u long, v long")


def _block_links(rest: DataFrame, size: int, threshold: float) -> DataFrame:
    """Links ``u, v`` between different classes inside blocks ``bucket, i, j`` of ``node, class, text``."""

    def links(block: pa.Table) -> pa.Table:
        nodes, first = np.unique(block.column("node").to_numpy(), return_index=True)
        text = block.column("text").combine_chunks().take(pa.array(first))
        of = block.column("class").to_numpy()[first]
        owner, value, weight = shingles(text, size)
        n = len(nodes)
        sizes = np.bincount(owner, minlength=n)
        _, code, often = np.unique(value, return_inverse=True, return_counts=True)
        shared = often[code] > 1
        rank = np.cumsum(often > 1) - 1
        column, line = rank[code[shared]], owner[shared]
        part = (weight / np.maximum(np.bincount(owner, weight, n), 1)[owner])[shared].astype(np.float32)
        both, mass = np.zeros((n, n), np.float32), np.zeros((n, n), np.float32)
        order = np.argsort(column, kind="stable")
        column, line, part = column[order], line[order], part[order]
        uneven = np.bincount(owner, weight > 1, n) > 0
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            a, b = np.searchsorted(column, (start, start + 4096))
            held = np.zeros((n, 4096), np.float32)
            held[line[a:b], column[a:b] - start] = 1
            both += held @ held.T
            if uneven.any():
                shares = np.zeros((n, 4096), np.float32)
                shares[line[a:b], column[a:b] - start] = part[a:b]
                mass += shares @ held.T
        union = sizes[:, None] + sizes[None, :] - both
        apart = np.triu(of[:, None] != of[None, :], 1)
        near = (both >= threshold * union - 1e-6) & (union > 0) & apart
        up = {c: c for c in of.tolist()}  # only links that join classes of this block for the first time go out

        def top(x: int) -> int:
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        out = []

        def link(a: int, b: int) -> None:
            p, q = top(int(of[a])), top(int(of[b]))
            if p != q:
                up[p] = q
                out.append((int(of[a]), int(of[b])))

        for a, b in np.argwhere(near).tolist():
            link(a, b)
        # The share of a text's weight on shingles of the other bounds their probability Jaccard similarity from above;
        # where no shingle of either repeats, it is that of the sets.
        bound = np.minimum(mass, mass.T)
        open_ = np.argwhere((bound >= threshold - 1e-4) & apart & ~near & (uneven[:, None] | uneven[None, :])).tolist()
        begin, count = np.searchsorted(owner, np.arange(n)), np.bincount(owner, minlength=n)

        def given(texts: np.ndarray) -> tuple[np.ndarray, ...]:
            at = ragged(begin[texts], count[texts])
            return np.repeat(np.arange(len(texts)), count[texts]), value[at], weight[at]

        while open_:  # pairs that meanwhile lie in one class need no look
            asked = [(a, b) for a, b in open_[:2048] if top(int(of[a])) != top(int(of[b]))][:256]
            seen = open_.index(list(asked[-1])) + 1 if asked else min(len(open_), 2048)
            open_ = open_[seen:]
            if asked:
                i, j = np.array(asked).T
                for (a, b), alike in zip(asked, similarity_of(given(i), given(j), len(asked))):
                    if alike >= threshold - 1e-9:
                        link(a, b)
        return pa.table({"u": pa.array([a for a, _ in out], pa.int64()), "v": pa.array([b for _, b in out], pa.int64())})

    return rest.groupBy("bucket", "i", "j").applyInArrow(links, "u long, v long")


def classes(
    documents: DataFrame, size: int = SIZE, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS
) -> tuple[DataFrame, DataFrame]:
    """Rows ``doc_id, k`` of all documents, and per distinct text ``k, first, class_id, lead``.

    ``first`` is the least id with that text; ``lead`` marks the one text of each class that
    has the class's id.
    """
    every = stage(_signed(documents, size, bands, rows), "signatures")
    distinct = every.groupBy("k").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"))
    nodes = stage(distinct.withColumn("node", F.monotonically_increasing_id()), "texts")
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    leaders = buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stage(buckets.join(leaders, "bucket").where("node <> leader"), "buckets")
    pairs = shared.select(F.col("node").alias("u"), F.col("leader").alias("v")).distinct()
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    chosen = nodes.join(wanted, "node").select("node", "k", _id("first").alias("id"))
    # Joined by digest and id, so the copies of one text spread over the partitions.
    given = documents.select(_digest().alias("k"), _id().alias("id"), "text")
    once = given.groupBy("k", "id").agg(F.first("text").alias("text"))  # a repeated row is one text
    texts = stage(once.join(chosen, ["k", "id"]).select("node", "text"), "candidates")
    linked = stage(_similar(pairs, texts, size, threshold), "links")
    first_roots = components(linked)

    # Texts of a bucket, beside its leader, that lie in different classes.
    classed = (
        shared.where("n > 2")
        .join(first_roots, "node", "left")
        .select("bucket", "node", F.coalesce("root", "node").alias("class"), F.xxhash64("node").cast("decimal(20,0)").alias("h"))
    )
    mixed = (
        classed.groupBy("bucket")
        .agg(
            F.min("class").alias("low"),
            F.max("class").alias("high"),
            F.count(F.lit(1)).alias("members"),
            F.sum("h").alias("sum"),
            F.min("node").alias("least"),
        )
        .where("low <> high")
        .groupBy("members", "sum", "least")  # the same texts often share several bands
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket", F.ceil(F.col("members") / BLOCK_TEXTS).cast("int").alias("parts"))
    )
    rest = (
        classed.join(mixed, "bucket")
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "node", "class")
        .join(texts, "node")
    )
    # What blocks find are links between classes, so the second search runs on those alone.
    joined = components(_block_links(rest, size, threshold)).select(F.col("node").alias("class"), F.col("root").alias("top"))
    classed_texts = (
        nodes.join(first_roots, "node", "left")
        .select("k", "first", "node", F.coalesce("root", "node").alias("class"))
        .join(joined, "class", "left")
        .select("k", "first", F.coalesce("top", "class").alias("root"), "node")
    )
    ids = classed_texts.groupBy("root").agg(
        F.min("first").alias("class_id"), F.min_by("node", F.struct(F.col("first").isNull(), "first", "node")).alias("best")
    )
    of_text = classed_texts.join(ids, "root").select("k", "first", "class_id", (F.col("node") == F.col("best")).alias("lead"))
    return every.select("doc_id", "k"), of_text


def near_duplicates(documents: DataFrame, **options) -> DataFrame:
    """``doc_id, class_id, kept`` per row; ``kept`` marks the texts that lead their class."""
    every, of_text = classes(documents, **options)
    leads = (F.col("lead") & F.col("doc_id").eqNullSafe(F.col("first"))).alias("kept")
    return every.join(of_text, "k").select("doc_id", "class_id", leads)


def keep_one(documents: DataFrame, **options) -> DataFrame:
    """One whole row of each class, the one with the least id; all columns of the input."""
    _, of_text = classes(documents, **options)
    leads = of_text.where("lead").select(F.col("k").alias("_k"), _id("first").alias("_id"))
    rows = documents.withColumns({"_k": _digest(), "_id": _id()})
    alike = Window.partitionBy("_k", "_id").orderBy(F.lit(1))
    chosen = rows.join(leads, ["_k", "_id"]).withColumn("_n", F.row_number().over(alike))
    return chosen.where("_n = 1").select(*documents.columns)
