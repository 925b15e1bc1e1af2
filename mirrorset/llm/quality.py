"""Quality scores from histogram gradient-boosted trees over document statistics.

The statistics of every text are computed by array operations in one pass. Trees are grown on
a bounded sample of labelled rows: each feature is cut into at most 64 bins, splits are read
from sums of gradients per bin, and the fitted trees are kept as flat arrays, through which
all rows of a block step together.

Defined cases: a null text counts as empty and gets a score like any other; rows without a
label or with a null id are scored too (a null id counts as the empty text in the fold rule);
labels that are null are not learned from; without any labelled row every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorset.llm.common import BLOCK_BYTES, SpanHash, blocks, text_bytes

#: At most about this many labelled rows are learned from, drawn evenly by a hash of the id.
SAMPLE_ROWS = 20_000
SIGNS = [ord(c) for c in "!?.,;:-_#$%&*@=|/\\<>{}[]()\"'"]
FEATURES = 24


def _per_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n)


def statistics(column: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` numbers per text: lengths, shares of kinds of bytes, repetition."""
    flat, starts, lengths = text_bytes(column)
    n = len(starts)
    out = np.zeros((n, FEATURES), np.float32)
    if not len(flat):
        return out
    owner = np.repeat(np.arange(n), lengths)
    kinds = np.zeros(256, np.uint8)
    kinds[[9, 10, 11, 12, 13, 32]] = 1
    kinds[ord("a") : ord("z") + 1] = 2
    kinds[ord("A") : ord("Z") + 1] = 3
    kinds[ord("0") : ord("9") + 1] = 4
    kinds[128:] = 5
    kind = kinds[flat]
    table = np.bincount(owner * 6 + kind, minlength=6 * n).reshape(n, 6).astype(np.float64)
    size = np.maximum(lengths, 1).astype(np.float64)
    out[:, 0] = np.log1p(lengths)
    out[:, 1:6] = table[:, 1:6] / size[:, None]
    out[:, 6] = table[:, 0] / size
    signs = np.zeros(256, np.uint8)
    signs[[ord(c) for c in "!?"]] = 1
    signs[[ord(c) for c in ".,;:"]] = 2
    signs[[ord(c) for c in "#$%&*@=|/\\<>{}[]_~^+"]] = 3
    sign = np.bincount(owner * 4 + signs[flat], minlength=4 * n).reshape(n, 4)
    out[:, 7:10] = sign[:, 1:] / size[:, None]
    lines = np.bincount(owner[flat == 10], minlength=n) + (lengths > 0)
    out[:, 10] = np.log1p(lines)
    out[:, 11] = lengths / np.maximum(lines, 1)

    solid = kind != 1
    edge = np.empty(len(flat), bool)
    edge[0] = True
    edge[1:] = owner[1:] != owner[:-1]
    before = np.concatenate(([False], solid[:-1])) & ~edge
    first = np.flatnonzero(solid & ~before)
    after = np.concatenate((solid[1:], [False]))
    after[:-1] &= ~edge[1:]
    last = np.flatnonzero(solid & ~after) + 1
    if len(first):
        of = owner[first]
        width = (last - first).astype(np.float64)
        words = np.bincount(of, minlength=n)
        count = np.maximum(words, 1)
        mean = _per_text(width, of, n) / count
        out[:, 12] = np.log1p(words)
        out[:, 13] = mean
        out[:, 14] = np.sqrt(np.maximum(_per_text(width**2, of, n) / count - mean**2, 0))
        out[:, 15] = np.bincount(of[width > 15], minlength=n) / count
        out[:, 16] = np.bincount(of[width <= 2], minlength=n) / count
        out[:, 17] = np.bincount(of[signs[flat[last - 1]] == 1], minlength=n) / count
        out[:, 18] = np.bincount(of[signs[flat[last - 1]] == 3], minlength=n) / count
        out[:, 19] = np.bincount(of[(kind[first] == 3) & (kind[np.minimum(first + 1, len(flat) - 1)] == 3)], minlength=n) / count
        word = SpanHash(flat)(first, last)
        out[:, 20] = _distinct(word, of, n) / count
        same = np.zeros(len(of), bool)
        same[1:] = (of[1:] == of[:-1]) & (word[1:] == word[:-1])
        out[:, 21] = np.bincount(of[same], minlength=n) / count
        pair = np.flatnonzero(of[1:] == of[:-1])
        if len(pair):
            joined = word[pair] * np.uint64(0x9E3779B97F4A7C15) ^ word[pair + 1]
            out[:, 22] = _distinct(joined, of[pair], n) / np.maximum(words - 1, 1)
    line_start = np.flatnonzero((flat == 10) & ~(np.append(edge[1:], True)))
    begin = np.sort(np.concatenate((starts[lengths > 0], line_start + 1)))
    stop = np.append(begin[1:], len(flat))
    out[:, 23] = _distinct(SpanHash(flat)(begin, stop), owner[np.minimum(begin, len(flat) - 1)], n) / np.maximum(lines, 1)
    return out


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(o), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=n)


@dataclass
class Forest:
    """Boosted trees as arrays: node k of a tree sends rows with feature <= cut to ``left[k]``, others to the next."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        total = np.full(len(rows), self.base)
        line = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(self.depth):
                node = self.left[node] + (rows[line, self.feature[node]] > self.cut[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64) -> Forest:
    """Logistic boosting with histograms of gradients; leaves point to themselves."""
    feature: list[int] = []
    cut: list[float] = []
    left: list[int] = []
    value: list[float] = []
    roots: list[int] = []
    if not len(labels):
        return Forest(np.zeros(1, int), np.full(1, np.inf), np.zeros(1, int), np.zeros(1), np.zeros(1, int), 0.0, 1)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(c, rows[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    total = np.full(len(labels), base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = labels - p, p * (1 - p)
        roots.append(len(feature))
        feature.append(0), cut.append(np.inf), left.append(roots[-1]), value.append(0.0)
        open_nodes = [(roots[-1], np.arange(len(labels)))]
        for level in range(depth + 1):
            following = []
            for node, members in open_nodes:
                g, w = gradient[members], weight[members]
                value[node] = rate * g.sum() / (w.sum() + 1.0)
                best = (1e-3, 0, 0)
                if level < depth and len(members) >= 20:
                    for j, c in enumerate(cuts):
                        if not len(c):
                            continue
                        b = binned[members, j]
                        gs = np.cumsum(np.bincount(b, g, len(c) + 1))[:-1]
                        ws = np.cumsum(np.bincount(b, w, len(c) + 1))[:-1]
                        gt, wt = g.sum(), w.sum()
                        gain = gs**2 / (ws + 1) + (gt - gs) ** 2 / (wt - ws + 1) - gt**2 / (wt + 1)
                        gain[(ws < 1e-2) | (wt - ws < 1e-2)] = 0
                        top = int(np.argmax(gain))
                        best = max(best, (float(gain[top]), j, top))
                if best[0] > 1e-3:
                    _, j, top = best
                    down = binned[members, j] <= top
                    child = len(feature)
                    feature[node], cut[node], left[node] = j, float(cuts[j][top]), child
                    for part in (members[down], members[~down]):
                        feature.append(0), cut.append(np.inf), left.append(len(feature) - 1), value.append(0.0)
                        following.append((len(feature) - 1, part))
                else:
                    total[members] += value[node]
            open_nodes = following
    return Forest(*map(np.array, (feature, cut, left, value, roots)), base, depth)


def held_out(doc_id: Column) -> Column:
    """Fold rule: the remainder of the id's CRC by five is zero."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, label: str = "quality") -> Forest:
    """Fit on at most about ``sample_rows`` labelled documents outside the held-out fold.

    Only the sample's statistics, ``FEATURES`` numbers a row, come to the driver.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    rank = F.xxhash64("doc_id")
    sample = known.withColumn("r", rank).orderBy("r", "doc_id").limit(sample_rows).select("doc_id", "y")
    chosen = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # bounded by sample_rows
    # One row of each id: a sampled id may be repeated in any number of rows.
    chosen = chosen.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "y")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES):
            rows = np.ascontiguousarray(statistics(block.column("text")))
            numbers = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), FEATURES).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("y"), numbers], ["doc_id", "y", "x"])

    learned = chosen.mapInArrow(work, "doc_id long, y int, x array<float>").toArrow()
    rows = np.array(learned["x"].combine_chunks().flatten(), np.float32).reshape(-1, FEATURES)
    y = learned["y"].to_numpy().astype(np.float64)
    order = np.lexsort((*rows.T, learned["doc_id"].to_numpy()))  # the same trees whatever order the rows came in
    return fit(rows[order], y[order])


def classify(documents: DataFrame, forest: Forest, threshold: float = 0.3, keep: bool = False) -> DataFrame:
    """Score per document in one pass; with ``keep`` all columns of the accepted documents instead."""
    if keep:
        schema = documents.schema
    else:
        documents = documents.select(F.col("doc_id").cast("bigint"), "text", held_out(F.col("doc_id")).alias("held_out"))
        schema = "doc_id long, held_out boolean, score double, predicted int"

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES):
            score = forest.score(statistics(block.column("text")))
            accepted = score >= threshold
            if keep:
                yield block.filter(pa.array(accepted))
            else:
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), block.column("held_out"), pa.array(score), pa.array(accepted.astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    return documents.mapInArrow(work, schema)
