"""License scans: an inverted index of winnowed fingerprints picks candidates, banded alignment confirms them.

A template's words are hashed in overlapping groups; winnowing keeps the least hash of each window as
its fingerprints, and an index maps a fingerprint to its templates and places. Every group of words
of every text is looked up. Hits of one template near one diagonal are a candidate, and a local
alignment inside a band around that diagonal gives the matched words, their share of the template
and the span in the text; what lies before and behind a match in the band is aligned again, so that
copies close together are all found. A match covers its matched words' share of the template or of the words
it spans, whichever are more, so words put in count like words left out. A wording of fewer than ``WHOLE`` words, which
a near name would cover as well, must be matched whole. Where matches overlap, the one with more matched words stays.

Words are runs of letters, digits and non-ASCII bytes, in ASCII lower case. Defined cases: a null or
empty text matches nothing; repeated rows are reported each; a text may hold a template many
times; spans are byte offsets in UTF-8. Templates are a parameter, held by every task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorset.llm.common import SpanHash, blocks, mix64, text_bytes
from mirrorset.llm.license_texts import TEMPLATES

GROUP, WINDOW, BAND = 3, 4, 6
COVERAGE = 0.8
WHOLE = 20
SCHEMA = "doc_id long, license string, coverage double, matched_words int, span_start long, span_end long"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_WORD = np.zeros(256, bool)
_WORD[128:] = True
for _a, _b in ("az", "AZ", "09"):
    _WORD[ord(_a) : ord(_b) + 1] = True


def word_spans(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Start, end, hash and text number of each word."""
    solid = _WORD[flat]
    edge = np.zeros(len(flat) + 1, bool)
    edge[starts[lengths > 0]] = True
    edge[len(flat)] = True
    first = np.flatnonzero(solid & ~(np.concatenate(([False], solid[:-1])) & ~edge[:-1]))
    last = np.flatnonzero(solid & ~(np.concatenate((solid[1:], [False])) & ~edge[1:])) + 1
    filled = np.flatnonzero(lengths > 0)
    owner = filled[np.searchsorted(starts[filled], first, side="right") - 1]
    return first, last, SpanHash(_LOWER[flat])(first, last), owner


def group_hashes(words: np.ndarray) -> np.ndarray:
    n = len(words) - GROUP + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(GROUP):
        total = mix64(total * np.uint64(0x100000001B3) + words[i : i + n])
    return total


def winnow(hashes: np.ndarray, window: int = WINDOW) -> list[int]:
    """Places of the least hash (the last of equal ones) of each window of neighbours."""
    n = len(hashes)
    width = min(window, n)
    return sorted({max(range(i, i + width), key=lambda j: (-int(hashes[j]), j)) for i in range(n - width + 1)}) if n else []


@dataclass
class Index:
    """Templates' words, and their fingerprints in ascending order with template and place."""

    names: list[str]
    words: list[list[int]]
    fingerprints: np.ndarray
    template: np.ndarray
    place: np.ndarray
    sieve: np.ndarray


def build_index(templates: dict[str, str]) -> Index:
    names, words, entries = [], [], []
    for name, text in templates.items():
        flat = np.frombuffer(text.encode(), np.uint8)
        hashes = word_spans(flat, np.zeros(1, np.int64), np.array([len(flat)]))[2]
        groups = group_hashes(hashes)
        entries += [(int(groups[i]), len(names), i) for i in winnow(groups)]
        names.append(name)
        words.append(hashes.tolist())
    entries.sort()
    fingerprints = np.array([e[0] for e in entries], np.uint64)
    sieve = np.zeros(1 << 16, bool)
    sieve[(fingerprints & np.uint64(0xFFFF)).astype(np.int64)] = True
    return Index(names, words, fingerprints, np.array([e[1] for e in entries]), np.array([e[2] for e in entries]), sieve)


def align(text: list[int], template: list[int], diagonal: int, band: int = BAND) -> tuple[int, int, int]:
    """Best local alignment within the band: matched words, first word and last word (exclusive) in the text.

    A match counts 1, a differing or left-out word -1.
    """
    width = 2 * band + 1
    nothing = (0, 0, -1)
    row = [nothing] * (width + 1)
    best = (0, 0, 0, 0)
    for t, word in enumerate(template):
        new = [nothing] * (width + 1)
        for d in range(width):
            i = t + diagonal + d - band
            if not 0 <= i < len(text):
                continue
            score, matched, start = row[d]
            if text[i] == word:
                cell = (score + 1, matched + 1, start if score > 0 else i)
            else:
                cell = (score - 1, matched, start)
            skipped = row[d + 1]
            if skipped[0] - 1 > cell[0]:
                cell = (skipped[0] - 1, *skipped[1:])
            inserted = new[d - 1] if d else nothing
            if inserted[0] - 1 > cell[0]:
                cell = (inserted[0] - 1, *inserted[1:])
            if cell[0] <= 0:
                continue
            new[d] = cell
            if cell[0] > best[0]:
                best = (cell[0], cell[1], cell[2], i + 1)
        row = new
    return best[1:]


def _candidates(index: Index, owner: np.ndarray, words: np.ndarray):
    """Text number, template and diagonal of each candidate; diagonals count from the first word of all texts."""
    groups = group_hashes(words)
    same = owner[: len(groups)] == owner[GROUP - 1 :]
    at = np.flatnonzero(index.sieve[(groups & np.uint64(0xFFFF)).astype(np.int64)] & same)
    low = np.searchsorted(index.fingerprints, groups[at], side="left")
    high = np.searchsorted(index.fingerprints, groups[at], side="right")
    times = high - low
    entry = np.arange(times.sum()) + np.repeat(low - (np.cumsum(times) - times), times)
    at = np.repeat(at, times)
    found = np.stack((owner[at], index.template[entry], at - index.place[entry]), axis=1)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    head = (-1, -1, 0)
    for row in map(tuple, found.tolist()):
        if row[:2] != head[:2] or row[2] - head[2] > BAND // 2:
            head = row
            yield row


def occurrences(words: np.ndarray, template: list[int], diagonal: int, low: int, high: int, least: float):
    """Matched words, first and last word of each match inside the band: the best one, then those before and behind it."""
    rest = [(low, high)]
    while rest:
        a, b = rest.pop()
        if b - a < least:
            continue
        matched, first, last = align(words[a:b].tolist(), template, diagonal - a)
        if matched:
            if matched >= least:
                yield matched, a + first, a + last
            rest += [(a, a + first), (a + last, b)]


def matches_of(texts: pa.Array, index: Index | None = None, coverage: float = COVERAGE) -> list[list[tuple]]:
    """For each text its matches: number of the text, name, coverage, matched words, first and last byte of the span."""
    index = index or build_index(TEMPLATES)
    flat, starts, lengths = text_bytes(texts)
    if not len(flat) or not len(index.fingerprints):
        return [[] for _ in texts]
    first, last, words, owner = word_spans(flat, starts, lengths)
    begin = np.searchsorted(owner, np.arange(len(lengths) + 1))
    found: dict[int, list[tuple]] = {}
    for row, template, diagonal in _candidates(index, owner, words):
        wanted = index.words[template]
        low = max(int(begin[row]), diagonal - BAND)
        high = min(int(begin[row + 1]), diagonal + len(wanted) + BAND)
        for matched, a, b in occurrences(words, wanted, diagonal, low, high, coverage * len(wanted)):
            share = matched / max(len(wanted), b - a)
            if share >= (coverage if len(wanted) >= WHOLE else 1):
                found.setdefault(row, []).append((-matched, -share, a, b, index.names[template]))
    out: list[list[tuple]] = [[] for _ in texts]
    for row, rows in found.items():
        kept: list[tuple] = []
        for m in sorted(set(rows)):
            if all(m[3] <= k[2] or m[2] >= k[3] for k in kept):
                kept.append(m)
        out[row] = [(row, m[4], -m[1], -m[0], int(first[m[2]] - starts[row]), int(last[m[3] - 1] - starts[row])) for m in kept]
    return out


def scan(documents: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row per match that covers enough of a template. One pass, without a shuffle."""
    index = build_index(templates if templates is not None else TEMPLATES)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            rows = [m for rows in matches_of(block.column("text"), index, coverage) for m in rows]
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.string(), pa.float64(), pa.int32(), pa.int64(), pa.int64()]
            ids = block.column("doc_id").take(pa.array(columns[0], pa.int64()))
            named = ["doc_id", "license", "coverage", "matched_words", "span_start", "span_end"]
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, k) for c, k in zip(columns[1:], kinds)]], named)

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(work, SCHEMA)
