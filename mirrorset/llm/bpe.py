"""Byte-pair encoding of whole texts with the vocabulary files of public tokenizers.

Texts are cut into words by array operations over code points. The distinct words that a
task has not met before are encoded together by a pair occurrence index: every pair of
neighbouring symbols is mapped to all its positions, the ranks that occur are applied in
ascending order, and each merge updates the lists of the pairs beside it. Documents are then
put together from their words' ids.

The tokenizer file is a parameter that executors read from their own installation.
Defined cases: a null or empty text has no ids and decodes to the empty string; strings of
added tokens inside a text become those tokens, as the library does by default. Hashes only
find candidates for equal words: each occurrence is compared with the word that it stands for.
A text without white space may be one word; its arrays take some 60 bytes a letter while it is encoded.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorset.llm.common import BLOCK_BYTES, SpanHash, blocks, ragged

# White space of the tokenizers' patterns, and the endings they split off.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

_SPACE, _LETTER, _NUMBER, _OTHER, _EDGE = range(5)
_NONE = np.iinfo(np.int64).max
_PENDING_WORDS = 4_000_000
_KNOWN_WORDS = 1_000_000


@functools.cache
def _classes() -> np.ndarray:
    """Class of every code point by its general category."""
    table = np.full(0x110000, _OTHER, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = _LETTER
        elif kind == "N":
            table[code] = _NUMBER
    table[WHITE_SPACE] = _SPACE
    return table


@functools.cache
def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


@dataclass
class Vocabulary:
    """A tokenizer file as arrays: first symbol of each byte, ranks of pairs, added tokens."""

    first: np.ndarray
    last: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    tokens: list[str]
    added: dict[str, int]
    word_ends: bool

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; ``_NONE`` where the pair is never merged."""
        keys = (left.astype(np.int64) << 21) | right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.ranks[at], _NONE)


@functools.cache
def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        parsed = json.load(file)
    model = parsed["model"]
    ids, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
    letters = byte_letters()
    merges = [(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    keys = np.array([(ids[a] << 21) | ids[b] for a, b in merges], np.int64)
    merged = np.array([ids[a + b] for a, b in merges], np.int64)
    order = np.argsort(keys, kind="stable")
    added = {t["content"]: t["id"] for t in parsed["added_tokens"]}
    tokens = [""] * (max([*ids.values(), *added.values()]) + 1)
    for token, number in [*ids.items(), *added.items()]:
        tokens[number] = token
    return Vocabulary(
        np.array([ids[c] for c in letters], np.int64),
        np.array([ids[c + suffix] for c in letters], np.int64),
        keys[order],
        order.astype(np.int64),
        merged,
        tokens,
        added,
        bool(suffix),
    )


def encode_words(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after another, and how many each word has."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    n = len(flat)
    ends = np.cumsum(lengths)
    symbols = vocabulary.first[flat]
    symbols[ends - 1] = vocabulary.last[flat[ends - 1]]
    after = np.arange(1, n + 2, dtype=np.int64)
    before = np.arange(-1, n, dtype=np.int64)
    inner = np.ones(n + 1, bool)  # is there a right neighbour in the same word?
    inner[ends - 1] = False
    inner[n] = False
    starts = np.zeros(n + 1, bool)
    starts[ends - lengths] = True
    rank = np.full(n + 1, _NONE, np.int64)
    left = np.flatnonzero(inner)
    rank[left] = vocabulary.rank(symbols[left], symbols[left + 1])
    alive = np.ones(n + 1, bool)
    alive[n] = False

    lists: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def index(positions: np.ndarray, ranks: np.ndarray) -> None:
        """Add positions to the lists of the pairs that stand there."""
        held = ranks != _NONE
        positions, ranks = positions[held], ranks[held]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks = ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for part, number in zip(np.split(positions[order], cuts), ranks[np.concatenate(([0], cuts))].tolist()):
            if number in lists:
                lists[number].append(part)
            else:
                lists[number] = [part]
                heapq.heappush(heap, number)

    index(left, rank[left])
    while heap:
        active = heapq.heappop(heap)
        parts = lists.pop(active)
        at = parts[0] if len(parts) == 1 else np.concatenate(parts)
        at = at[alive[at] & (rank[at] == active)]
        if not len(at):
            continue
        at.sort()
        at = at[np.concatenate(([True], at[1:] != at[:-1]))]
        chained = np.flatnonzero(after[at[:-1]] == at[1:])
        if len(chained):  # overlapping occurrences of a pair of equal symbols: take every other one from the left
            linked = np.zeros(len(at), bool)
            linked[chained + 1] = True
            run = np.arange(len(at)) - np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
            at = at[run % 2 == 0]
        gone = after[at]
        symbols[at] = vocabulary.merged[active]
        alive[gone] = False
        rank[gone] = _NONE
        inner[at] = inner[gone]
        behind = after[gone]
        after[at] = behind
        before[np.minimum(behind, n)] = at
        rank[at] = _NONE
        here = at[inner[at]]
        rank[here] = vocabulary.rank(symbols[here], symbols[after[here]])
        ahead = before[at[~starts[at]]]
        rank[ahead] = vocabulary.rank(symbols[ahead], symbols[after[ahead]])
        touched = np.concatenate((here, ahead)) if len(ahead) else here
        if len(touched):
            index(touched, rank[touched])
    kept = alive[:n]
    word = np.repeat(np.arange(len(words)), lengths)
    return symbols[kept].astype(np.uint32), np.bincount(word[kept], minlength=len(words)).astype(np.int64)


def _word_spans(codes: np.ndarray, edges: np.ndarray, word_ends: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; ``edges`` are positions between texts that belong to none."""
    kind = _classes()[codes]
    kind[edges] = _EDGE
    n = len(codes)
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    starts = change.copy()
    solid = (kind == _LETTER) | (kind == _NUMBER) | (kind == _OTHER)
    runs = np.flatnonzero(change)
    quotes = runs[(codes[runs] == 39) & (kind[runs] == _OTHER)]
    quotes = quotes[quotes + 2 < n]
    quotes = quotes[kind[quotes + 1] == _LETTER]
    if word_ends:
        starts |= kind == _NUMBER
    else:
        joined = np.flatnonzero(change[1:] & solid[1:] & (kind[:-1] == _SPACE)) + 1
        starts[joined - 1] = True
        blank = codes[joined - 1] == 32
        starts[joined[blank]] = False
        if len(quotes):
            quotes = quotes[starts[quotes]]
    for ending in ENDINGS if len(quotes) else ():
        found = quotes
        for i, letter in enumerate(ending, 1):
            found = found[found + i < n]
            found = found[codes[found + i] == ord(letter)]
        if len(found):
            starts[found + 1] = False
            stop = found + 1 + len(ending)
            starts[stop[kind[stop] == _LETTER]] = True
    first = np.flatnonzero(starts)
    last = np.append(first[1:], n)
    words = kind[first] != _EDGE
    if word_ends:
        words &= kind[first] != _SPACE
    return first[words], last[words]


def _unlike(codes: np.ndarray, first: np.ndarray, last: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Words whose letters are not those of the word number ``like`` beside it."""
    length = last - first
    differ = length != length[like]
    asked = np.flatnonzero(~differ & (like != np.arange(len(like))))
    here = codes[ragged(first[asked], length[asked])]
    wrong = np.flatnonzero(here != codes[ragged(first[like[asked]], length[asked])])
    if len(wrong):
        differ[asked[np.searchsorted(np.cumsum(length[asked]), wrong, side="right")]] = True
    return np.flatnonzero(differ)


def _lower(text: str) -> str:
    """Lower case of each character by itself: the final sigma has no rule of its own."""
    return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)


class Encoder:
    """Encodes texts in order, keeping the words already met; with ``strings`` also their decoded form."""

    def __init__(self, path: str, strings: bool = False):
        self.strings = strings
        self.vocabulary = read_vocabulary(path)
        self._reset()
        self.pieces = re.compile("(" + "|".join(re.escape(t) for t in self.vocabulary.added) + ")")

    def _reset(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.new: list[bytes] = []
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.shown: list[str] = []
        for number in self.vocabulary.added.values():
            self.ids = np.append(self.ids, np.uint32(number))
            self.starts = np.append(self.starts, len(self.starts))
            self.counts = np.append(self.counts, 1)
            self.shown.append(self.vocabulary.tokens[number])

    @property
    def known(self) -> int:
        return len(self.counts) + len(self.new)

    def _number(self, word: bytes) -> int:
        number = self.numbers.get(word)
        if number is None:
            number = self.numbers[word] = self.known
            self.new.append(word)
        return number

    def words_of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts one after another, and how many each text has."""
        pieces: list[str] = []
        owners: list[int] = []
        added: dict[int, int] = {}
        special = list(self.vocabulary.added)
        for owner, text in enumerate(texts):
            if not text:
                continue
            for i, piece in enumerate(self.pieces.split(text) if "<|" in text else (text,)):
                if i % 2:
                    added[len(pieces)] = special.index(piece)
                    piece = ""
                if self.vocabulary.word_ends and piece:
                    piece = _lower(unicodedata.normalize("NFC", piece))
                pieces.append(piece)
                owners.append(owner)
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        whole = "\0".join(pieces) + "\0"
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        edges = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1) - 1
        first, last = _word_spans(codes, edges, self.vocabulary.word_ends)
        code, distinct = pd.factorize(SpanHash(codes)(first, last))
        sample = np.empty(len(distinct), np.int64)
        sample[code[::-1]] = np.arange(len(code))[::-1]

        def number_of(i: int) -> int:
            return self._number(whole[first[i] : last[i]].encode("utf-8", "surrogatepass"))

        number = np.fromiter(map(number_of, sample.tolist()), np.int64, len(sample))[code]
        for i in _unlike(codes, first, last, sample[code]).tolist():
            number[i] = number_of(i)
        piece = np.searchsorted(edges, first)
        if added:
            at_piece = np.searchsorted(piece, np.fromiter(added, np.int64, len(added)))
            number = np.insert(number, at_piece, list(added.values()))
            piece = np.insert(piece, at_piece, list(added))
        return number, np.bincount(np.asarray(owners)[piece], minlength=len(texts)).astype(np.int64)

    def finish(self) -> None:
        """Encode the words met since the last call."""
        if not self.new:
            return
        ids, counts = encode_words(self.new, self.vocabulary)
        starts = np.cumsum(counts) - counts
        self.starts = np.concatenate((self.starts, starts + len(self.ids)))
        self.counts = np.concatenate((self.counts, counts))
        self.ids = np.concatenate((self.ids, ids))
        if self.strings:
            tokens = self.vocabulary.tokens
            listed = [tokens[i] for i in ids.tolist()]
            self.shown += [" ".join(listed[a:b]) for a, b in zip(starts.tolist(), (starts + counts).tolist())]
        self.new = []

    def encoded(
        self, batches: Iterable[pa.RecordBatch], column: str
    ) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[np.ndarray]]]:
        """Blocks of rows with each row's ids and word numbers."""
        held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []
        words = 0
        for block in blocks(batches, column, BLOCK_BYTES):
            held.append((block, *self.words_of(block.column(column).to_pylist())))
            words += len(held[-1][1])
            if words >= _PENDING_WORDS:
                yield from self._given(held)
                held, words = [], 0
        yield from self._given(held)

    def _given(self, held):
        self.finish()
        for block, numbers, per_text in held:
            counts = self.counts[numbers]
            ids = self.ids[ragged(self.starts[numbers], counts)]
            word_cuts = np.cumsum(per_text)
            upto = np.concatenate(([0], np.cumsum(counts)))[word_cuts]
            yield block, np.split(ids, upto[:-1]), np.split(numbers, word_cuts[:-1])
        if self.known > _KNOWN_WORDS:
            self._reset()


@functools.cache
def _held_encoder(path: str, strings: bool) -> Encoder:
    return Encoder(path, strings)


def task_encoder(path: str, strings: bool = False) -> Encoder:
    """The worker process's encoder: later tasks profit from the words met by earlier ones."""
    encoder = _held_encoder(path, strings)
    if encoder.new:  # left by a task that failed
        encoder._reset()
    return encoder


def encode_decode(documents: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row the number of ids, and digests of the ids and of the decoded text.

    Decoding joins the tokens' strings with blanks, as the library does for a file without
    a decoder. One pass without a shuffle; words are kept per task, in bounded number.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = task_encoder(path, strings=True)
        for block, ids, words in encoder.encoded(batches, "text"):
            shown = encoder.shown
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("id"),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(" ".join([shown[i] for i in w.tolist()]).encode()).hexdigest() for w in words]),
                ],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = documents.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(work, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed(
        "id", id_column
    )
