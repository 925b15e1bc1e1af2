"""Removal of byte strings of a given width that occur more than once in a corpus, exactly.

Each string of ``width`` bytes is assigned to an anchor inside of it: the last of its least
``gram``-byte hashes. Equal strings have equal anchors at the same place, so they can only meet under
the same anchor hash. A run of neighbouring strings with one anchor is a segment. Segments are
brought together by their anchor's hash:

* where two segments are equal, all their strings are repeated;
* where different segments share an anchor, their texts are gathered by it and a suffix array is
  built by two-stage sorting, whose adjacent common prefixes tell which strings are repeated;
* an anchor with more different segments than one task should sort is taken apart into its single
  strings, which are compared by digests.

Segments and strings are equal if their anchors' hashes and 64 bits of a cryptographic digest are. Texts are known by a
128-bit digest: rows of equal text are one text that repeats as a whole, and each gets the marks
of that text. So marks grow with the rows, however often one row is repeated.

Each task first combines its own equal segments, so that an anchor sends a bounded number of rows per
task; everything else is spread. Only segments whose anchor occurs elsewhere move as text, once a text.

Defined cases: a null text counts as empty; texts shorter than ``width`` stay as they are; the
strings of repeated rows are repeated, whatever their ids. Nothing is capped: the limits below choose the
way, not the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorset.llm.common import SpanHash, blocks, gram_hashes, mix64, ragged, signed, sliding, text_bytes
from mirrorset.llm.suffixes import common_prefixes, two_stage_order
from mirrorset.sources.staging import stage


@dataclass(frozen=True)
class Options:
    """Width of the strings and of the hashes, and how the work is cut up.

    A task combines the segments of ``flush`` bytes of text, sorts about ``sort`` bytes in one suffix
    array and looks at ``piece`` bytes of a long text at a time; about ``met`` segments meet at once. Of one anchor, one task sends up to
    ``sent`` different segments under the anchor's hash, and one task sorts up to ``sorted_``.
    """

    width: int = 200
    gram: int = 100
    flush: int = 24 << 20
    sort: int = 1 << 20
    piece: int = 2 << 20
    sent: int = 256
    sorted_: int = 2000
    met: int = 500_000


DEFAULT = Options()
_PLACE_BITS = 24
_DONE, _TEXT, _STRINGS = range(3)
_ROW = ["route", "kind", "key", "seg", "id", "tag", "start", "n", "many", "crowded"]
_ROW_SCHEMA = "route long, kind int, key long, seg long, id long, tag long, start int, n int, many boolean, crowded boolean"
_MARK_SCHEMA = "id long, tag long, start int, n int, kind int, key long"


def segments(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, gram: int):
    """Text number, first string, number of strings and anchor hash of each segment."""
    none = np.zeros(0, np.int64)
    if len(flat) < width:
        return none, none, none, np.zeros(0, np.uint64)
    h = gram_hashes(flat, gram)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    place = np.arange(len(h), dtype=np.uint64)
    least = sliding((h & ~mask) | (mask - place), width - gram + 1, np.minimum)
    anchor = (mask - (least & mask)).astype(np.int64)
    string = np.arange(len(anchor))
    long = np.flatnonzero(lengths >= width)
    if not len(long):
        return none, none, none, np.zeros(0, np.uint64)
    of = np.searchsorted(starts[long], string, side="right") - 1
    whole = (of >= 0) & (string + width <= (starts[long] + lengths[long])[of])
    new = whole.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~whole[:-1]
    first = np.flatnonzero(new)
    ends = np.flatnonzero(whole & ~np.append(whole[1:] & ~new[1:], False)) + 1
    return long[of[first]], first, ends - first, h[anchor[first]]


def _pieces(block: pa.RecordBatch, options: Options):
    """Text bytes and pieces of a block; a long text is cut into pieces that overlap by one byte less than a string."""
    flat, starts, lengths = text_bytes(block.column("text"))
    if len(flat) <= 2 * options.piece:
        yield flat, starts, lengths, np.arange(len(starts)), np.zeros(len(starts), np.int64)
        return
    for i, (start, length) in enumerate(zip(starts.tolist(), lengths.tolist())):
        for at in range(0, length, options.piece):
            piece = flat[start + at : start + min(length, at + options.piece + options.width - 1)]
            yield piece, np.zeros(1, np.int64), np.array([len(piece)]), np.array([i]), np.array([at])


def _heads(*columns: np.ndarray) -> np.ndarray:
    """First row of each group of equal neighbours."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _digests(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits of a cryptographic digest of each span."""
    raw = memoryview(np.ascontiguousarray(flat))
    parts = [hashlib.blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(starts.tolist(), ends.tolist())]
    return np.frombuffer(b"".join(parts), np.uint64)


def _batch(names: list[str], **columns) -> pa.RecordBatch:
    n = len(columns["id"])
    kinds = {"kind": pa.int32(), "start": pa.int32(), "n": pa.int32(), "many": pa.bool_(), "crowded": pa.bool_(), "text": pa.binary()}
    arrays = []
    for name in names:
        value = columns.get(name, 0)
        if name == "text":
            arrays.append(pa.nulls(n, pa.binary()) if name not in columns else pa.array(value, pa.binary()))
        else:
            arrays.append(pa.array(np.broadcast_to(np.asarray(value), n), kinds.get(name, pa.int64())))
    return pa.RecordBatch.from_arrays(arrays, names)


def _united(doc: np.ndarray, start: np.ndarray, n: np.ndarray):
    """Runs of strings of the same text that touch or overlap, put together."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], (start + n)[order]
    if not len(doc):
        return doc, start, end - start
    reach = np.maximum.accumulate(end + doc * (1 << 40)) - doc * (1 << 40)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], reach[last] - start[first]


def _anchored(documents: DataFrame, options: Options) -> DataFrame:
    """One row per different segment of a task, and the runs that the task itself found repeated."""
    width = options.width

    def flush(held: list[tuple], ids: list[int], tags: list[int]) -> Iterator[pa.RecordBatch]:
        doc, start, n, key, seg = (np.concatenate(c) for c in zip(*held))
        id_, tag = np.array(ids, np.int64), np.array(tags, np.int64)
        order = np.lexsort((seg, key))
        doc, start, n, key, seg = doc[order], start[order], n[order], key[order], seg[order]
        head = _heads(key, seg)
        group = np.cumsum(head) - 1
        many = np.bincount(group)[group] > 1
        run_doc, run_start, run_n = _united(doc[many], start[many], n[many])
        route = signed(mix64((id_[run_doc] ^ (tag[run_doc] << 20)).view(np.uint64)))
        yield _batch(_ROW, route=route, kind=_DONE, id=id_[run_doc], tag=tag[run_doc], start=run_start, n=run_n, many=True, crowded=False)
        doc, start, n, key, seg, many = doc[head], start[head], n[head], key[head], seg[head], many[head]
        key_head = _heads(key)
        of_key = np.cumsum(key_head) - 1
        rank = np.arange(len(key)) - np.flatnonzero(key_head)[of_key]
        crowded = np.bincount(of_key)[of_key] > options.sent
        sent = rank < options.sent
        spread = signed(mix64(seg ^ id_[doc].view(np.uint64)))
        yield _batch(
            _ROW,
            route=np.where(sent, signed(key), spread),
            kind=np.where(sent, _TEXT, _STRINGS),
            key=signed(key),
            seg=signed(seg),
            id=id_[doc],
            tag=tag[doc],
            start=start,
            n=n,
            many=many,
            crowded=crowded,
        )

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        ids: list[int] = []
        tags: list[int] = []
        size = 0
        for block in blocks(batches, "text", options.piece):
            base = len(ids)
            ids += block.column("id").to_pylist()
            tags += block.column("tag").to_pylist()
            for flat, starts, lengths, number, skipped in _pieces(block, options):
                doc, first, n, key = segments(flat, starts, lengths, width, options.gram)
                if len(doc):
                    seg = _digests(flat, first, first + n + width - 1)
                    held.append((base + number[doc], first - starts[doc] + skipped[doc], n, key, seg))
                size += len(flat)
            if size >= options.flush:
                if held:
                    yield from flush(held, ids, tags)
                held, ids, tags, size = [], [], [], 0
        if held:
            yield from flush(held, ids, tags)

    return _keyed(documents).mapInArrow(work, _ROW_SCHEMA)


def _keyed(documents: DataFrame, *more: Column) -> DataFrame:
    """``id, tag, text``: the two halves of a digest of the text, by which texts are known."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(text.cast("binary"))
    halves = [F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint").alias(name) for at, name in ((1, "id"), (17, "tag"))]
    return documents.select(*halves, text.alias("text"), *more)


def _table(held: list[pa.RecordBatch], names: list[str]) -> list[np.ndarray]:
    whole = pa.Table.from_batches(held)
    return [whole.column(n).to_numpy() for n in names]


def _meet(most: int, rows: int):
    """Compare the segments that share an anchor: which are repeated as a whole, which need their text.

    Rows come sorted by route, kind, key and digest. About ``rows`` are looked at together, whole routes if they fit. An anchor
    with more rows is looked at in parts and taken apart into strings, like one with many different segments.
    """
    names = ["id", "tag", "start", "n", "kind", "key"]

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], bool]]:
        held: list[pa.RecordBatch] = []
        size, cut = 0, False  # does the first route in hand belong to a part given before?
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < rows:
                continue
            route = batch.column("route").to_numpy()
            inner = np.flatnonzero(route[1:] != route[:-1]) + 1
            if len(inner):
                last = int(inner[-1])
                yield [*held[:-1], batch.slice(0, last)], cut
                held, size, cut = [batch.slice(last)], batch.num_rows - last, False
            elif size >= 2 * rows:  # the last row is looked at again, so that no two equal segments miss each other
                yield held, True
                held, size, cut = [batch.slice(batch.num_rows - 1)], 1, True
        if held:
            yield held, cut

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, forced in parts(batches):
            yield from compare(_table(held, _ROW), forced)

    def compare(columns: list[np.ndarray], forced: bool) -> Iterator[pa.RecordBatch]:
        _, kind, key, seg, id_, tag, start, n, many, crowded = columns
        apart = kind != _TEXT
        yield _batch(names, id=id_[apart], tag=tag[apart], start=start[apart], n=n[apart], kind=kind[apart], key=key[apart])
        order = np.flatnonzero(~apart)
        order = order[np.lexsort((seg[order], key[order]))]
        key, seg, id_, tag, start, n, many, crowded = (c[order] for c in (key, seg, id_, tag, start, n, many, crowded))
        if not len(key):
            return
        head, key_head = _heads(key, seg), _heads(key)
        group, of_key = np.cumsum(head) - 1, np.cumsum(key_head) - 1
        repeated = (np.bincount(group) > 1) | (np.bincount(group, many) > 0)
        done = repeated[group] & ~many
        different = np.bincount(of_key, head)
        hot = (np.bincount(of_key, crowded) > 0) | (different > most) | forced
        yield _batch(names, id=id_[done], tag=tag[done], start=start[done], n=n[done], kind=_DONE, key=0)
        ask = head & ((different > 1) | hot)[of_key]
        how = np.where(hot[of_key[ask]], _STRINGS, _TEXT)
        yield _batch(names, id=id_[ask], tag=tag[ask], start=start[ask], n=n[ask], kind=how, key=key[ask])

    return work


def _grouped(marks: DataFrame) -> DataFrame:
    """The different marks of each text; copies of a text have the same ones."""
    fields = [c for c in marks.columns if c not in ("id", "tag")]
    return marks.groupBy("id", "tag").agg(F.collect_set(F.struct(*fields)).alias("marks"))


def _marks_of(block: pa.RecordBatch) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row number and fields of all marks of a block."""
    column = block.column("marks")
    counts = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    items = column.flatten()
    fields = {items.type.field(i).name: items.field(i).to_numpy(zero_copy_only=False) for i in range(items.type.num_fields)}
    return np.repeat(np.arange(block.num_rows), counts), fields


_SEND = ["route", "kind", "second", "id", "tag", "start", "n", "many", "text"]
_SEND_SCHEMA = "route long, kind int, second long, id long, tag long, start int, n int, many boolean, text binary"


def _send(width: int):
    """Texts of segments under their anchor's hash, and single strings of hot anchors under their digest."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            flat, starts, _ = text_bytes(block.column("text"))
            row, mark = _marks_of(block)
            id_, tag = block.column("id").to_numpy(), block.column("tag").to_numpy()
            at = starts[row] + mark["start"]
            size = mark["n"] + width - 1
            text = np.flatnonzero(mark["kind"] == _TEXT)
            raw = memoryview(np.ascontiguousarray(flat))
            parts = [bytes(raw[a : a + s]) for a, s in zip(at[text].tolist(), size[text].tolist())]
            yield _batch(
                _SEND, route=mark["key"][text], kind=_TEXT, id=id_[row[text]], tag=tag[row[text]],
                start=mark["start"][text], n=mark["n"][text], many=False, text=parts,
            )
            hot = np.flatnonzero(mark["kind"] == _STRINGS)
            if not len(hot):
                continue
            counts = mark["n"][hot].astype(np.int64)
            place = ragged(at[hot].astype(np.int64), counts)
            owner = np.repeat(row[hot], counts)
            one = SpanHash(flat)(place, place + width)
            two = _digests(flat, place, place + width)
            order = np.lexsort((two, one))
            place, owner, one, two = place[order], owner[order], one[order], two[order]
            head = _heads(one, two)
            many = np.bincount(np.cumsum(head) - 1)[np.cumsum(head) - 1] > 1
            start = place - starts[owner]
            run_row, run_start, run_n = _united(owner[many], start[many], np.ones(many.sum(), np.int64))
            yield _batch(_SEND, route=signed(mix64(id_[run_row].view(np.uint64))), kind=_DONE, id=id_[run_row], tag=tag[run_row],
                         start=run_start, n=run_n, many=False)
            yield _batch(_SEND, route=signed(one[head]), kind=_STRINGS, second=signed(two[head]), id=id_[owner[head]], tag=tag[owner[head]],
                         start=start[head], n=1, many=many[head])

    return work


_RUN = ["id", "tag", "start", "n"]


def _sort_segments(route: np.ndarray, texts: pa.Array, n: np.ndarray, width: int):
    """Segment number, first string and number of strings of the repeated runs among segments."""
    flat, starts, _ = text_bytes(texts)
    order = two_stage_order(flat, starts, n, width)
    same = common_prefixes(flat, order, width) >= width
    repeated = np.zeros(len(flat) + 1, bool)
    repeated[order[:-1][same]] = True
    repeated[order[1:][same]] = True
    at = np.flatnonzero(repeated)
    of = np.searchsorted(starts, at, side="right") - 1
    return _united(of, at - starts[of], np.ones(len(at), np.int64))


def _resolve(width: int, most: int):
    """Repeated runs among what came together under one route; rows come sorted by kind and route."""

    def sort(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.Table.from_batches(held).combine_chunks()
        route, n = block.column("route").to_numpy(), block.column("n").to_numpy().astype(np.int64)
        of, start, runs = _sort_segments(route, block.column("text").combine_chunks(), n, width)
        id_, tag, base = (block.column(c).to_numpy() for c in ("id", "tag", "start"))
        yield _batch(_RUN, id=id_[of], tag=tag[of], start=base[of] + start, n=runs)

    def count(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, id_, tag, start, many = _table(held, ["route", "second", "id", "tag", "start", "many"])
        order = np.lexsort((two, one))
        one, two, id_, tag, start, many = (c[order] for c in (one, two, id_, tag, start, many))
        group = np.cumsum(_heads(one, two)) - 1
        repeated = ((np.bincount(group) > 1) | (np.bincount(group, many) > 0))[group] & ~many
        yield _batch(_RUN, id=id_[repeated], tag=tag[repeated], start=start[repeated], n=1)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, current, last = 0, None, None
        for batch in batches:
            kinds, routes = batch.column("kind").to_numpy(), batch.column("route").to_numpy()
            weight = np.where(kinds == _TEXT, batch.column("n").to_numpy() + width, 40)
            cuts = np.flatnonzero((kinds[1:] != kinds[:-1]) | (routes[1:] != routes[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                kind, route = int(kinds[a]), int(routes[a])
                if held and (kind != current or (size >= most and route != last)):
                    yield from finish(current, held)
                    held, size = [], 0
                held.append(batch.slice(a, b - a))
                size += int(weight[a:b].sum())
                current, last = kind, route
        if held:
            yield from finish(current, held)

    def finish(kind: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if kind == _DONE:
            for batch in held:
                yield batch.select(_RUN)
        else:
            yield from (sort if kind == _TEXT else count)(held)

    return work


def repeated_runs(documents: DataFrame, options: Options = DEFAULT) -> DataFrame:
    """``id, tag, start, n``: strings ``start .. start + n - 1`` of a text occur elsewhere too. Runs may overlap."""
    rows = _anchored(documents, options).repartition("route").sortWithinPartitions("route", "kind", "key", "seg")
    marks = stage(rows.mapInArrow(_meet(options.sorted_, options.met), _MARK_SCHEMA), "anchors")
    asked = _grouped(marks.where(F.col("kind") != _DONE))
    once = _keyed(documents).groupBy("id", "tag").agg(F.first("text").alias("text"))  # copies meet in the tasks that read them
    sent = once.join(asked, ["id", "tag"]).mapInArrow(_send(options.width), _SEND_SCHEMA)
    together = sent.repartition("route").sortWithinPartitions("kind", "route")
    found = together.mapInArrow(_resolve(options.width, options.sort), "id long, tag long, start int, n int")
    size = F.octet_length("text")
    copied = _keyed(documents).groupBy("id", "tag").agg(F.count(F.lit(1)).alias("rows"), F.max(size).alias("size"))
    whole = copied.where((F.col("rows") > 1) & (F.col("size") >= options.width)).select(
        "id", "tag", F.lit(0).alias("start"), (F.col("size") - options.width + 1).cast("int").alias("n")
    )
    return marks.where(F.col("kind") == _DONE).select(*_RUN).union(found).union(whole)


def _with_runs(documents: DataFrame, options: Options, more: list) -> DataFrame:
    runs = _grouped(repeated_runs(documents, options))
    return _keyed(documents, *more).join(runs, ["id", "tag"], "left")


def _cut(text: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    kept, at = [], 0
    for a, b in zip(starts.tolist(), ends.tolist()):
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return b"".join(kept)


def _cuts(block: pa.RecordBatch, width: int):
    """Number of removed bytes and of spans, and what is left, for each row."""
    row, mark = _marks_of(block)
    if len(row):
        row, start, n = _united(row, mark["start"].astype(np.int64), mark["n"].astype(np.int64) + width - 1)
    else:
        start = n = np.zeros(0, np.int64)
    texts = block.column("text").cast(pa.binary()).to_pylist()
    at = np.searchsorted(row, np.arange(len(texts) + 1))
    left = [_cut(t, start[a:b], start[a:b] + n[a:b]) if b > a else t for t, a, b in zip(texts, at[:-1].tolist(), at[1:].tolist())]
    removed = np.bincount(row, n, len(texts)).astype(np.int64)
    return texts, removed, np.bincount(row, minlength=len(texts)).astype(np.int64), left


def removal_report(documents: DataFrame, options: Options = DEFAULT) -> DataFrame:
    """Per row: bytes, removed bytes, removed spans, and the digest of what is left."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            texts, removed, spans, left = _cuts(block, options.width)
            columns = [
                block.column("doc_id"),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(removed),
                pa.array(spans),
                pa.array([hashlib.sha256(x).hexdigest() for x in left]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = _with_runs(documents, options, [F.col("doc_id").cast("bigint").alias("doc_id")])
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.select("doc_id", "text", "marks").mapInArrow(work, schema)


def remove_repeats(documents: DataFrame, options: Options = DEFAULT) -> DataFrame:
    """The documents without their repeated strings; all columns stay, ``n_chars`` follows the text.

    A character of which a part is removed is removed whole. A null text stays null.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            _, _, _, left = _cuts(block, options.width)
            yield pa.RecordBatch.from_arrays(
                [block.column("row"), pa.array([x.decode("utf-8", "ignore") for x in left], pa.string())], ["row", "text"]
            )

    row = F.struct(*[F.col(c) for c in documents.columns if c != "text"], F.col("text").isNull().alias("without")).alias("row")
    joined = _with_runs(documents, options, [row]).select("row", "text", "marks")
    cut = joined.mapInArrow(work, joined.select("row", "text").schema)
    text = F.when(~F.col("row.without"), F.col("text"))
    named = {"text": text, "n_chars": F.when(text.isNotNull(), F.length("text").cast("bigint"))}
    return cut.select(*[(named[c] if c in named else F.col("row")[c]).alias(c) for c in documents.columns])
