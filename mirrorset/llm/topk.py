"""Exact top-k inner products by a three-phase uniform threshold.

A node is one slice of the dimensions of one block of rows. Phase one: every node gives each query's
best ``k`` local scores; the totals of the rows named there give a cutoff that the k-th best total
cannot be below. Phase two: a row whose total reaches the cutoff has a local score of at least the
cutoff divided by the number of slices in some slice, so every node gives exactly those rows, and
rows whose known scores and bounds stay below the cutoff go. Phase three: the missing local scores
of the rest are resolved, and each block passes on its best ``k`` of them.

Queries are packed into groups of bounded size and meet the blocks of rows by a join on the group's
number, so neither side is held whole anywhere; the cutoffs travel with the packed queries.

Defined cases: vectors that are null or empty, or hold null or non-finite components, and rows with
a null id take no part; only vectors of the query's length are compared; a repeated query id counts
once, with the greatest of its valid vectors; rows with the query's own id are no candidates; a repeated
candidate row can take several places. Components are floored in double arithmetic; their products
must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 4096
QUERIES_PER_GROUP = 512
_EXACT = float(1 << 53)
_LOW = np.iinfo(np.int64).min
_BLOCK = "dim int, n int, ids binary, values binary"


def _integers(column: pa.Array, scale: float) -> list[np.ndarray | None]:
    out: list[np.ndarray | None] = []
    for vector in column:
        v = vector.values
        if v is None or not len(v) or v.null_count:
            out.append(None)
            continue
        floored = np.floor(scale * np.asarray(v.to_numpy(zero_copy_only=False), np.float64))
        out.append(floored.astype(np.int64) if np.isfinite(floored).all() else None)
    return out


def _fast_integers(column: pa.Array, scale: float) -> list[np.ndarray | None]:
    """As ``_integers``, at once where all vectors are whole and equally long."""
    if len(column) and not column.null_count:
        values = column.flatten()
        if len(values) and not values.null_count and len(values) % len(column) == 0:
            offsets = column.offsets.to_numpy()
            width = len(values) // len(column)
            if (np.diff(offsets) == width).all():
                floored = np.floor(scale * values.to_numpy().astype(np.float64)).reshape(-1, width)
                good = np.isfinite(floored).all(axis=1)
                whole = np.where(good[:, None], floored, 0).astype(np.int64)
                return [row if ok else None for row, ok in zip(whole, good)]
    return _integers(column, scale)


def _valid(vector: Column, scale: float) -> Column:
    """Whether ``_integers`` takes the vector: not empty, and all components finite."""
    finite = lambda x: F.coalesce(F.abs(x.cast("double") * scale) < float("inf"), F.lit(False))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def _vectors(df: DataFrame, id_column: str, vector_column: str, scale: float) -> DataFrame:
    """Packed blocks of the valid rows of each task, by length of vector."""
    rows = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).alias("v")).where("id IS NOT NULL")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, np.ndarray]]] = {}
        for batch in batches:
            for number, vector in zip(batch.column("id").to_pylist(), _fast_integers(batch.column("v"), scale)):
                if vector is None:
                    continue
                group = held.setdefault(len(vector), [])
                group.append((number, vector))
                if len(group) >= ROWS_PER_BLOCK:
                    yield _packed(held.pop(len(vector)))
        for group in held.values():
            yield _packed(group)

    return rows.mapInArrow(work, _BLOCK)


def _packed(group: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    matrix = np.stack([v for _, v in group])
    if np.abs(matrix).max() < 1 << 31:
        matrix = matrix.astype(np.int32)
    ids = np.array([i for i, _ in group], np.int64)
    columns = [
        pa.array([matrix.shape[1]], pa.int32()),
        pa.array([len(group)], pa.int32()),
        pa.array([ids.tobytes()]),
        pa.array([matrix.tobytes()]),
    ]
    return pa.RecordBatch.from_arrays(columns, ["dim", "n", "ids", "values"])


def _matrix(n: int, dim: int, raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64 if len(raw) == 8 * n * dim else np.int32).reshape(n, dim)


def _slice_scores(queries: np.ndarray, rows: np.ndarray, slices: int) -> list[np.ndarray]:
    """Integer inner products per slice of the dimensions."""
    cuts = np.array_split(np.arange(queries.shape[1]), min(slices, queries.shape[1]))
    largest = float(np.abs(queries).max()) * float(np.abs(rows).max()) * queries.shape[1]
    kind = np.float64 if largest < _EXACT else np.int64
    q, r = queries.astype(kind), rows.astype(kind)
    return [(q[:, c[0] : c[-1] + 1] @ r[:, c[0] : c[-1] + 1].T).astype(np.int64) for c in cuts]


def _named(scores: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best of each line, rows with the query's own id behind all others."""
    start = max(0, scores.shape[1] - k)
    return np.argpartition(np.where(own, _LOW, scores), start, axis=1)[:, start:]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best of one list: higher score first, then the smaller id."""
    if len(scores) > k:
        bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        held = np.flatnonzero(scores >= bound)
        return held[np.lexsort((ids[held], -scores[held]))[:k]]
    return np.lexsort((ids, -scores))


def top_k(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: float = 256.0,
    slices: int = 4,
) -> DataFrame:
    """``query_id, rank, <id_column>, score`` of the ``k`` best rows for each query."""
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = (
        queries.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).alias("v"))
        .where(F.col("id").isNotNull() & _valid(F.col("v"), scale))  # else an invalid vector could be the greatest
        .groupBy("id")
        .agg(F.max("v").alias("v"))
    )
    groups = max(1, -(-asked.count() // QUERIES_PER_GROUP))
    salts = max(1, -(-2 * tasks // groups))
    blocks = (
        _vectors(rows, id_column, vector_column, scale)
        .withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(salts)).cast("int"))
        .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    )

    def packed_queries(source: DataFrame) -> DataFrame:
        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Rows come sorted by group, and one group is packed when the next begins."""
            held: dict[int, list[tuple[int, np.ndarray, int]]] = {}
            current = None
            for batch in batches:
                named = (batch.column(n).to_pylist() for n in ("group", "id", "cutoff"))
                for group, number, cutoff, vector in zip(*named, _fast_integers(batch.column("v"), scale)):
                    if group != current:
                        yield from given(current, held)
                        current, held = group, {}
                    if vector is not None:
                        held.setdefault(len(vector), []).append((number, vector, cutoff))
            yield from given(current, held)

        def given(group, held):
            for members in held.values():
                block = _packed([(i, v) for i, v, _ in members])
                columns = [pa.array([group], pa.int32()), *block.columns, pa.array([np.array([c for *_, c in members], np.int64).tobytes()])]
                yield pa.RecordBatch.from_arrays(columns, ["group", "qdim", "qn", "qids", "qvalues", "cutoffs"])

        grouped = source.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
        ordered = grouped.repartition("group").sortWithinPartitions("group")
        schema = "group int, qdim int, qn int, qids binary, qvalues binary, cutoffs binary"
        packed = ordered.select("group", "id", "cutoff", "v").mapInArrow(work, schema)
        return packed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def tiles(source: DataFrame) -> DataFrame:
        return blocks.join(packed_queries(source), ["group", "salt"]).where("dim = qdim").select(
            "dim", "n", "ids", "values", "qn", "qids", "qvalues", "cutoffs"
        )

    def each_tile(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for dim, n, ids, values, qn, qids, qvalues, cutoffs in zip(*[c.to_pylist() for c in batch.columns]):
                number, asked_ids = np.frombuffer(ids, np.int64), np.frombuffer(qids, np.int64)
                parts = _slice_scores(_matrix(qn, dim, qvalues), _matrix(n, dim, values), slices)
                yield number, asked_ids, parts, np.frombuffer(cutoffs, np.int64)

    def local_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phase one: totals of the rows that some slice names among its best."""
        for number, asked_ids, parts, _ in each_tile(batches):
            own = number[None, :] == asked_ids[:, None]
            named = np.concatenate([_named(p, own, k) for p in parts], axis=1)
            named.sort(axis=1)
            line = np.arange(len(asked_ids))[:, None]
            totals = sum(p[line, named] for p in parts)
            blank = own[line, named]
            blank[:, 1:] |= named[:, 1:] == named[:, :-1]
            totals[blank] = _LOW
            totals = np.sort(totals, axis=1)[:, ::-1][:, :k]
            seen = totals != _LOW
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(asked_ids, seen.sum(axis=1))), pa.array(totals[seen])], ["id", "total"]
            )

    def sufficient(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phases two and three."""
        for number, asked_ids, parts, cutoffs in each_tile(batches):
            found: list[np.ndarray] = [[], [], []]
            m = len(parts)
            least = np.where(cutoffs == _LOW, _LOW, -(-cutoffs // m))  # a local score is an integer
            for i, query in enumerate(asked_ids):
                local = [p[i] for p in parts]
                given = [x >= least[i] for x in local]
                held = np.flatnonzero(np.logical_or.reduce(given))
                if cutoffs[i] != _LOW:
                    bound = sum(np.where(g[held], x[held], least[i] - 1) for g, x in zip(given, local))
                    held = held[bound >= cutoffs[i]]
                total = sum(x[held] for x in local)
                keep = (total >= cutoffs[i]) & (number[held] != query)
                held, total = held[keep], total[keep]
                best = _best(total, number[held], k)
                for column, value in zip(found, (np.full(len(best), query), number[held[best]], total[best])):
                    column.append(value)
            columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in found]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "id", "score"])

    start = asked.withColumn("cutoff", F.lit(_LOW).cast("bigint"))
    lists = tiles(start).mapInArrow(local_lists, "id long, total long")
    by_total = Window.partitionBy("id").orderBy(F.desc("total"))
    kth = lists.withColumn("r", F.row_number().over(by_total)).where(F.col("r") <= k)
    cutoffs = kth.groupBy("id").agg(F.min("total").alias("t"), F.count(F.lit(1)).alias("c"))
    cutoffs = cutoffs.select("id", F.when(F.col("c") >= k, F.col("t")).otherwise(F.lit(_LOW)).alias("cutoff"))
    # A query that no block names another row for keeps the low cutoff.
    known = asked.join(cutoffs, "id", "left").withColumn("cutoff", F.coalesce("cutoff", F.lit(_LOW).cast("bigint")))
    entries = tiles(known).mapInArrow(sufficient, "query_id long, id long, score long")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    ranked = entries.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_column), "score")
