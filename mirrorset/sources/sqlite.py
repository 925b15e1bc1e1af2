"""SQLite files as a Spark source and sink, without a server or a driver jar.

A path is one file, or a folder of files written by Spark, each with its share of the table's rows. Files are read
by ranges of their rowids, several tasks a file. Comparisons of columns with constants reach SQLite; only
the columns of a given schema are read. Paths must be visible to the driver and all executors.

    spark.dataSource.register(SqliteDataSource)
    spark.read.format("sqlite").option("dbtable", "IDENTANV").load("/shared/herds.db")

Types follow the declared ones: integers, reals, text, blobs and booleans; other declarations, dates among them, are text. A stored
value that its column's type cannot hold fails the read, with its column.
"""

from __future__ import annotations

import json
import os
import sqlite3
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

BATCH_ROWS = 10_000
RANGE_ROWS = 250_000
LIST = "_files.json"
_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _local(path: str) -> str:
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def _open(file: str) -> sqlite3.Connection:
    """The file, for reading only."""
    uri = "file:" + file.replace("%", "%25").replace("?", "%3f").replace("#", "%23") + "?mode=ro"
    return sqlite3.connect(uri, uri=True)


def _files(path: str) -> list[str]:
    path = _local(path)
    if not os.path.isdir(path):
        return [path]
    with open(os.path.join(path, LIST), encoding="utf-8") as listed:
        return [os.path.join(path, name) for name in json.load(listed)]


def declared_type(name: str) -> DataType:
    """Spark type of a declared SQLite type, by SQLite's own rules of affinity where they tell."""
    name = (name or "").upper()
    if "BOOL" in name:
        return BooleanType()
    if "INT" in name:
        return LongType()
    if any(word in name for word in ("CHAR", "CLOB", "TEXT", "DATE", "TIME")):
        return StringType()
    if any(word in name for word in ("REAL", "FLOA", "DOUB", "NUM", "DEC")):
        return DoubleType()
    return BinaryType() if "BLOB" in name else StringType()


def _sql_type(kind: DataType) -> str:
    if isinstance(kind, BooleanType):
        return "BOOLEAN"
    if isinstance(kind, _WHOLE):
        return "INTEGER"
    if isinstance(kind, (DoubleType, FloatType)):
        return "REAL"
    return "BLOB" if isinstance(kind, BinaryType) else "TEXT"


@dataclass
class _Range(InputPartition):
    """Rows of a file with rowids in ``[low, high)``; all rows where the table has no rowids."""

    file: str
    low: int | None = None
    high: int | None = None


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, table: str, schema: StructType, rows: int):
        self.path, self.table, self.schema, self.rows = path, table, schema, rows
        self.conditions: list[tuple[str, list]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons narrow what SQLite returns. Spark checks all filters again, so text is compared as it compares text."""
        for given in filters:
            condition = self._condition(given)
            if condition:
                self.conditions.append(condition)
            yield given

    def _condition(self, given: Filter) -> tuple[str, list] | None:
        path = getattr(given, "attribute", ())
        if len(path) != 1 or path[0] not in self.schema.names:
            return None
        name = path[0]
        text = isinstance(self.schema[name].dataType, StringType)
        column = _quoted(name) + (" COLLATE BINARY" if text else "")
        if isinstance(given, IsNull):
            return f"{column} IS NULL", []
        if isinstance(given, IsNotNull):
            return f"{column} IS NOT NULL", []
        if isinstance(given, StringStartsWith) and text:
            return f"substr({column}, 1, {len(given.value)}) = ?", [given.value]
        values = list(given.value) if isinstance(given, In) else [getattr(given, "value", None)]
        if not values or not all(isinstance(v, str if text else (int, float)) for v in values):
            return None
        if isinstance(given, In):
            return f"{column} IN ({', '.join('?' * len(values))})", values
        sign = _COMPARED.get(type(given))
        return (f"{column} {sign} ?", values) if sign else None

    def partitions(self) -> Sequence[InputPartition]:
        """Ranges of equal width over each file's rowids."""
        out: list[_Range] = []
        for file in _files(self.path):
            connection = _open(file)
            try:
                kind = connection.execute("SELECT type FROM sqlite_master WHERE name = ?", [self.table]).fetchone()
                if kind == ("view",):
                    out.append(_Range(file))
                    continue
                low, high = connection.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.table)}").fetchone()
            except sqlite3.OperationalError:  # a table without rowids
                out.append(_Range(file))
                continue
            finally:
                connection.close()
            if low is None:
                continue
            out += [_Range(file, at, min(high + 1, at + self.rows)) for at in range(low, high + 1, self.rows)]
        return out or [_Range(_files(self.path)[0], 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        names = self.schema.names
        where, values = [c for c, _ in self.conditions], [v for _, vs in self.conditions for v in vs]
        if partition.low is not None:
            where, values = ["rowid >= ? AND rowid < ?", *where], [partition.low, partition.high, *values]
        columns = ", ".join(map(_quoted, names)) or "1"
        sql = f"SELECT {columns} FROM {_quoted(self.table)}" + (" WHERE " + " AND ".join(where) if where else "")
        arrow = to_arrow_schema(self.schema)
        connection = _open(partition.file)
        try:
            cursor = connection.execute(sql, values)
            while rows := cursor.fetchmany(BATCH_ROWS):
                arrays = [self._column(field, [r[i] for r in rows]) for i, field in enumerate(arrow)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        finally:
            connection.close()

    @staticmethod
    def _column(field: pa.Field, values: list) -> pa.Array:
        try:
            if pa.types.is_boolean(field.type):
                values = [None if v is None else bool(int(v)) for v in values]
            elif pa.types.is_string(field.type):
                values = [v if v is None or isinstance(v, str) else str(v) for v in values]
            elif pa.types.is_floating(field.type):
                values = [None if v is None else float(v) for v in values]
            elif pa.types.is_binary(field.type):
                values = [v.encode() if isinstance(v, str) else v for v in values]
            return pa.array(values, field.type)
        except (pa.ArrowException, TypeError, ValueError) as error:
            raise ValueError(f"column {field.name} holds a value that is not {field.type}: {error}") from error


@dataclass
class _Written(WriterCommitMessage):
    file: str


class SqliteWriter(DataSourceWriter):
    """Each task writes a file of its own; the list of the files that count is written last."""

    def __init__(self, path: str, table: str, schema: StructType, overwrite: bool):
        self.path, self.table, self.schema, self.overwrite = _local(path), table, schema, overwrite

    def write(self, rows: Iterator) -> _Written:
        os.makedirs(self.path, exist_ok=True)
        name = f"part-{uuid.uuid4().hex}.sqlite"
        connection = sqlite3.connect(os.path.join(self.path, name))
        try:
            columns = ", ".join(f"{_quoted(f.name)} {_sql_type(f.dataType)}" for f in self.schema)
            connection.execute(f"CREATE TABLE {_quoted(self.table)} ({columns})")
            marks = ", ".join("?" * len(self.schema))
            stored = (tuple(self._stored(v) for v in row) for row in rows)
            connection.executemany(f"INSERT INTO {_quoted(self.table)} VALUES ({marks})", stored)
            connection.commit()
        finally:
            connection.close()
        return _Written(name)

    @staticmethod
    def _stored(value):
        """Dates, times and decimals are stored as their text."""
        return value if value is None or isinstance(value, (int, float, str, bytes)) else str(value)

    def commit(self, messages: list[_Written | None]) -> None:
        os.makedirs(self.path, exist_ok=True)
        listed = os.path.join(self.path, LIST)
        before = []
        if not self.overwrite and os.path.exists(listed):
            with open(listed, encoding="utf-8") as file:
                before = json.load(file)
        fresh = f"{listed}.{uuid.uuid4().hex}"
        with open(fresh, "w", encoding="utf-8") as file:
            json.dump([*before, *(m.file for m in messages if m)], file)
        os.replace(fresh, listed)

    def abort(self, messages: list[_Written | None]) -> None:
        """Files that are not listed are not read."""


class SqliteDataSource(DataSource):
    """Options: ``path``, ``dbtable`` and ``rows``, the width of a task's range of rowids."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    @property
    def _table(self) -> str:
        return self.options["dbtable"]

    def schema(self) -> StructType:
        files = _files(self.options["path"])
        if not files:
            raise ValueError(f"no files are listed in {self.options['path']}")
        connection = _open(files[0])
        try:
            columns = connection.execute(f"PRAGMA table_info({_quoted(self._table)})").fetchall()
        finally:
            connection.close()
        if not columns:
            raise ValueError(f"no table {self._table} in {self.options['path']}")
        return StructType([StructField(c[1], declared_type(c[2])) for c in columns])

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(self.options["path"], self._table, schema, int(self.options.get("rows", RANGE_ROWS)))

    def writer(self, schema: StructType, overwrite: bool) -> SqliteWriter:
        return SqliteWriter(self.options["path"], self._table, schema, overwrite)


def register_sqlite(spark: SparkSession) -> None:
    spark.dataSource.register(SqliteDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_sqlite(spark: SparkSession, path: str, table: str, columns: str | StructType | None = None, rows: int = RANGE_ROWS) -> DataFrame:
    """A table of a SQLite file or folder; ``columns``, a schema, names the only columns that are read."""
    register_sqlite(spark)
    reader = spark.read.format("sqlite").option("dbtable", table).option("rows", rows)
    return (reader if columns is None else reader.schema(columns)).load(path)


def write_sqlite(df: DataFrame, path: str, table: str, mode: str = "append") -> None:
    """A folder of SQLite files, one for each partition. With ``overwrite``, files that were there no longer count."""
    register_sqlite(df.sparkSession)
    df.write.format("sqlite").option("dbtable", table).mode(mode).save(path)
