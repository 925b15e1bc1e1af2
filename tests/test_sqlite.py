"""SQLite files written by the standard library and by Spark."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from mirrorset.sources import load_tables
from mirrorset.sources.sqlite import declared_type, read_sqlite, write_sqlite

ROWS = [
    (1, "A", 1.5, "2001-02-03", b"x", 1),
    (2, "b", None, None, None, 0),
    (50, None, 3.0, "", b"", None),
    (51, 'q"uote', -2.25, "x", b"\x00", 1),
    (1000, "Ä€", 0.0, "é", None, 0),
]


@pytest.fixture
def file(tmp_path):
    path = str(tmp_path / "herd book.db")
    connection = sqlite3.connect(path)
    connection.execute('CREATE TABLE "my table" (id INTEGER PRIMARY KEY, code VARCHAR(2) COLLATE NOCASE, milk REAL, day DATE, raw BLOB, ok BOOLEAN)')
    connection.executemany('INSERT INTO "my table" VALUES (?, ?, ?, ?, ?, ?)', ROWS)
    connection.execute("CREATE TABLE pairs (a TEXT, b INT, PRIMARY KEY (a, b)) WITHOUT ROWID")
    connection.executemany("INSERT INTO pairs VALUES (?, ?)", [("x", i) for i in range(5)])
    connection.execute("CREATE VIEW large AS SELECT id, milk FROM \"my table\" WHERE id > 10")
    connection.execute("CREATE TABLE no_rows (a INTEGER)")
    connection.execute("CREATE TABLE mixed (a INTEGER)")
    connection.execute("INSERT INTO mixed VALUES ('not a number')")
    connection.commit()
    connection.close()
    return path


def test_types_and_rows(spark, file):
    df = read_sqlite(spark, file, "my table", rows=20)
    assert dict(df.dtypes) == {"id": "bigint", "code": "string", "milk": "double", "day": "string", "raw": "binary", "ok": "boolean"}
    got = sorted((r.id, r.code, r.milk, r.day, None if r.raw is None else bytes(r.raw), r.ok) for r in df.collect())
    assert got == [(*r[:5], None if r[5] is None else bool(r[5])) for r in ROWS]
    assert df.rdd.getNumPartitions() == 50


def test_tables_without_rowids(spark, file):
    assert sorted(tuple(r) for r in read_sqlite(spark, file, "pairs").collect()) == [("x", i) for i in range(5)]
    assert sorted(r.id for r in read_sqlite(spark, file, "large").collect()) == [50, 51, 1000]
    assert read_sqlite(spark, file, "no_rows").collect() == []


@pytest.mark.parametrize(
    "condition, ids",
    [
        ("id > 50", {51, 1000}),
        ("code = 'a'", set()),
        ("code = 'A'", {1}),
        ("code < 'a'", {1}),
        ("code IN ('b', 'A')", {1, 2}),
        ("code IS NULL", {50}),
        ("milk >= 1.5 AND milk IS NOT NULL", {1, 50}),
        ("code LIKE 'q%'", {51}),
        ("ok", {1, 51}),
        ("NOT (id = 1) AND code <> 'b'", {51, 1000}),
        ("length(day) = 1", {51, 1000}),
    ],
)
def test_filters(spark, file, condition, ids):
    assert {r.id for r in read_sqlite(spark, file, "my table").where(condition).collect()} == ids


def test_comparisons_reach_the_file(file):
    from pyspark.sql.datasource import EqualTo, IsNull

    from mirrorset.sources.sqlite import SqliteDataSource

    source = SqliteDataSource({"path": file, "dbtable": "my table"})
    reader = source.reader(source.schema())
    given = [EqualTo(("code",), "A"), IsNull(("ok",)), EqualTo(("raw",), b"x")]
    assert list(reader.pushFilters(given)) == given
    assert [c for c, _ in reader.conditions] == ['"code" COLLATE BINARY = ?', '"ok" IS NULL']


def test_only_the_columns_of_a_schema_are_read(spark, file):
    df = read_sqlite(spark, file, "mixed", "a string")
    assert [r.a for r in df.collect()] == ["not a number"]
    assert sorted(tuple(r) for r in read_sqlite(spark, file, "my table", "milk double, id int").collect() if r.milk) == [(-2.25, 51), (1.5, 1), (3.0, 50)]


def test_a_value_of_another_type_fails(spark, file):
    with pytest.raises(Exception, match="column a"):
        read_sqlite(spark, file, "mixed").collect()
    with pytest.raises(Exception, match="no table"):
        read_sqlite(spark, file, "absent").collect()


def test_round_trip_over_several_files(spark, tmp_path, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = str(tmp_path / "orders")
    write_sqlite(orders.repartition(4), path, "orders")
    back = read_sqlite(spark, path, "orders", rows=100)
    assert back.rdd.getNumPartitions() >= 8
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, orders.collect()))
    write_sqlite(orders.limit(3), path, "orders")
    assert read_sqlite(spark, path, "orders").count() == orders.count() + 3
    write_sqlite(orders.limit(2), path, "orders", "overwrite")
    assert read_sqlite(spark, path, "orders").count() == 2


def test_load_tables(spark, file):
    tables = load_tables(spark, file, ["pairs", "my table"], "sqlite")
    assert tables["pairs"].agg(F.sum("b")).first()[0] == 10 and tables["my table"].count() == 5


def test_declared_types():
    names = ["TINYINT", "varchar(3)", "DECIMAL(5,1)", "double precision", "BLOB", "", None, "DATETIME"]
    assert [declared_type(n).simpleString() for n in names] == ["bigint", "string", "double", "double", "binary", "string", "string", "string"]
