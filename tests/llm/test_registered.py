"""Registered queries against their SQL, and that every query keeps its contract's columns."""

import duckdb
import pytest

from mirrorset.llm.registry import REGISTRY

TABLES = "documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def rows(table):
    columns = sorted(table.column_names)
    return sorted((tuple(r[c] for c in columns) for r in table.select(columns).to_pylist()), key=repr)


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in REGISTRY.items() if sql))
def test_query_matches_sql(spark, sf, con, name):
    function, sql = REGISTRY[name]
    mine, theirs = function(spark, sf).toArrow(), con.sql(sql).to_arrow_table()
    assert sorted(mine.column_names) == sorted(theirs.column_names)
    assert list(map(repr, rows(mine))) == list(map(repr, rows(theirs)))
