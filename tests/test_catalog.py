import duckdb
import pytest

import __spark_entry__ as entry
from mirrorset.catalog import REGISTRY

TABLES = "region nation customer supplier part orders lineitem events"
ROWS_ONLY = {"gbt_chain", "hold_out_r2", "synthetic_database"}


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def rows(table):
    columns = sorted(table.column_names)
    return sorted((tuple(r[c] for c in columns) for r in table.select(columns).to_pylist()), key=repr)


def test_only_models_lack_sql():
    assert set(REGISTRY) - set(entry.oracle_sql()) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(set(REGISTRY) & set(entry.oracle_sql())))
def test_query_matches_sql(spark, sf, con, name):
    mine = entry.queries()[name](spark, sf).toArrow()
    theirs = con.sql(entry.oracle_sql()[name]).to_arrow_table()
    assert sorted(mine.column_names) == sorted(theirs.column_names)
    assert list(map(repr, rows(mine))) == list(map(repr, rows(theirs)))


def test_entry(spark):
    assert entry.entry(spark).count() == 1500
