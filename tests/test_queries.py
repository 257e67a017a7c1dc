"""Every registered query against its SQL on the same tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from ledger_sync.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def values(columns, rows):
    order = sorted(columns)
    return sorted(repr([row[columns.index(c)] for c in order]) for row in rows)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["userid", "balance"] and df.count() == 150


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert values(df.columns, df.collect()) == values(columns, result.fetchall())
