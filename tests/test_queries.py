"""Every registered query against its DuckDB text on the smallest driver tables."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
import registry
from tools.check import TABLES, rows_of

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(SQL[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    got = rows_of(df.columns, df.collect())
    assert got[0] == want[0]
    assert got[1] == want[1]
    if not name.endswith("_h016") and not name.startswith("quarantine_"):  # so little data may hold none
        assert got[1], "a query that returns nothing checks nothing"


def test_entry_is_the_flagship(spark):
    assert entry.entry(spark).columns[-1] == "total_fraud_signals"
