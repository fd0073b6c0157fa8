"""Every registered query against its SQL, over whole tables at the smallest scale."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from stallwise.plans import bindings, catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = catalog.QUERIES, entry.oracle_sql()
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for table in bindings.TABLES:
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return con


def shown(rows, order):
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = oracle.execute(ORACLES[name])
    theirs = [d[0] for d in found.description]
    assert sorted(theirs) == columns
    assert shown(df.collect(), [df.columns.index(c) for c in columns]) == shown(
        found.fetchall(), [theirs.index(c) for c in columns]
    )


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLES) <= set(entry.queries())


@needs_tables
def test_entry(spark):
    assert {r.status for r in entry.entry(spark).collect()} == {"processed", "duplicate", "failed"}
