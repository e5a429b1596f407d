"""Every registered query against its SQL in DuckDB, on the same files."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from loadwitness import registry
from loadwitness.registry.views import TABLES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def test_every_query_of_the_library_has_its_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    found = QUERIES[name](spark, FOLDER)
    wanted = duck.execute(ORACLES[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(found.columns) == sorted(columns)
    wanted_rows = rows_of(columns, wanted.fetchall())
    found_rows = rows_of(found.columns, [tuple(r) for r in found.collect()])
    assert wanted_rows or FOLDER.endswith("sf0.001")
    assert len(found_rows) == len(wanted_rows)
    for ours, theirs in zip(found_rows, wanted_rows):
        assert ours == theirs
