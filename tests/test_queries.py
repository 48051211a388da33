"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from catalog.jobs import JOBS

FOLDERS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]
QUERIES = {name: query for name, query in entry.queries().items() if name in JOBS}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in JOBS}


@pytest.fixture(scope="module", params=FOLDERS)
def tables(request):
    """A folder of tables, and the same as DuckDB views."""
    connection = duckdb.connect()
    for path in glob.glob(f"{request.param}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return request.param, connection


def values(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([row[at] for at in order]) for row in rows)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, tables, name):
    folder, db = tables
    found = QUERIES[name](spark, folder)
    expected = db.execute(SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(columns)
    assert values(found.columns, [tuple(r) for r in found.collect()]) == values(columns, expected.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
