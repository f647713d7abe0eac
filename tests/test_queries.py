"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(repr(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    got = entry_module.queries()[name](spark, SF)
    cursor = con.execute(entry_module.oracle_sql()[name])
    want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == want


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
