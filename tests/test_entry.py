"""The driver's contract: every query has SQL, and both agree on the smallest tables."""

import os
from glob import glob

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans import queries as base

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob(f"{SF}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def plain(value):
    return f"{value:.6f}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(base.queries()))
def test_query_equals_its_sql(spark, db, name):
    frame = base.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    found = sorted(tuple(plain(r[c]) for c in columns) for r in frame.collect())
    result = db.execute(base.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert found == want and found


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and "n_good" in frame.columns


def test_registered_names():
    assert set(base.queries()) == set(base.oracle_sql())
    assert set(base.queries()) <= set(entry.queries())
