"""Every registered photometry query against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from skyloom.fixtures import TABLES
from skyloom.queries import QUERIES, SQL, load

SF = "/root/testdata/sf0.001"
load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool) or isinstance(value, str):
        return value
    return round(float(value), 9)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", ["k_find_transients"])
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
