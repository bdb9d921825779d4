"""Queries against their SQL on keys that the smallest tables lack."""

import duckdb
import pytest
from test_queries import rows

from skyloom.queries import QUERIES, SQL, load

load()


@pytest.fixture
def images(tmp_path):
    """Makes a folder whose supplier table, the images, has the given keys."""

    def make(keys):
        duckdb.execute(f"copy (select k as s_suppkey, 'x' as s_name, cast(k % 25 as integer) as s_nationkey, 1.0::double as s_acctbal from unnest({list(keys)}::bigint[]) t(k)) to '{tmp_path}/supplier.parquet' (format parquet)")
        return str(tmp_path)

    return make


def same(spark, sf, name):
    con = duckdb.connect()
    con.execute(f"create view supplier as select * from '{sf}/supplier.parquet'")
    got, want = QUERIES[name](spark, sf), con.sql(SQL[name])
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_fields_are_placed_in_doubles(spark, images):
    """2800 * 11.7 is 32,760 in decimals and less in doubles, so the field lies at dec -60 or just under 60."""
    same(spark, images([0, 7, 2800]), "c16_tiles_rect")


def test_closest_filter_between_wavelengths(spark, images):
    """Wavelengths on both sides of the middles of g, r (5490) and r, i (6845), and on them, where the first filter counts."""
    ids = [k for k in range(12000) if k % 5 != 4 and 4003 + k * 37 % 4000 in (5484, 5485, 5487, 5489, 5490, 5491, 6839, 6840, 6843, 6844, 6845, 6846)]
    assert len(ids) > 24
    same(spark, images(ids), "j01_closest_filter")


@pytest.mark.parametrize("name", ["f03_link_trails", "s01_link_trails_stream"])
def test_trails_that_miss_their_next_detection(spark, tmp_path, name):
    """Two detections seconds apart give a trail a wild motion: the next one starts a trail of its own."""
    duckdb.execute(f"""copy (select u * 40 + n as event_id, timestamp '2024-01-01' + to_seconds(u * 977 + case when n = 1 then 2 + u else n * 60013 + (n * n * 7919) % 30011 end) as ts, u as user_id, 'view' as event_type, 1.0::double as value
     from range(12) a(u), range(40) b(n)) to '{tmp_path}/events.parquet' (format parquet)""")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    got, want = QUERIES[name](spark, str(tmp_path)), con.sql(SQL[name])
    found = [tuple(r) for r in got.collect()]
    assert len({r[2] for r in found}) > 12
    assert rows(got.columns, found) == rows(want.columns, want.fetchall())


def test_planted_movers_that_cross(spark, tmp_path):
    """Images of half a year: movers come by where others were."""
    duckdb.execute(f"copy (select k as s_suppkey, 'x' as s_name, cast(k % 25 as integer) as s_nationkey, 1.0::double as s_acctbal from range(0, 9000, 37) t(k)) to '{tmp_path}/supplier.parquet' (format parquet)")
    for t in ("nation", "part", "customer"):
        duckdb.execute(f"copy (select * from '/root/testdata/sf0.001/{t}.parquet') to '{tmp_path}/{t}.parquet' (format parquet)")
    duckdb.execute(f"copy (select * replace (l_suppkey * 37 as l_suppkey) from '/root/testdata/sf0.001/lineitem.parquet') to '{tmp_path}/lineitem.parquet' (format parquet)")
    con = duckdb.connect()
    for t in ("nation", "part", "customer", "lineitem", "supplier"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
    got, want = QUERIES["k_find_planted"](spark, str(tmp_path)), con.sql(SQL["k_find_planted"])
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())
