"""Linking by parts against linking a whole field at once; components; long chains of close rows; replayed streams."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyloom.operators import match, transients
from skyloom.operators.components import connected_components
from skyloom.streaming.link import link_trails_stream

SCHEMA = "field_id long, image_id long, number long, jd double, ra double, dec double"


def sky(seed, fields=2, images=25, dec0=40.0):
    """Stars seen again and again, movers slow and fast (some crossing others' places), pairs, noise; equal JDs."""
    r = random.Random(seed)
    rows, number = [], 0
    for field in range(fields):
        stars = [(r.uniform(10, 10.2), dec0 + r.uniform(0, 0.1)) for _ in range(12)]
        movers = [(r.uniform(10, 10.2), dec0 + r.uniform(0, 0.1), r.uniform(-40, 40) / 3600, r.uniform(-40, 40) / 3600) for _ in range(8)]
        for n in range(images):
            jd = 2460000 + (n // 2) * 0.01 + (n > 15) * 0.7
            image = field * 1000 + n
            h = (jd - 2460000) * 24
            spots = [(x + r.gauss(0, 2e-5), y + r.gauss(0, 2e-5)) for x, y in stars if r.random() < 0.8]
            spots += [(x + u * h + r.gauss(0, 2e-5), y + v * h + r.gauss(0, 2e-5)) for x, y, u, v in movers if r.random() < 0.8]
            spots += [(r.uniform(10, 10.2), dec0 + r.uniform(0, 0.1)) for _ in range(3)] + [(10.05 + r.uniform(0, 1e-3), dec0 + 0.05)]
            for x, y in spots:
                rows.append((field, image, number, jd, x, y))
                number += 1
    return rows


def whole(rows, **options):
    """Each field through ``link_rows`` at once."""
    table = pd.DataFrame(rows, columns=["field_id", "image_id", "number", "jd", "ra", "dec"])
    out = {}
    for _, part in table.groupby("field_id", dropna=False):
        done, _ = transients.link_rows(part, None, **options)
        out |= dict(zip(done["number"], done["trail_id"]))
    return out


@pytest.mark.parametrize("seed,dec0,max_gap,most", [(1, 40.0, None, 0), (2, -89.97, None, 0), (3, 0.0, 3.0, 0), (3, 0.0, 3.0, 10**6)])
def test_parts_give_the_trails_of_the_whole_field(spark, seed, dec0, max_gap, most):
    rows = sky(seed, dec0=dec0)
    cand = spark.createDataFrame(rows, SCHEMA).withColumns({"part": F.lit(1), "_row": F.lit("x"), "trail": F.col("number") * 2})
    got = transients.link_trails(cand, max_gap=max_gap, whole=most)
    assert got.columns == [*cand.columns, "trail_id"]
    found = got.collect()
    assert {r.number: r.trail_id for r in found} == whole(rows, max_gap=max_gap) and all(r.trail == 2 * r.number and r._row == "x" for r in found)
    assert len({r.trail_id for r in found}) > 40


def test_linking_of_odd_rows(spark):
    rows = [(None, 1, 1, 0.0, 10.0, 0.0), (None, 2, 2, 0.1, 10.0, 0.0), (1, 3, 3, 0.0, None, 0.0), (1, 4, 4, 0.1, None, 0.0), (1, 5, 5, 0.2, float("nan"), 1.0), (1, 6, 6, 0.0, 10.0, 90.0), (1, 7, 7, 0.1, 190.0, 90.0)]
    for most in (0, 2, 100):  # both fields in parts, one of them, none
        got = {r.number: r.trail_id for r in transients.link_trails(spark.createDataFrame(rows, SCHEMA), whole=most).collect()}
        assert got[1] == got[2] == 0 and got[6] == got[7] and len({got[n] for n in (3, 4, 5, 6)}) == 4
    assert transients.link_trails(spark.createDataFrame([], SCHEMA)).count() == 0


def test_linking_takes_more_than_one_task(spark):
    """Candidates of one field go through many groups: no plan gathers a field."""
    rows = [(1, n % 50, n, 2460000 + (n % 50) * 0.01, 10 + (n // 50) * 0.05, 5.0) for n in range(3000)]
    plan = transients._link_parts(spark.createDataFrame(rows, SCHEMA).withColumns({"_row": F.col("number"), "part": F.col("number") % 60, "field": F.lit("=1")}), 3.6, 30.0, None)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in text and "FlatMapGroups" not in text
    assert {r._first for r in plan.collect()} >= set(range(50))


def test_components_of_chains_hubs_and_loops(spark):
    r = random.Random(7)
    edges = [(n, n + 1) for n in range(1000, 1400)] + [(0, n) for n in range(1, 200)] + [(5000 + r.randrange(90), 5000 + r.randrange(90)) for _ in range(80)] + [(9, 9), (8000, 8000)] + [(-5, 2**62)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()} == {n: find(n) for n in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_dedupe_of_a_chain_of_thousands(spark):
    """Every second row of a line of 5,000 stays, and the number of jobs does not grow with the line."""
    jobs = spark.sparkContext.statusTracker()
    rows = [(n, 10 + n * 0.9e-3, 0.0) for n in range(5000)]
    df = spark.createDataFrame(rows, "number long, alpha_j2000 double, delta_j2000 double")
    spark.sparkContext.setJobGroup("chain", "chain")
    got = {r.number for r in match.dedupe_sky(df, 1e-3, "first").collect()}
    assert got == set(range(0, 5000, 2))
    assert len(jobs.getJobIdsForGroup("chain")) < 400
    spark.sparkContext.setJobGroup("", "")


def test_stream_gives_the_trails_of_the_batch(spark, tmp_path):
    """Three replays of parts; two images of one JD come in two batches, and one image comes late."""
    rows = [row for row in sky(4, fields=1, images=12)]
    order = sorted({(row[3], row[1]) for row in rows})
    parts = [order[:5], order[5:6], order[6:]]  # order[4] and order[5] share a JD
    assert order[4][0] == order[5][0]
    source = tmp_path / "in"
    source.mkdir()
    for n, part in enumerate([*parts, parts[1]]):
        spark.createDataFrame([row for row in rows if (row[3], row[1]) in part], SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"b{n}"))
        for p in (tmp_path / f"b{n}").glob("*.parquet"):
            p.rename(source / f"{n}.parquet")
        stream = link_trails_stream(spark.readStream.schema(SCHEMA).parquet(str(source)))
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r.number: r.trail_id for r in got if not r.late} == whole(rows)
    again = [r for r in got if r.late]
    assert {r.image_id for r in again} == {order[5][1]} and all(r.trail_id is None for r in again)


def test_stream_forgets_trails_beyond_the_gap(spark, tmp_path):
    rows = [(1, 1, 1, 0.0, 10.0, 0.0), (1, 2, 2, 0.05, 10.0, 0.0), (1, 3, 3, 1.0, 10.0, 0.0), (1, 4, 4, 1.05, 10.0, 0.0)]
    source = tmp_path / "in"
    source.mkdir()
    for n, row in enumerate(rows):
        spark.createDataFrame([row], SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"b{n}"))
        for p in (tmp_path / f"b{n}").glob("*.parquet"):
            p.rename(source / f"{n}.parquet")
        stream = link_trails_stream(spark.readStream.schema(SCHEMA).parquet(str(source)), max_gap=3.0)
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination(120)
    assert {r.number: r.trail_id for r in spark.read.parquet(str(tmp_path / "out")).collect()} == whole(rows, max_gap=3.0) == {1: 0, 2: 0, 3: 1, 4: 1}


@pytest.mark.parametrize("kind", ["dense", "chain", "repeated", "poles"])
def test_dedupe_first_against_brute_force(spark, kind, monkeypatch):
    """the greedy form tabled all close pairs, of which a dense field has thousands a row."""
    def none(*_):
        raise AssertionError("a table of close pairs")

    monkeypatch.setattr(match, "close_pairs", none)
    r = random.Random(5)
    n, key, where = 700, list(range(700)), lambda: (r.uniform(359.99, 360.03) % 360, r.uniform(20.0, 20.03))
    if kind == "chain":
        steps = iter(range(n))
        where = lambda: (10 + 0.006 * next(steps), 0.0)
    elif kind == "poles":
        where = lambda: (r.uniform(-360, 720), r.choice([-1, 1]) * r.uniform(89.97, 90))
    r.shuffle(key)
    if kind == "chain":
        key = list(range(n))
    if kind == "repeated":
        key = [k // 3 for k in key]
    rows = [(i % 2 if kind == "dense" else 0, k, *where()) for i, k in enumerate(key)]
    rows += [(0, None, *rows[0][2:]), (None, 3, *rows[0][2:]), (0, 10_000, float("nan"), 20.0), (0, 10_001, None, 20.0)]

    def near(a, b):
        x, y = math.radians(a[3]), math.radians(b[3])
        h = math.sin((y - x) / 2) ** 2 + math.cos(x) * math.cos(y) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return math.degrees(2 * math.asin(math.sqrt(min(h, 1.0)))) < 0.01

    held, gone = [], set()
    placed = [row for row in rows if row[0] is not None and row[1] is not None and row[2] is not None and row[2] == row[2]]
    for name in sorted({row[:2] for row in placed}):
        own = [row for row in placed if row[:2] == name]
        if any(near(a, b) for a in own for b in held if b[0] == a[0]):
            gone.add(name)
        else:
            held += own
    want = sorted(map(str, (row for row in rows if row[:2] not in gone)))
    df = spark.createDataFrame(rows, "image_id long, number long, alpha_j2000 double, delta_j2000 double")
    for whole in (0, 100, 10_000):
        got = [tuple(x) for x in match.dedupe_sky(df, 0.01, "first", by=("image_id",), whole=whole).collect()]
        assert sorted(map(str, got)) == want, whole
    assert 0 < len(gone) < len({row[:2] for row in placed})


def test_close_pairs_against_brute_force(spark):
    """F8: each pair is met once, from below or in its band, and its distance is exact at the limit and for tiny radii."""
    r = random.Random(2)
    rows = [(n % 2, n, (359.99 + 0.03 * r.random()) % 360, 20 + 0.03 * r.random()) for n in range(300)]
    rows += [(0, 400 + n, r.uniform(-360, 720), r.choice([-1, 1]) * r.uniform(89.98, 90)) for n in range(200)]
    rows += [(1, 700 + n, 10.0, 40.0 + 0.01 * n) for n in range(5)] + [(0, 5, 0.001, 20.001), (0, None, 0.001, 20.001), (0, 800, float("nan"), 20.0), (None, 801, 0.001, 20.001)]
    rows += [(3, n, 200.0, 5.0 + 1e-7 * n) for n in range(40)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "image_id long, number long, ra double, dec double")

    def apart(a, b):
        x, y = math.radians(a[3]), math.radians(b[3])
        h = math.sin((y - x) / 2) ** 2 + math.cos(x) * math.cos(y) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return math.degrees(2 * math.asin(math.sqrt(min(h, 1.0))))

    good = [row for row in rows if row[0] is not None and row[1] is not None and row[2] == row[2]]
    for limit in (0.01, 2.5e-7):
        found = match.close_pairs(df, limit, "number", ("ra", "dec"), ("image_id",))
        want = sorted((a[0], a[1], b[1]) for a in good for b in good if a[0] == b[0] and a[1] < b[1] and apart(a, b) < limit)
        assert sorted(tuple(x) for x in found.collect()) == want and want
        assert "ASIN" not in _plan_above_doubt(found)


def _plan_above_doubt(df) -> str:
    """The condition of the join up to where it falls back to the exact distance."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan[plan.index("Join Inner") :].split(" OR ((")[0].upper() if "Join Inner" in plan else "ASIN"
