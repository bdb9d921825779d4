"""Catalogues stored by tiles and cells, against every pair of star and field or detection; what plans read and move."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from skyloom.sources import skycells


def apart(a1, d1, a2, d2):
    a1, d1, a2, d2 = map(math.radians, (a1, d1, a2, d2))
    return math.degrees(2 * math.asin(min(1, math.sqrt(math.sin((d2 - d1) / 2) ** 2 + math.cos(d1) * math.cos(d2) * math.sin((a2 - a1) / 2) ** 2))))


def places(seed, n):
    """Positions all over the sky, crowded at both poles, at RA 0 and around one place."""
    r = random.Random(seed)
    out = [(r.uniform(0, 360), math.degrees(math.asin(r.uniform(-1, 1)))) for _ in range(n)]
    out += [(r.uniform(0, 360), s * (90 - abs(r.gauss(0, 0.5)))) for s in (1, -1) for _ in range(n // 4)]
    out += [((360 + r.gauss(0, 0.5)) % 360, r.gauss(0, 1)) for _ in range(n // 4)] + [(120 + r.gauss(0, 0.2), -45 + r.gauss(0, 0.2)) for _ in range(n // 4)]
    return out + [(0.0, 90.0), (77.0, -90.0), (0.0, 0.0), (359.999999999, 0.0)]


def test_fields_of_a_tiled_catalogue(spark, tmp_path):
    stars = [(n, *p, "own") for n, p in enumerate(places(1, 900))]
    df = spark.createDataFrame([*stars, (-1, None, 1.0, "x"), (-2, float("nan"), 1.0, "x")], "star_id long, radeg double, decdeg double, tile string")
    path = str(tmp_path / "tiles")
    skycells.write_tiled(df, path)
    r = random.Random(2)
    fields = [(n, a, d, r.choice([0.01, 0.4, 3.0]), r.choice([0.02, 1.0])) for n, (a, d) in enumerate(places(3, 60))] + [(999, None, 1.0, 1.0, 1.0), (1000, 120.999, -45.0, 0.05, 0.05)]
    table = spark.createDataFrame(fields, "field_id long, ra0 double, dec0 double, da double, dd double")
    got = {(x.field_id, x.star_id) for x in skycells.scan_fields(spark, path, table).collect()}
    want = {(f[0], s[0]) for f in fields if f[1] is not None for s in stars if apart(f[1], f[2], s[1], s[2]) <= f[3]}
    assert got == want and len(want) > 200
    from skyloom.operators.filters import rect_condition

    every = df.where("star_id >= 0").drop("tile").crossJoin(table.where("ra0 is not null"))
    want = {(x.field_id, x.star_id) for x in every.where(rect_condition(*[F.col(c) for c in ("radeg", "decdeg", "ra0", "dec0", "da", "dd")])).collect()}
    assert {(x.field_id, x.star_id) for x in skycells.scan_fields(spark, path, table, "rect").collect()} == want
    one = skycells.scan_fields(spark, path, table.where("field_id = 1000"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*tile", plan)
    tiles = {x.tile for x in skycells.covering_tiles(table.where("field_id = 1000")).collect()}
    assert tiles == {120 + 360 * 44, 121 + 360 * 44, 120 + 360 * 45, 121 + 360 * 45}
    assert skycells.scan_fields(spark, path, table.limit(0)).count() == 0


@pytest.mark.parametrize("size,r", [(0.5, 0.3), (2.0, 0.01), (0.05, 0.3)])
def test_matches_on_stored_cells(spark, tmp_path, size, r):
    stars, det = places(5, 300), places(6, 300)
    det += [(a, min(max(d + r * 0.999, -90), 90)) for a, d in stars[:200]]
    name = f"cells_{str(size).replace('.', '_')}"
    table = spark.createDataFrame([(n, *p) for n, p in enumerate(stars)] + [(-1, None, 0.0)], "star_id long, radeg double, decdeg double")
    index = skycells.CellIndex(spark, name, size).write(table, str(tmp_path / name), 8)
    rows = spark.createDataFrame([(n, *p) for n, p in enumerate(det)] + [(-1, 0.0, float("nan"))], "number long, alpha_j2000 double, delta_j2000 double")
    got = index.match(rows, r)
    found = [(x.number, x.star_id) for x in got.collect()]
    want = {(i, j) for i, (a, d) in enumerate(det) for j, (b, e) in enumerate(stars) if apart(a, d, b, e) <= r}
    assert len(found) == len(set(found)) and set(found) == want
    index.drop()


def test_stored_catalogue_is_not_exchanged(spark, tmp_path):
    table = spark.createDataFrame([(n, n * 0.01, 5.0) for n in range(2000)], "star_id long, radeg double, decdeg double")
    index = skycells.CellIndex(spark, "cells_plan", 0.02).write(table, str(tmp_path / "cells"), 8)
    det = spark.createDataFrame([(n, n * 0.01, 5.007) for n in range(50)], "number long, alpha_j2000 double, delta_j2000 double")
    plan = index.match(det, 1e-4)._jdf.queryExecution().executedPlan().toString()
    joins = plan[plan.index("SortMergeJoin") :]
    star_side = joins[joins.index("FileScan") - 400 :]
    assert plan.count("Exchange hashpartitioning(sky_cell") == 1 and "Bucketed: true" in star_side
    assert index.post(det, 1e-4).count() < 1.2 * 50
    index.drop()
