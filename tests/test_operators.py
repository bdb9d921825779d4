"""Small hand-made cases: ties, nulls, wrap-around, poles, empty tables; recovery of known fits; plans."""

import math
import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.functions import headers, response
from skyloom.operators import calib, filters, fit, match, stack, transients
from skyloom.sources import archive, tables
from skyloom.streaming.link import link_trails_stream


def test_parse_coord(spark):
    cases = [("14:15:16.545", True, 213.8189375), ("-14:15:16", False, -14.2544444), ("+14 15 16", False, 14.2544444), ("-0:30:00", False, -0.5), ("123:00:00", False, 123.0), ("12.5", False, 12.5), ("+1-4:15:16", False, None)]
    for text, is_ra, want in cases:
        got = spark.createDataFrame([(text,)], "t string").select(headers.parse_coord(F.col("t"), is_ra).alias("v")).first().v
        assert got == pytest.approx(want, abs=1e-6) if want is not None else got is None, text


def test_time_sources(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z", None, None), (None, 60310.0, None), (None, None, 2460310.5), (None, None, None)], "date_obs string, mjd double, jd double")
    got = [r.jd for r in headers.reconcile_time(df).collect()]
    assert got[:3] == pytest.approx([2460310.5] * 3) and got[3] is None


def test_terms():
    groups = response.parse_terms("&Z,.p3,.r3,#PC=0.1,*PD", stepwise=True)
    assert groups["always"] == ["Z"] and groups["fixed"] == ["PC=0.1"] and groups["per_image"] == ["PD"]
    assert groups["stepwise"] == ["PX", "PY", "P2X", "PXY", "P2Y", "P3X", "P2XY", "PX2Y", "P3Y", "P2R", "P3R"]


def test_match_ties_nulls_empty(spark):
    det = spark.createDataFrame([(1, 1, 10.0, 10.0), (1, 2, float("nan"), 5.0), (1, 3, None, 5.0)], "image_id long, number long, x_image double, y_image double")
    stars = spark.createDataFrame([(7, 11.0, 10.0), (5, 9.0, 10.0), (9, None, 1.0)], "star_id long, cat_x double, cat_y double")
    got = [(r.number, r.star_id, r["rank"]) for r in match.match_radius(det, stars, 2.0).orderBy("rank").collect()]
    assert got == [(1, 5, 1), (1, 7, 2)]
    assert match.match_radius(det.limit(0), stars, 2.0).count() == 0
    assert "CartesianProduct" not in match.match_radius(det, stars, 2.0)._jdf.queryExecution().toString()


def test_sky_join_wraps_and_poles(spark):
    a = spark.createDataFrame([(1, 359.9999, 0.0), (2, 10.0, 89.9999), (3, 100.0, -45.0)], "i long, ra double, dec double")
    b = spark.createDataFrame([(1, 0.0001, 0.0), (2, 190.0, 89.9999), (3, 100.0001, -45.0)], "j long, ra2 double, dec2 double")
    got = {(r.i, r.j) for r in match.sky_join(a, b, 0.001, ("ra", "dec"), ("ra2", "dec2")).collect()}
    assert got == {(1, 1), (2, 2), (3, 3)}


def test_tiles_at_pole_and_wrap(spark):
    fields = spark.createDataFrame([(1, 0.1, 89.9, 0.5, 0.5), (2, 0.0, 0.5, 0.6, 0.3)], "field_id long, ra0 double, dec0 double, da double, dd double")
    got = {k: {r.tile for r in filters.tiles_for(fields).collect() if r.field_id == k} for k in (1, 2)}
    assert {t % 360 for t in got[1]} == set(range(360)) and {t // 360 for t in got[1]} == {179}
    assert got[2] == {90 * 360, 90 * 360 + 359}


def test_fit_recovers(spark):
    rows = spark.range(2000).selectExpr("id % 5 as image_id", "((id * 7919) % 1000) / 500.0 - 1 as coord_x", "((id * 104729) % 997) / 498.0 - 1 as coord_y", "((id * 31) % 101) / 20.0 as mag_auto", "0.05D as dy")
    rows = rows.withColumn("cat_mag", F.col("mag_auto") + 21.5 + 0.1 * F.col("image_id") + 0.3 * F.col("coord_x") - 0.2 * F.col("coord_x") * F.col("coord_y"))
    f = fit.fit_per_image(rows, ["PX", "PXY"], ["Z"])
    assert f.values["PX"] == pytest.approx(0.3, abs=1e-8) and f.values["PXY"] == pytest.approx(-0.2, abs=1e-8)
    assert {r.image_id: round(r.value, 6) for r in f.per_image.collect()} == {n: round(21.5 + 0.1 * n, 6) for n in range(5)}
    one = rows.where("image_id = 0").withColumn("cat_mag", F.col("cat_mag") + F.when(F.col("coord_x") > 0.98, 5.0).otherwise(0.001 * F.sin(F.col("mag_auto") * 50)))
    best, chosen = fit.stepwise(one, ["PX", "PY", "PXY", "P2X"], ["Z"])
    assert {"Z", "PX", "PXY"} <= set(chosen) and best.values["PX"] == pytest.approx(0.3, abs=0.02)
    assert fit.f_pvalue(4.0, 1, 20) == pytest.approx(0.0593, abs=1e-3)


def test_zeropoint_of_empty_image(spark):
    images = spark.createDataFrame([(1,), (2,)], "image_id long")
    pairs = spark.createDataFrame([(1, 20.0, -2.0)], "image_id long, cat_mag double, mag_auto double")
    assert {r.image_id: r.zeropoint for r in calib.zeropoints(pairs, images).collect()} == {1: 22.0, 2: 0.0}


def test_linking_competition(spark):
    rows = [(1, 1, 1, 0.0, 10.0, 0.0), (1, 2, 2, 0.1, 10.0, 0.0002), (1, 2, 3, 0.1, 10.0, 0.0001), (1, 3, 4, 0.2, 10.0, 0.001)]
    cand = spark.createDataFrame(rows, "field_id long, image_id long, number long, jd double, ra double, dec double")
    got = {r.number: r.trail_id for r in transients.link_trails(cand).collect()}
    assert got[1] == got[2] == 0 and got[3] == 1  # the first candidate takes the trail, the second starts one
    edge = spark.createDataFrame([(1, 1, 1, 0.0, 10.0, 0.0), (1, 2, 2, 0.1, 10.0, 3.6 / 3600)], cand.schema)
    assert {r.trail_id for r in transients.link_trails(edge, base=3.6 - 1e-9).collect()} == {0, 1}


def test_link_stream(spark, tmp_path):
    schema = "field_id long, image_id long, number long, jd double, ra double, dec double"
    for n, rows in enumerate([[(1, 1, 1, 0.0, 10.0, 0.0)], [(1, 2, 2, 0.1, 10.0, 0.0001)], [(1, 0, 3, 0.05, 10.0, 0.0)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"b{n}"))
    source = tmp_path / "in"
    source.mkdir()
    query = None
    for n in range(3):
        for p in (tmp_path / f"b{n}").glob("*.parquet"):
            p.rename(source / f"{n}.parquet")
        stream = link_trails_stream(spark.readStream.schema(schema).parquet(str(source)))
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        query.awaitTermination(120)
    got = {r.number: (r.trail_id, r.late) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: (0, False), 2: (0, False), 3: (None, True)}


def test_ecsv_and_ascii_head(spark, tmp_path):
    (tmp_path / "a.ecsv").write_text("# %ECSV 1.0\n# ---\n# datatype:\n# - {name: NUMBER, datatype: int64}\n# meta: !!omap\n# - {JD: 2460310.5}\n# - {FILTER: 'Sloan_r'}\n# schema: astropy-2.0\nNUMBER X_IMAGE\n1 10.5\n2 \"\"\n")
    (tmp_path / "b.ecsv").write_text("# nothing here\n")
    det, images = tables.read_ecsv(spark, f"{tmp_path}/*.ecsv", {"number": "long", "x_image": "double", "y_image": "double"})
    assert [(r.number, r.x_image, r.y_image) for r in det.orderBy("number").collect()] == [(1, 10.5, None), (2, None, None)]
    assert [(r.jd, r["filter"]) for r in images.collect()] == [(2460310.5, "Sloan_r")]
    (tmp_path / "c.cat").write_text("#   1 NUMBER  Running number\n#   2 X_IMAGE  Position\n  1  3.5\n  2  4.5\n")
    got = tables.read_ascii_head(spark, f"{tmp_path}/c.cat", {"x_image": "double", "flags": "int"})
    assert [(r.x_image, r.flags) for r in got.orderBy("row").collect()] == [(3.5, None), (4.5, None)]


def test_splits_are_pruned(spark, tmp_path):
    stars = spark.range(100).selectExpr("id as star_id", "id * 0.2D as sloan_r")
    tables.write_splits(stars, str(tmp_path / "s"), [10.0, 15.0, 20.0])
    got = tables.scan_splits(spark, str(tmp_path / "s"), 9.0)
    assert got.count() == 46
    scan = re.search(r"PartitionFilters: \[([^]]*)\]", got._jdf.queryExecution().executedPlan().toString())[1]
    assert "mag_split" in scan and "10.0" in scan and "20.0" not in scan


def test_models_and_catalogs(spark, tmp_path):
    model = spark.createDataFrame([("Z", 22.5, 0.01, False), ("PX", 0.1, 0.0, False)], "term string, value double, err double, fixed boolean")
    tables.save_model(model, str(tmp_path / "m"))
    assert {r.term: r.fixed for r in tables.load_model(spark, str(tmp_path / "m")).collect()} == {"Z": False, "PX": True}
    images = spark.createDataFrame([(1, 2460310.5), (2, 2460350.5)], "image_id long, jd double")
    det = spark.createDataFrame([(1, 1), (2, 1)], "image_id long, number long")
    archive.write_catalog(det, images, str(tmp_path / "cat"))
    assert {(r.image_id, r.ym) for r in spark.read.parquet(str(tmp_path / "cat/detections")).collect()} == {(1, 2401), (2, 2402)}
    with pytest.raises(ValueError):
        tables.require_all(spark.createDataFrame([("a/x.fits",)], "fitsfile string"), spark.createDataFrame([("y.fits",)], "file string"))
    tables.write_regions(spark.createDataFrame([(1.0, 2.0, "red", 3.0)], "radeg double, decdeg double, color string, radius double"), str(tmp_path / "reg"))
    assert spark.read.text(str(tmp_path / "reg")).first().value.startswith("# Region file")


def test_report_and_rectangle(spark):
    rows = spark.createDataFrame([(1, 1, "normal")], "image_id long, number long, type string")
    images = spark.createDataFrame([(1, "r", 1.0, 2.0), (2, "r", 1.0, 2.0)], "image_id long, filter string, jd double, exptime double")
    got = {r.image_id: json.loads(r.report) for r in tables.to_report_json(rows, images, ("number", "type")).collect()}
    assert got[1]["summary"] == {"normal": 1} and got[2]["objects"] == []
    cov = spark.createDataFrame([(y, x, 2 if 1 <= x <= 3 and y >= 1 else 1) for y in range(4) for x in range(5)], "y long, x long, n long")
    r = stack.largest_rectangle(cov).first()
    assert (r.x, r.y, r.w, r.h, r.area) == (1, 1, 3, 3, 9)
    assert stack.largest_rectangle(cov, "out").first().area == 20


def _largest_by_brute_force(filled):
    """(x, y, w, h, area) over all rectangles; ties as the operator's."""
    best = None
    for y1, x1 in filled:
        right = None
        y2 = y1
        while (y2, x1) in filled:
            x2 = x1
            while (y2, x2 + 1) in filled and (right is None or x2 < right):
                x2 += 1
            right = x2
            for x in range(x1, right + 1):
                w, h = x - x1 + 1, y2 - y1 + 1
                key = (-w * h, y2, x1, -h)
                if best is None or key < best[0]:
                    best = (key, (x1, y1, w, h, w * h))
            y2 += 1
    return best[1]


@pytest.mark.parametrize("seed,share", [(1, 0.9), (2, 0.7), (3, 0.97)])
def test_rectangles_over_tiles(spark, seed, share):
    random = np.random.default_rng(seed)
    cells = [(y, x - 3, 1) for y in range(14) for x in range(41) if random.random() < share]
    want = _largest_by_brute_force({(y, x) for y, x, _ in cells})
    cov = spark.createDataFrame(cells, "y long, x long, n long")
    for tile in (3, 512):
        assert tuple(stack.largest_rectangle(cov, tile=tile).first()) == want


def test_rectangle_wider_than_tiles(spark):
    wide = spark.range(20_000).select(F.col("id").alias("x"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("y"), F.lit(1).alias("n")).where("y < 2 or x between 5000 and 18000")
    assert tuple(stack.largest_rectangle(wide, tile=2048).first()) == (0, 0, 20_000, 2, 40_000)
    stairs = spark.range(300).select(F.col("id").alias("x"), F.explode(F.expr("sequence(0L, id)")).alias("y"), F.lit(1).alias("n"))
    assert tuple(stack.largest_rectangle(stairs.withColumn("y", 299 - F.col("y")), tile=32).first()) == (149, 150, 151, 150, 22_650)
    assert stack.largest_rectangle(wide.where("n > 1")).first().area is None


def test_powerlaw_and_filter_modes(spark):
    assert spark.range(1).select(headers.powerlaw_mag(F.lit(1.0), 1.0, 15.0, 1.0).alias("m")).first().m is None
    scores = spark.createDataFrame([("a", 0.5), ("b", 0.9)], "filter string, score double")
    assert calib.decide_filter(scores, "a", "discover") == "b" and calib.decide_filter(scores, "a", "warn") == "a"
    with pytest.raises(ValueError):
        calib.decide_filter(scores, "a", "strict")


def test_dedupe_first_decides_long_chains(spark):
    from skyloom.operators.match import dedupe_sky

    n, step = 104, 0.006  # each star is near the next one only, in order of the key
    stars = spark.createDataFrame([(i, 10.0 + i * step, 0.0) for i in range(n)], "number long, alpha_j2000 double, delta_j2000 double")
    kept = dedupe_sky(stars, 0.01, keep="first").collect()
    assert sorted(r.number for r in kept) == list(range(0, n, 2))


def test_widest_spans_against_brute_force():
    import random

    r = random.Random(3)
    for _ in range(200):
        x = sorted(r.sample(range(14), r.randrange(1, 14)))
        h = [r.randrange(1, 5) for _ in x]
        high = dict(zip(x, h))
        want = set()
        for c in x:
            a = b = c
            while high.get(a - 1, 0) >= high[c]:
                a -= 1
            while high.get(b + 1, 0) >= high[c]:
                b += 1
            want.add((a, b, high[c]))
        assert set(stack.widest_spans(x, h)) == want


def test_scattered_images_find_their_neighbours(spark):
    import math
    import random

    r = random.Random(9)
    rows = [(n, r.uniform(0, 300), r.uniform(-60, 60), 0.4) for n in range(60)] + [(60, 10.0, 10.0, 0.4), (61, 10.1, 10.0, 0.4)]
    images = spark.createDataFrame(rows, "image_id long, ctrra double, ctrdec double, field double")
    got = {x.image_id: x.nn for x in stack.cluster_images(images).collect()}
    apart = lambda a, b: math.hypot((a[1] - b[1]) * math.cos(math.radians(min(a, b)[2])), a[2] - b[2])
    assert got == pytest.approx({a[0]: min(apart(a, b) for b in rows if b[0] != a[0]) for a in rows})
    plan = stack.cluster_images(images)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("proj", ["TAN", "ZEA", "ARC", "ZPN", "AZP", "SZP"])
def test_coverage_against_every_cell(spark, proj):
    """Edges of runs give what projecting each cell into each image gives; turned images leave runs of any place."""
    from skyloom.functions import astrom

    frame = {"crval1": 10.0, "crval2": -35.0, "scale": 0.02, "size_x": 40, "size_y": 30, "crpix1": 20.0, "crpix2": 15.0}
    rows = [(n, 10 + 0.1 * (n % 7) - 0.3, -35 + 0.08 * (n % 5) - 0.2, 200, 120, 100.0, 60.0, 0.002 * c, -0.002 * s, 0.002 * s, 0.002 * c, 0.5, 1.5) for n, (c, s) in enumerate([(math.cos(t), math.sin(t)) for t in range(20)])]
    rows += [(90, None, -35.0, 200, 120, 100.0, 60.0, 0.002, 0.0, 0.0, 0.002, 0.5, 1.5), (91, 190.0, 35.0, 200, 120, 100.0, 60.0, 0.002, 0.0, 0.0, 0.002, 0.5, 1.5)]
    names = "image_id long, ctrra double, ctrdec double, imgaxis1 int, imgaxis2 int, crpix1 double, crpix2 double, cd1_1 double, cd1_2 double, cd2_1 double, cd2_2 double, diagonal double, pv2_1 double"
    images = spark.createDataFrame(rows, names).withColumns({"crval1": F.col("ctrra"), "crval2": F.col("ctrdec")})
    if proj == "ZPN":
        images = images.withColumn("pv2_3", F.lit(0.4))
    grid = spark.range(40).withColumnRenamed("id", "x").crossJoin(spark.range(30).withColumnRenamed("id", "y"))
    wcs = {"crval1": 10.0, "crval2": -35.0, "crpix1": 20.0, "crpix2": 15.0, "cd1_1": 0.02, "cd1_2": 0.0, "cd2_1": 0.0, "cd2_2": 0.02}
    sky = astrom.pix2world(grid.withColumns({c: F.lit(v) for c, v in wcs.items()}), "TAN", "x", "y", ("ra", "dec")).select("x", "y", "ra", "dec")
    back = astrom.world2pix(sky.crossJoin(images.where("ctrra < 100")), proj, "ra", "dec", ("px", "py"))
    want = back.where(F.col("px").between(0, F.col("imgaxis1")) & F.col("py").between(0, F.col("imgaxis2"))).groupBy("y", "x").count()
    cov = stack.coverage(images, frame, proj)
    assert sorted((r.y, r.x, r.n) for r in cov.collect()) == sorted((r.y, r.x, r["count"]) for r in want.collect())
    assert "Join" not in cov._jdf.queryExecution().executedPlan().toString()


def test_unreadable_files_are_skipped_and_named(spark, tmp_path):
    import gzip

    text = b"# %ECSV 1.0\n# ---\n# meta:\n#   JD: 2460310.5\nnumber x_image\n1 10.5\n2 11.5\n"
    whole = gzip.compress(text * 50)
    files = {"a.ecsv": text, "b.ecsv.gz": gzip.compress(text), "cut.ecsv.gz": whole[: len(whole) // 2], "noise.ecsv.gz": bytes(range(256)) * 20, "empty.ecsv": b"", "head.ecsv": b"# %ECSV 1.0\n# meta:\n"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    det, images = tables.read_ecsv(spark, str(tmp_path), {"number": "long", "x_image": "double"})
    assert sorted((r.file.rsplit("/", 1)[1], r.number, r.x_image) for r in det.collect()) == [(f, n, 9.5 + n) for f in ("a.ecsv", "b.ecsv.gz") for n in (1, 2)]
    assert {r.jd for r in images.collect()} == {2460310.5} and images.count() == 2
    skipped = {r.file.rsplit("/", 1)[1]: (r.bytes, r.reason) for r in tables.skipped_files(spark, str(tmp_path)).collect()}
    want = {"cut.ecsv.gz": "unreadable", "noise.ecsv.gz": "unreadable", "head.ecsv": "no names"}
    assert skipped == {f: (len(files[f]), reason) for f, reason in want.items()}


def test_quoted_cells_repeated_keys_and_bad_lines(spark, tmp_path):
    text = "# %ECSV 1.0\n# ---\n# delimiter: ','\n# meta:\n#   COMMENT: a\n#   COMMENT: b\n#   JD: 2460310.5\nnumber,object,mag\n1,\"a, \"\"b\"\"\",15.5\n,,\n3,plain,\n"
    (tmp_path / "x.ecsv").write_text(text)
    (tmp_path / "y.ecsv").write_text(text.replace("delimiter: ','", "delimiter: ' '").split("number,")[0] + 'number object mag\n7 "two words" 9.5\n')
    det, images = tables.read_ecsv(spark, str(tmp_path), {"number": "long", "object": "string", "mag": "double"})
    assert {tuple(r)[2:] for r in det.collect()} == {(1, 'a, "b"', 15.5), (None, "", None), (3, "plain", None), (7, "two words", 9.5)}
    assert {r.extra["comment"] for r in images.collect()} == {"b"} and {r.jd for r in images.collect()} == {2460310.5}
    long = "x, " * 9000 + 'y""z'
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines/x.ecsv").write_bytes((text + f'4,"two\n\nlines\n# no comment",2.5\r\n"6","{long}",3.5\n# late\n5,5" tube,1.5').encode())
    det, images = tables.read_ecsv(spark, str(tmp_path / "lines"), {"number": "long", "object": "string", "mag": "double"})
    new = {(4, "two\n\nlines\n# no comment", 2.5), (6, long.replace('""', '"'), 3.5), (5, '5" tube', 1.5)}
    assert {tuple(r)[2:] for r in det.where("number > 3").collect()} == new and det.count() == 6 and images.count() == 1
    (tmp_path / "cat").mkdir()
    (tmp_path / "cat/a.csv").write_text(",".join(["1"] * 44) + "\nbad,line\n")
    assert tables.read_refcat_csv(spark, str(tmp_path / "cat")).count() == 1
    assert [r.line for r in tables.bad_refcat_rows(spark, str(tmp_path / "cat")).collect()] == ["bad,line"]
