"""Plans that must not hang on how small Spark takes a table for."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from skyloom.fixtures import BY_STAR, view
from skyloom.functions.response import response_terms
from skyloom.operators import calib, filters, match, transients
from skyloom.queries import QUERIES, load, matching
from skyloom.sources import tables

SF = "/root/testdata/sf0.001"
load()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def broadcasts_posted(plan: str) -> bool:
    """A broadcast whose input is posted in cells: a Generate below a BroadcastExchange and nowhere above it."""
    lines = plan.splitlines()
    deep = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    for n, line in enumerate(lines):
        if "BroadcastExchange" not in line:
            continue
        for below, at in zip(lines[n + 1 :], deep[n + 1 :]):
            if at <= deep[n] or "Exchange hashpartitioning" in below:
                break
            if "Generate explode" in below:
                return True
    return False


def test_posted_side_is_never_broadcast(spark):
    """A few stars pass for a small table, and so would 1,000,000, whose nine postings Spark's estimate leaves out."""
    det = spark.createDataFrame([(1, 1, 0.5, 0.5)], "image_id long, number long, x_image double, y_image double")
    stars = spark.range(7, 8).selectExpr("id as star_id", "0.6e0 as cat_x", "0.5e0 as cat_y")
    near = match.range_join(det, stars, 2.0, ("x_image", "y_image"), ("cat_x", "cat_y"))
    sky = match.sky_join(det, stars, 2.0, ("x_image", "y_image"), ("cat_x", "cat_y"))
    for df in (near, sky):
        assert not broadcasts_posted(_plan(df))
        assert [r.star_id for r in df.collect()] == [7]


@pytest.mark.parametrize("name", ["a15_diagnostics", "d01_match_radius", "d02_make_pairs", "d03_filter_by_object_radius", "d04_unmatched", "d05_veto_phases", "d07_dedupe_last", "k01_classify", "k04_candidates", "d14_dynamic_maglim", "d14_match_to_limit", "d_sky_join_wrap", "e01_zeropoints", "e02_rough_zeropoint", "e03_filter_scores", "e03_zeropoints_all", "e11_astrometric_error_model", "e12_variance_model"])
def test_queries_do_not_broadcast_postings(spark, name):
    assert not broadcasts_posted(_plan(QUERIES[name](spark, SF)))


def test_pairs_are_ranked_where_they_are_joined(spark):
    """No exchange lies above the join: pairs outnumber detections, and grow with the density of stars."""
    det = spark.range(40).selectExpr("id % 3 as image_id", "id as number", "id * 0.7e0 as x_image", "id * 0.3e0 as y_image")
    stars = spark.range(60).selectExpr("id as star_id", "id * 0.5e0 as cat_x", "id * 0.2e0 as cat_y")
    for keys in ((), ("image_id",)):
        given = stars if not keys else stars.crossJoin(spark.range(3).selectExpr("id as image_id"))
        near = match.match_radius(det, given, 2.0, keys)
        lines = _plan(near).splitlines()
        join = next(n for n, x in enumerate(lines) if "SortMergeJoin" in x)
        assert not any("Exchange" in x for x in lines[:join])
        want = {}
        for d in det.collect():
            found = sorted((((d.x_image - s.cat_x) ** 2 + (d.y_image - s.cat_y) ** 2) ** 0.5, s.star_id) for s in stars.collect())
            want[d.image_id, d.number] = [i for x, i in found if x <= 2.0]
        got = {}
        for r in near.orderBy("rank").collect():
            got.setdefault((r.image_id, r.number), []).append(r.star_id)
        assert got == {k: v for k, v in want.items() if v}


def test_texts_are_split_once(spark, tmp_path):
    """Neither the filter nor the later columns of a reader split a text again."""
    (tmp_path / "x.ecsv").write_text("# %ECSV 1.0\n# ---\n# meta:\n#   JD: 1.5\nnumber\n1\n2\n")
    det, images = tables.read_ecsv(spark, str(tmp_path), {"number": "long"})
    assert [r.number for r in det.orderBy("row").collect()] == [1, 2] and images.first().jd == 1.5
    for df in (det, images):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(regexp_replace(value") == 1


@pytest.mark.parametrize("name", ["pairs", "b26_eval_response", "b28_apply_spatial", "c15_subsample"])
def test_driver_builds_no_broadcast_of_the_stars(spark, name):
    """the file of a million stars is small enough to pass for a small table."""
    df = matching.pairs(spark, SF) if name == "pairs" else QUERIES[name](spark, SF)
    joins = [x for x in _plan(df).splitlines() if "Join" in x]
    assert any("l_partkey" in x for x in joins)
    assert not any("BroadcastHashJoin" in x and ("l_partkey" in x or "true_star_id" in x) for x in joins)


def test_names_in_a_response_are_not_cast(spark):
    """a cast of a name to a number throws in Java, row by row. What can be a number is still tried."""
    values = ["Sloan_r", " SloanJ", "", "1", "-2.5", "+3", " 4 ", "1e2", ".5", "Infinity", "-inf", "inf", "nan", "Name", "1d", "0x1p3", "_1", "x1"]
    df = spark.createDataFrame([(v, f"T={v},Z=1") for v in values], "v string, response string")
    got = df.select("v", response_terms(F.col("response"))["T"].alias("t"), F.col("v").try_cast("double").alias("w"))
    assert "RLIKE" in _plan(got)
    assert [repr(r.t) for r in got.collect()] == [repr(r.w) for r in got.collect()]
    assert sum(r.t is not None for r in got.collect()) >= 11


def test_trails_are_scored_where_they_are_sorted_once(spark):
    """a join for each mean had a task hold a dozen sorted copies of its trails."""
    plan = _plan(QUERIES["k_score_trails"](spark, SF))
    assert "SortMergeJoin" not in plan and plan.count("+- Sort ") == plan.count(" Sort ") == 1
    assert "hashpartitioning(field_id" not in plan.split("BroadcastExchange")[0]


def test_scores_of_odd_trails(spark):
    """Rows of no trail count for the span only; those of no field for light and gaps, not for the motion."""
    cols = "field_id long, trail_id long, number long, jd double, ra double, dec double, mag_calib double, magerr_calib double, errx2_image double, erry2_image double, fwhm_image double"
    row = lambda field, trail, n, jd, x: (field, trail, n, jd, 150.0 + x, 20.0 - x, 15.0 + 0.1 * (n % 3), 0.01 + 0.001 * n, 0.01, 0.02, 2.0 + 0.1 * n)
    rows = [row(1, 7, n, 1.0 + 0.01 * n, 1e-5 * n * n) for n in range(5)] + [row(1, None, 9, 3.0, 0.0), row(None, 7, 10, 1.2, 0.3)]
    rows += [row(2, 8, n, 1.0 + 0.02 * n, 2e-5 * n) for n in range(2)] + [row(None, 9, n, 1.0, 0.0) for n in range(4)]
    (got,) = transients.score_trails(spark.createDataFrame(rows, cols), 10, 3, astvar=4.0).collect()
    assert got.trail_id == 7 and got.num == 5
    assert got.max_gap == pytest.approx(0.16 * 24)
    light = [(r[6], r[7] ** -2) for r in rows if r[1] == 7]
    assert len(light) == 6 and got.mag0 == pytest.approx(sum(m * w for m, w in light) / sum(w for _, w in light))
    assert got.a0 == pytest.approx(150.0 - 2e-5 + 4e-5 * 100, rel=1e-9) and got.da == pytest.approx(4e-5 / 0.24 * 3600)
    assert got.dpos == pytest.approx(4e-5 / 0.24 * 3600 * 48.0 * (1 + 0.8830) ** 0.5, rel=1e-3)


def test_subsample_sorts_bytes(spark):
    """digests are not sorted as text, and the rows are those of the text's order."""
    det = spark.range(4000).selectExpr("id % 7 as image_id", "id as number").union(spark.createDataFrame([(None, 1), (3, None)], "image_id long, number long"))
    found = filters.subsample(det, 20, 7)
    sorts = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "md5(" in x]
    assert sorts and all("unhex(md5(" in x for x in sorts)
    text = det.selectExpr("*", "row_number() over (partition by image_id order by md5(concat_ws('/', image_id, number, '7')), number) as r")
    assert sorted(map(str, found.collect())) == sorted(map(str, text.where("r <= 20").drop("r").collect())) and found.count() == 141


def test_whole_detections_are_dealt_and_sorted_once(spark):
    """two shuffles and two sorts of all rows came before the join with the stars."""
    dealt, plain = view(spark, SF, "fx_det", BY_STAR), view(spark, SF, "fx_det")
    plan = _plan(dealt)
    assert plan.count("Exchange ") == 2 and plan.count(" Sort ") == 1 and "ShuffledHashJoin" in plan
    assert _plan(plain).count("Exchange ") == 3 and dealt.columns == plain.columns
    assert dealt.exceptAll(plain).isEmpty() and dealt.count() == plain.count() > 0


def test_zeropoints_of_all_filters_move_pairs_once(spark):
    """a row for each pair and filter was shuffled, and again for each join with a median."""
    r = random.Random(8)
    rows = [(n % 9 if n % 50 else None, None if n % 31 == 0 else r.gauss(0, 1), r.gauss(20, 1), None if n % 9 == 4 or n % 7 == 0 else r.gauss(21, 1)) for n in range(400)]
    rows += [(100, float(n), 20.0, 20.0 + n) for n in range(4)] + [(101, 1.0 * n, 5.0, n + 0.01 * n * n) for n in range(8)]
    rows += [(102, float(n), float("nan"), 1.0 + n) for n in range(6)]
    pairs = spark.createDataFrame(rows, "image_id long, mag_auto double, g double, r double")
    found = calib.zeropoints_all(pairs, ["g", "r"])
    assert _plan(found).count("Exchange ") == 1
    got = {(x.image_id, x.filter): x for x in found.collect()}
    want = {(i, f) for i, _, g, c in rows for f, v in (("g", g), ("r", c)) if v is not None}
    assert set(got) == want and got[4, "g"].n == sum(x[0] == 4 for x in rows)
    for i in range(9):
        for f, at in (("g", 2), ("r", 3)):
            all_ = [x for x in rows if x[0] == i and x[at] is not None]
            if not all_:
                continue
            seen = [x for x in all_ if x[1] is not None]
            z = statistics.median(x[at] - x[1] for x in seen)
            mad = statistics.median(abs(x[at] - x[1] - z) for x in seen)
            good = [x for x in seen if abs(x[at] - x[1] - z) < 3 * mad]
            assert got[i, f].n == len(all_) and got[i, f].zeropoint == pytest.approx(z)
            assert got[i, f].correlation == pytest.approx(statistics.correlation([x[at] for x in good], [x[1] for x in good]))
    assert got[100, "r"].correlation == 0 and got[101, "g"].correlation == 0 and got[101, "r"].correlation > 0.99
    assert all(got[102, f].correlation == pytest.approx(c) for f, c in (("g", 0), ("r", 0))) and got[None, "g"].correlation == 0


def test_all_ranks_without_a_sort_of_pairs(spark):
    """all pairs were sorted for their ranks. Now rows of the sides are sorted alone, and ranks are those of a match."""
    r = random.Random(3)
    det = [(n % 4 if n % 41 else None, n if n % 37 else None, r.choice([r.uniform(-9, 9), 2.0]), r.choice([r.uniform(-9, 9), -2.0])) for n in range(150)]
    det += [(1, 900, None, 1.0), (1, 901, float("nan"), 1.0), (2, 902, float("inf"), 1.0), (2, 903, 500.0, 1.0)]
    stars = [(n % 4 if n % 29 else None, n, r.choice([r.uniform(-9, 9), 0.0, 4.0]), r.choice([r.uniform(-9, 9), -4.0, 0.0])) for n in range(220)] + [(1, 950, None, 0.0)]
    det = spark.createDataFrame(det, "image_id long, number long, x_image double, y_image double")
    own = spark.createDataFrame(stars, "image_id long, star_id long, cat_x double, cat_y double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "33")
    old, match.DISTANCES = match.DISTANCES, 500
    try:
        for keys, given in (((), own.drop("image_id")), (("image_id",), own)):
            found = match.neighbours(det, given, 3.0, keys)
            sides = [x for x in _plan(found).splitlines() if " Sort " in x]
            assert len(sides) == 1 and "dist" not in sides[0] and "Join" not in _plan(found)
            # A match ranks the rows of equal ids together, so ids without null are compared.
            want = match.match_radius(det.where("image_id is not null and number is not null"), given, 3.0, keys)
            got = sorted(tuple(x) for x in found.where("image_id is not null and number is not null").select("image_id", "number", "star_id", "dist", "rank").collect())
            assert got == sorted(tuple(x) for x in want.select("image_id", "number", "star_id", "dist", "rank").collect()) and len(got) > 500
            assert found.where("image_id is null").isEmpty() == bool(keys) and not found.where("number is null").isEmpty()
            assert any(a[:2] == b[:2] and a[3] == b[3] for a, b in zip(got, got[1:]))
    finally:
        match.DISTANCES = old
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
