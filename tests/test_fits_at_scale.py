"""Exact quantiles without gathering a column, and trial fits that are clipped one by one."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyloom.operators import astrometry, fit
from skyloom.operators.quantile import exact_quantile


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(4)


@pytest.mark.parametrize("kind", ["plain", "ties", "two", "wide", "nan", "infinite"])
def test_quantiles_equal_percentile(spark, kind):
    r = random.Random(4)
    values = {
        "plain": [r.gauss(0, 1) for _ in range(5001)],
        "ties": [3.0] * 2000 + [r.random() for _ in range(3000)] + [3.0] * 7,
        "two": [0.0] * 2500 + [1.0] * 2500,
        "wide": [r.choice([-1, 1]) * 10.0 ** r.uniform(-300, 300) for _ in range(4000)],
        "nan": [float("nan")] * 1500 + [r.random() for _ in range(1501)] + [None] * 40,
        "infinite": [float("inf")] * 900 + [float("-inf")] * 900 + [r.random() for _ in range(500)],
    }[kind]
    df = column(spark, values)
    for p in (0.0, 0.1, 0.25, 0.5, 0.73, 0.999, 1.0):
        got, want = exact_quantile(df, F.col("x"), p, few=20), df.agg(F.percentile("x", p)).first()[0]
        assert got == want or (got != got and want != want) or abs(got - want) <= 1e-12 * abs(want), (kind, p)


def test_quantiles_of_few_values(spark):
    assert exact_quantile(column(spark, []), F.col("x")) is None
    assert exact_quantile(column(spark, [None]), F.col("x")) is None
    assert exact_quantile(column(spark, [2.5]), F.col("x"), 0.3) == 2.5
    assert exact_quantile(column(spark, [1.0, 2.0]), F.col("x")) == 1.5


def test_fits_have_no_global_percentile(spark):
    """The scatter comes from counts: no plan of a fit holds an aggregate that keeps all residuals."""
    r = random.Random(2)
    rows = [(n % 7, r.random(), r.random(), 15 + r.gauss(0, 0.1), 0.1) for n in range(600)]
    pairs = spark.createDataFrame(rows, "image_id long, coord_x double, coord_y double, mag_auto double, dy double").withColumn("cat_mag", F.col("mag_auto") + 20 + 0.3 * F.col("coord_x"))
    found = fit.fit_photometry(pairs, ["Z", "PX"])
    assert abs(found.values["Z"] - 20) < 1e-9 and abs(found.values["PX"] - 0.3) < 1e-9 and found.sigma < 1e-9
    import inspect

    assert "median(" not in inspect.getsource(fit)


def test_stepwise_trials_are_clipped_one_by_one(spark):
    """A few far outliers hide a weak term from a test on all rows, and lend a term that follows them what it lacks."""
    r = random.Random(6)
    rows = []
    for n in range(2000):
        x, y = r.uniform(-1, 1), r.uniform(-1, 1)
        t = 20 + 0.05 * x * x + r.gauss(0, 0.01) + (r.choice([-9.0, 9.0]) if n % 40 == 0 else 0)
        rows.append((n % 5, x, y, 0.0, t, 0.01))
    pairs = spark.createDataFrame(rows, "image_id long, coord_x double, coord_y double, mag_auto double, cat_mag double, dy double")
    found, terms = fit.stepwise(pairs, ["PX", "PY", "P2X", "PXY", "P2Y"], ["Z"], alpha=1e-6)
    assert terms == ["Z", "P2X"] and abs(found.values["P2X"] - 0.05) < 0.005 and found.wssrndf < 2


def test_projection_trials_leave_their_outliers_out(spark):
    rng = np.random.default_rng(3)
    n = 300
    ra, dec = 150 + rng.uniform(-3, 3, n), 20 + rng.uniform(-3, 3, n)
    wcs = {"crval1": 150.0, "crval2": 20.0, "crpix1": 1000.0, "crpix2": 1000.0, "cd1_1": -0.003, "cd1_2": 0.0, "cd2_1": 0.0, "cd2_2": 0.003}
    parts, images = [], []
    for image, proj in enumerate(["TAN", "ZEA"]):
        x, y = astrometry.project(wcs, proj, ra, dec)
        far = 1 + 0.04 * (np.arange(n) % 10 == 0) * np.hypot(x - 1000, y - 1000) / 1000
        parts.append(pd.DataFrame({"image_id": image, "radeg": ra, "decdeg": dec, "x_image": 1000 + (x - 1000) * far + rng.normal(0, 0.05, n), "y_image": 1000 + (y - 1000) * far + rng.normal(0, 0.05, n), "image_dxy": 0.05}))
        images.append({"image_id": image, **wcs, "crval1": 150.01})
    out = astrometry.select_projection(spark.createDataFrame(pd.concat(parts)), spark.createDataFrame(pd.DataFrame(images)), ("TAN", "ZEA"))
    got = {r.image_id: r for r in out.collect()}
    assert {i: r.proj for i, r in got.items()} == {0: "TAN", 1: "ZEA"}
    assert all(abs(r.crval1 - 150) < 1e-3 and r.astwssr < 5 for r in got.values())


def test_projections_of_many_images_in_one_block(spark):
    """Images of few pairs are fitted together, not in a call each: each comes out as from its own steps, whatever the
    batches cut; an image without a start value and one with too few pairs keep theirs."""
    rng = np.random.default_rng(5)
    wcs = {"crval1": 150.0, "crval2": 20.0, "crpix1": 1000.0, "crpix2": 1000.0, "cd1_1": -0.003, "cd1_2": 0.0, "cd2_1": 0.0, "cd2_2": 0.003}
    parts, images = [], []
    for image in range(60):
        n = 2 if image == 7 else 12 + image % 9
        ra, dec = 150 + rng.uniform(-3, 3, n), 20 + rng.uniform(-3, 3, n)
        x, y = astrometry.project(wcs, "TAN", ra, dec)
        dxy = rng.uniform(0.05, 0.3, n)
        parts.append(pd.DataFrame({"image_id": image, "radeg": ra, "decdeg": dec, "x_image": x + rng.normal(0, 1, n) * dxy, "y_image": y + rng.normal(0, 1, n) * dxy, "image_dxy": dxy}))
        images.append({"image_id": image, **wcs, "crval1": 150 + 1e-3 * image, "cd1_1": None if image == 5 else -0.003})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        pairs = spark.createDataFrame(pd.concat(parts))
        out = astrometry.fit_astrometry(pairs, spark.createDataFrame(images, "image_id long, " + ", ".join(f"{c} double" for c in wcs)), steps=3, robust=True)
        got = {r.image_id: r for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()
    assert got[5].astchi2 is None and got[7].astchi2 is None and got[7].crval1 == 150.007
    for image in set(range(60)) - {5, 7}:
        p = {k: v for k, v in images[image].items() if k != "image_id"}
        for _ in range(3):
            a, b, *_ = astrometry.normal(parts[image], p, astrometry.LINEAR, "TAN", True)
            p |= {c: p[c] + v for c, v in zip(astrometry.LINEAR, fit.solve(a, b)[0])}
        _, _, chi2, rx, ry = astrometry.normal(parts[image], p, [], "TAN", False)
        r = got[image]
        assert all(abs(r[c] - p[c]) < 1e-9 for c in astrometry.LINEAR) and abs(r.astchi2 - chi2) < 1e-6 * chi2 and r.astndf == 2 * len(rx) - 6
        assert abs(r.astwssr - chi2 / r.astndf) < 1e-6 and abs(r.astscatt - np.median(np.hypot(rx, ry)) / 0.67) < 1e-6


def test_projections_are_chosen_for_many_images_at_once(spark):
    """each image was a call of Python with some thousand small steps. Images of a batch are fitted together, and what
    one comes out as does not hang on the others."""
    rng = np.random.default_rng(9)
    wcs = {"crval1": 150.0, "crval2": 20.0, "crpix1": 1000.0, "crpix2": 1000.0, "cd1_1": -0.003, "cd1_2": 0.0, "cd2_1": 0.0, "cd2_2": 0.003}
    kinds, pv = ("TAN", "ZEA", "AZP", "ZPN"), {"AZP": {"pv2_1": 0.5}, "ZPN": {"pv2_3": 1.0}}
    parts, images = [], []
    for image in range(24):
        n = 4 if image == 9 else 200 if image == 10 else 30 + image % 7
        ra, dec = 150 + rng.uniform(-3, 3, n), 20 + rng.uniform(-3, 3, n)
        x, y = astrometry.project({**wcs, **pv.get(kinds[image % 4], {})}, kinds[image % 4], ra, dec)
        x[0] += 40.0 * (image % 3 == 1 and image % 4 != 2)
        parts.append(pd.DataFrame({"image_id": image, "radeg": ra, "decdeg": dec, "x_image": x, "y_image": y, "image_dxy": 0.1}))
        images.append({"image_id": image, **wcs, "crval1": 150.01, "cd1_1": None if image == 5 else -0.003003})
    given = spark.createDataFrame(images, "image_id long, " + ", ".join(f"{c} double" for c in wcs))
    params = [*astrometry.LINEAR, "crpix1", "crpix2"]
    choose = lambda rows: astrometry.select_projection(spark.createDataFrame(rows), given, kinds, params)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    try:
        out = choose(pd.concat(parts))
        got = {r.image_id: r for r in out.collect()}
        alone = {r.image_id: r for r in choose(parts[13]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()
    assert got[5].proj is None and got[9].proj is None and got[9].crval1 == 150.01
    for image in set(range(24)) - {5, 9}:
        r = got[image]
        assert r.proj == kinds[image % 4] and abs(r.crval1 - 150) < 1e-5 and abs(r.crpix1 - 1000) < 1e-6, image
        assert r.astndf == 2 * (len(parts[image]) - (image % 3 == 1 and image % 4 != 2)) - 6 - (image % 4 >= 2)
        assert r.pv2_1 == {2: pytest.approx(0.5), 3: 1.0}.get(image % 4) and (r.pv2_3 == pytest.approx(1.0) if image % 4 == 3 else r.pv2_3 is None)
    assert alone[13].proj == got[13].proj and alone[13].astndf == got[13].astndf and abs(alone[13].cd1_1 - got[13].cd1_1) < 1e-12


@pytest.mark.parametrize("proj", ["TAN", "ZEA", "AZP", "ZPN"])
def test_derivatives_of_projections(proj):
    """Those of a block equal differences of ``project``, a star at the pole of the projection included."""
    rng = np.random.default_rng(1)
    p = {"crval1": 149.0, "crval2": -35.0, "crpix1": 900.0, "crpix2": 1100.0, "cd1_1": -0.003, "cd1_2": 2e-4, "cd2_1": 1e-4, "cd2_2": 0.0029, "pv2_1": 0.7, "pv2_2": 0.0 if proj == "ZPN" else 2.0, "pv2_3": 0.4, "pv2_5": -0.2}
    ra, dec = np.append(149 + rng.uniform(-4, 4, 30), 149.0), np.append(-35 + rng.uniform(-4, 4, 30), -35.0)
    pdf = pd.DataFrame({"radeg": ra, "decdeg": dec, "x_image": 1000.0, "y_image": 1000.0, "image_dxy": 0.5})
    params = [*astrometry.WCS, *{"AZP": ["pv2_1"], "ZPN": ["pv2_3", "pv2_5"]}.get(proj, [])]
    block = astrometry._Images(pdf, np.array([31]), 1, 0.05)
    r, j = block._residuals(np.array([0]), np.array([[p.get(c, 0.0) for c in astrometry.NAMES]]), proj, params)
    _, _, _, rx, ry = astrometry.normal(pdf, p, [], proj, False)
    assert np.allclose(r[0], [rx, ry], rtol=0, atol=1e-5) and np.isfinite(j).all()
    a = astrometry.normal(pdf[:30], p, params, proj, False)[0]  # differences are too coarse at the pole
    size, j = np.sqrt(np.diag(a)), j[..., :30]
    assert np.allclose(np.einsum("iam,jam->ij", j[:, 0], j[:, 0]) * 4 / np.outer(size, size), a / np.outer(size, size), atol=1e-6)
