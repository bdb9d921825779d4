"""The three ways through the library: calibrate images, find transients, stack images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import calib, fit, match, stack, transients
from ..staging import staged


def calibrate_images(det: DataFrame, stars: DataFrame, images: DataFrame, r: float = 2.0) -> dict[str, DataFrame]:
    """Match, zeropoint per image, calibrated magnitudes and their scatter: pairs, zeropoints, calibrated, scatter."""
    pairs = match.make_pairs(det, stars, images, r)
    mags = staged(pairs.select("image_id", "cat_mag", "mag_auto"), "magnitudes")  # read twice below
    zero = calib.zeropoints(mags, images)
    model = zero.select("image_id", F.col("zeropoint").alias("magzero"), F.lit(0.0).alias("dmagzero"))
    calibrated = fit.calibrate(det, images, model)
    rest = mags.join(zero.select("image_id", "zeropoint"), "image_id").withColumn("residual", F.col("cat_mag") - F.col("mag_auto") - F.col("zeropoint"))
    scatter = rest.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_pairs"), F.first("zeropoint").alias("zeropoint"), calib.robust_sigma(F.col("residual")).alias("sigma"))
    return {"pairs": pairs, "zeropoints": zero, "calibrated": calibrated, "scatter": scatter}


def find_transients(det: DataFrame, stars: DataFrame, images: DataFrame, cat2: DataFrame | None = None, r: float = 2.0, siglim: float = 5.0, limit: float = 20.0, n_images: int | None = None, min_found: int = 3) -> dict[str, DataFrame]:
    """Candidates, trails and scores of calibrated detections with sky positions (alpha_j2000, delta_j2000)."""
    pairs = match.range_join(det, stars, r, ("x_image", "y_image"), ("cat_x", "cat_y"))
    cand = transients.candidates(det, pairs, images, cat2, siglim, limit=limit, phases=match.default_phases(r))
    rows = cand.join(images.select("image_id", "field_id", "jd", "exptime"), "image_id").withColumnsRenamed({"alpha_j2000": "ra", "delta_j2000": "dec"})
    trails = transients.link_trails(rows)
    trails = trails.withColumn("trail_id", F.concat_ws("-", "field_id", "trail_id"))
    scores = transients.score_trails(trails, n_images if n_images is not None else images.count(), min_found)
    return {"candidates": cand, "trails": trails, "scores": scores}


def stack_images(pixels: DataFrame, images: DataFrame, gain: float = 2.3, mag0: float = 15.0) -> dict[str, DataFrame]:
    """Selection by position, noise and weights per image, coadded pixels."""
    chosen = stack.cluster_images(images).where("valid").drop("nn", "threshold", "valid")
    noise = calib.background_stats(pixels).select("image_id", F.col("bgsigma").alias("_bg"))
    weighted = stack.stack_weights(chosen.join(noise, "image_id").withColumn("bgsigma", F.col("_bg")).drop("_bg"), gain, mag0=mag0)
    return {"images": weighted, "coadd": stack.coadd(pixels, weighted)}
