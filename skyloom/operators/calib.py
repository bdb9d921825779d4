"""Zeropoints, filter choice, limits, radii and error models per image."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def zeropoints(pairs: DataFrame, images: DataFrame, mag: str = "cat_mag") -> DataFrame:
    """(image_id, zeropoint, n): median of catalogue less observed magnitude, 0 for an image without pairs."""
    z = pairs.groupBy("image_id").agg(F.median(F.col(mag) - F.col("mag_auto")).alias("z"), F.count(F.lit(1)).alias("c"))
    return images.select("image_id").join(z, "image_id", "left").select("image_id", F.coalesce("z", F.lit(0.0)).alias("zeropoint"), F.coalesce("c", F.lit(0)).alias("n"))


def rough_zeropoint(pairs: DataFrame, images: DataFrame, mag: str = "cat_mag") -> DataFrame:
    """(image_id, zeropoint) of the pairs brighter than the image's 30th percentile; 0 without any."""
    limit = pairs.groupBy("image_id").agg(F.percentile("mag_auto", 0.3).alias("_p"))
    z = pairs.join(limit, "image_id").where(F.col("mag_auto") < F.col("_p")).groupBy("image_id").agg(F.median(F.col(mag) - F.col("mag_auto")).alias("z"))
    return images.select("image_id").join(z, "image_id", "left").select("image_id", F.coalesce("z", F.lit(0.0)).alias("zeropoint"))


def zeropoints_all(pairs: DataFrame, filters: list[str]) -> DataFrame:
    """(image_id, filter, zeropoint, n, correlation) for every candidate filter: the correlation of the stars
    within 3 MAD of the median difference, 0 for fewer than 5 stars (before or after), where it is undefined and for
    rows of no image.

    An image's pairs are brought together once, with a column for each filter, and all steps are windows and sums there:
    only the results, a row an image, are turned to rows by filter."""
    image = Window.partitionBy("image_id")
    rows = pairs.select("image_id", F.col("mag_auto").alias("_m"), *[F.col(f).alias(f"_c{k}") for k, f in enumerate(filters)])
    d, off = ({k: F.col(c.format(k)) for k in range(len(filters))} for c in ("_d{}", "_o{}"))
    rows = rows.withColumns({f"_d{k}": F.col(f"_c{k}") - F.col("_m") for k in d})
    rows = rows.withColumns({f"_z{k}": F.median(d[k]).over(image) for k in d})
    rows = rows.withColumns({f"_o{k}": F.abs(d[k] - F.col(f"_z{k}")) for k in d})
    rows = rows.withColumns({f"_a{k}": F.median(off[k]).over(image) for k in d})
    sums = []
    for k in d:
        good = off[k] < 3 * F.col(f"_a{k}")
        c, m = (F.when(good, F.col(x)) for x in (f"_c{k}", "_m"))
        correlation = F.try_divide(F.covar_pop(c, m), F.stddev_pop(c) * F.stddev_pop(m))  # corr itself fails where one of them is constant
        sums += [F.first(f"_z{k}").alias(f"z{k}"), F.count(f"_c{k}").alias(f"n{k}"), F.count_if(good).alias(f"k{k}"), correlation.alias(f"r{k}")]
    found = rows.groupBy("image_id").agg(*sums)
    value = lambda k: F.when(F.col("image_id").isNotNull() & (F.col(f"n{k}") >= 5) & (F.col(f"k{k}") >= 5), F.coalesce(F.nanvl(f"r{k}", F.lit(0.0)), F.lit(0.0))).otherwise(F.lit(0.0))
    each = F.array(*[F.struct(F.lit(f).alias("filter"), F.col(f"z{k}").alias("zeropoint"), F.col(f"n{k}").alias("n"), value(k).alias("correlation")) for k, f in enumerate(filters)])
    return found.select("image_id", F.inline(each)).where("n > 0")


def filter_scores(per_image: DataFrame) -> DataFrame:
    """(filter, score, n_images, total_stars): mean of the positive correlations, 0 without any."""
    positive = F.when(F.col("correlation") > 0, F.col("correlation"))
    return per_image.groupBy("filter").agg(F.coalesce(F.avg(positive), F.lit(0.0)).alias("score"), F.count(positive).alias("n_images"), F.sum("n").alias("total_stars"))


def decide_filter(scores: DataFrame, header_filter: str, mode: str = "none") -> str:
    """The filter to use: ``none`` and ``warn`` the header's, ``discover`` the best, ``strict`` raises where the two
    differ. Ties: the name that sorts first. Scores have one row per filter."""
    best = scores.orderBy(F.desc("score"), "filter").first()["filter"] if mode != "none" else header_filter
    if mode == "strict" and best != header_filter:
        raise ValueError(f"filter mismatch: header {header_filter}, best {best}")
    return best if mode == "discover" else header_filter


def filter_consistency(images: DataFrame, column: str = "filter") -> DataFrame:
    """(filter, n, n_filters, mixed): images per filter, and whether there is more than one."""
    n = images.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.count(F.lit(1)).alias("n_filters"))
    return n.join(F.broadcast(total)).withColumn("mixed", F.col("n_filters") > 1)  # one row


def image_fwhm(det: DataFrame, images: DataFrame, border: float = 32, least: int = 30) -> DataFrame:
    """(image_id, image_fwhm): median of inner rows with an error below 1.091 / 10 if there are ``least``, else of
    the 30 brightest inner rows if there are 30 inner rows, else of all rows."""
    rows = det.join(images.select("image_id", "imgaxis1", "imgaxis2"), "image_id")
    inner = (F.col("x_image") > border) & (F.col("y_image") > border) & (F.col("x_image") < F.col("imgaxis1") - border) & (F.col("y_image") < F.col("imgaxis2") - border)
    rows = rows.withColumn("_inner", inner)
    rank = F.row_number().over(Window.partitionBy("image_id", "_inner").orderBy("mag_auto", "number"))
    rows = rows.withColumns({"_good": F.col("_inner") & (F.col("magerr_auto") < 1.091 / 10), "_bright": F.col("_inner") & (rank <= 30)})
    medians = rows.groupBy("image_id").agg(
        F.count_if("_good").alias("g"), F.count_if("_inner").alias("k"),
        F.median(F.when(F.col("_good"), F.col("fwhm_image"))).alias("a"), F.median(F.when(F.col("_bright"), F.col("fwhm_image"))).alias("b"), F.median("fwhm_image").alias("c"),
    )
    return medians.select("image_id", F.coalesce(F.when(F.col("g") >= least, F.col("a")), F.when(F.col("k") >= 30, F.col("b")), F.col("c")).alias("image_fwhm"))


def background_stats(pixels: DataFrame) -> DataFrame:
    """(image_id, bgsigma, bgmedian): 1.0489 times the median over rows of the median absolute difference to
    the next row, and the median pixel."""
    below = F.lead("value").over(Window.partitionBy("image_id", "x").orderBy("y"))
    rows = pixels.withColumn("d", F.abs(F.col("value") - below)).groupBy("image_id", "y").agg(F.median("d").alias("d"))
    sigma = rows.groupBy("image_id").agg((1.0489 * F.median("d")).alias("bgsigma"))
    return sigma.join(pixels.groupBy("image_id").agg(F.median("value").alias("bgmedian")), "image_id")


def limiting_mag(det: DataFrame, steps: int = 25) -> DataFrame:
    """(image_id, limflx3, limflx10, dlimflx3): robust line log10(err * ln(2.5) * 3) = (mag - L1) / Q over rows
    with an error of at least 0.001; images with fewer than 3 have none.

    Iteratively reweighted sums: with a = 1/Q and b = -L1/Q the line is linear, and each step is one aggregate per
    image; the weight of the Cauchy loss is 1 / (1 + r^2). Starts from the unweighted line.
    """
    rows = det.where((F.col("magerr_auto") >= 0.001) & ~F.isnan("mag_auto")).select("image_id", F.col("mag_auto").alias("x"), F.log10(F.col("magerr_auto") * math.log(2.5) * 3).alias("t"))
    rows = rows.where("x is not null and t is not null")

    # One image's rows are bounded by what an image holds; all steps run where they are.
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        x, t = pdf["x"].to_numpy(), pdf["t"].to_numpy()
        if len(x) < 3 or np.ptp(x) == 0:
            return pd.DataFrame({"image_id": [], "limflx3": [], "limflx10": [], "dlimflx3": []})
        w, a, b = np.ones(len(x)), 0.0, 0.0
        for _ in range(steps):
            sw, mx, mt = w.sum(), np.average(x, weights=w), np.average(t, weights=w)
            a = (w * (x - mx) * (t - mt)).sum() / (w * (x - mx) ** 2).sum()
            b = mt - a * mx
            w = 1 / (1 + (t - a * x - b) ** 2)
        q, l1 = 1 / a, -b / a
        j = np.stack([np.full(len(x), 1 / q), (x - l1) / q**2], 1) * np.sqrt(w)[:, None]
        error = math.sqrt(abs(np.linalg.pinv(j.T @ j)[0, 0]))
        return pd.DataFrame({"image_id": [pdf["image_id"].iloc[0]], "limflx3": [l1], "limflx10": [l1 + q * math.log10(1.091 / 10)], "dlimflx3": [error]})

    return rows.groupBy("image_id").applyInPandas(solve, "image_id long, limflx3 double, limflx10 double, dlimflx3 double")


def robust_sigma(c: Column) -> Column:
    """Median absolute value over 0.67, an aggregate."""
    return F.median(F.abs(c)) / 0.67


def astrometric_error_model(pairs: DataFrame) -> DataFrame:
    """(image_id, astsigma, astvar, scatter) of residual^2 = S0 + SC * image_var: rows in order of variance in at
    most 10 equal bins (n / 5), medians per bin, SC the median slope between bins (at least 0), S0 the median rest (at
    least 0). Fewer than 10 rows: S0 the median square, astvar 1."""
    rows = pairs.select("image_id", (F.col("dist") * F.col("dist")).alias("r2"), F.col("image_var").alias("c2"), "dist", "number")
    w = Window.partitionBy("image_id")
    rows = rows.withColumns({"n": F.count(F.lit(1)).over(w), "i": F.row_number().over(w.orderBy("c2", "number")) - 1})
    bins = F.least(F.lit(10), F.expr("n div 5"))
    # Equal bins: the first n mod k of them have one row more.
    size, more = F.expr("n div k"), F.expr("n % k")
    rows = rows.withColumn("k", F.greatest(bins, F.lit(1))).withColumns({"s": size, "m": more})
    b = F.when(F.col("i") < F.col("m") * (F.col("s") + 1), F.expr("i div (s + 1)")).otherwise(F.expr("m + (i - m * (s + 1)) div s"))
    medians = rows.withColumn("b", b).groupBy("image_id", "b").agg(F.median("r2").alias("r"), F.median("c2").alias("c"))
    other = medians.select("image_id", F.col("b").alias("b2"), F.col("r").alias("r_2"), F.col("c").alias("c_2"))
    slope = F.when(F.abs(F.col("c_2") - F.col("c")) > 1e-12, F.try_divide(F.col("r_2") - F.col("r"), F.col("c_2") - F.col("c")))
    slopes = medians.join(other, "image_id").where("b < b2").groupBy("image_id").agg(F.median(slope).alias("sc"))
    found = medians.join(slopes, "image_id", "left").withColumn("sc", F.greatest(F.coalesce("sc", F.lit(0.0)), F.lit(0.0)))
    found = found.groupBy("image_id").agg(F.first("sc").alias("sc"), F.greatest(F.median(F.col("r") - F.col("sc") * F.col("c")), F.lit(0.0)).alias("s0"))
    every = rows.groupBy("image_id").agg(F.max("n").alias("n"), F.median("r2").alias("mid"), robust_sigma(F.col("dist")).alias("scatter"))
    few = F.col("n") < 10
    return every.join(found, "image_id").select("image_id", F.sqrt(F.when(few, F.greatest("mid", F.lit(0.0))).otherwise(F.col("s0"))).alias("astsigma"), F.when(few, 1.0).otherwise(F.col("sc")).alias("astvar"), "scatter")


def variance_model(pairs: DataFrame, centre: float = 0.5) -> DataFrame:
    """(image_id, s0, sc, sr, c0) of residual^2 = S0 + SC * (c - c0)^2 + SR * radius on bin medians: rows in order
    of c = image_var in bins of max(10, n / 19) rows; c0 is the median c; SC = 25 and a refit of the others where its
    size is above 1000. Coefficients by weighted sums (a bin weighs its rows)."""
    w = Window.partitionBy("image_id")
    radius = F.hypot(F.col("coord_x"), F.col("coord_y"))
    rows = pairs.select("image_id", "number", (F.col("dist") * F.col("dist")).alias("t"), F.col("image_var").alias("c"), radius.alias("r"))
    rows = rows.withColumns({"n": F.count(F.lit(1)).over(w), "i": F.row_number().over(w.orderBy("c", "number")) - 1, "c0": F.percentile("c", centre).over(w)})
    bins = rows.withColumn("b", F.expr("i div greatest(10, n div 19)")).groupBy("image_id", "b").agg(F.median("t").alias("t"), F.median("c").alias("c"), F.median("r").alias("r"), F.first("c0").alias("c0"), F.count(F.lit(1)).alias("w"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.ones(len(pdf)), (pdf["c"] - pdf["c0"]) ** 2, pdf["r"]], 1)
        t, weight = pdf["t"].to_numpy(), np.sqrt(pdf["w"].to_numpy())
        beta = np.linalg.lstsq(x * weight[:, None], t * weight, rcond=1e-10)[0]
        if abs(beta[1]) > 1000:
            rest = np.linalg.lstsq(x[:, [0, 2]] * weight[:, None], (t - 25 * x[:, 1]) * weight, rcond=1e-10)[0]
            beta = np.array([rest[0], 25.0, rest[1]])
        return pd.DataFrame({"image_id": [pdf["image_id"].iloc[0]], "s0": [beta[0]], "sc": [beta[1]], "sr": [beta[2]], "c0": [pdf["c0"].iloc[0]]})

    return bins.groupBy("image_id").applyInPandas(solve, "image_id long, s0 double, sc double, sr double, c0 double")  # at most 20 bins


def predict_sigma(df: DataFrame, model: DataFrame) -> DataFrame:
    """Adds sigma of the variance model, 0 where the modelled variance is negative."""
    v = F.col("s0") + F.col("sc") * F.pow(F.col("image_var") - F.col("c0"), F.lit(2)) + F.col("sr") * F.hypot(F.col("coord_x"), F.col("coord_y"))
    return df.join(model, "image_id").withColumn("sigma", F.sqrt(F.greatest(v, F.lit(0.0)))).drop("s0", "sc", "sr", "c0")


def class_summary(classified: DataFrame, types: tuple[str, ...] = ("uncatalogued", "poor_fwhm", "brighter", "fainter", "normal")) -> DataFrame:
    """Number of objects of each class per image."""
    return classified.groupBy("image_id").agg(*[F.count_if(F.col("type") == t).alias(t) for t in types], F.count(F.lit(1)).alias("total"))


def sort_by_mag(df: DataFrame, band: str, key: str = "star_id") -> DataFrame:
    """Rows in order of a magnitude, ties by key."""
    return df.orderBy(band, key)


def sort_by_number(det: DataFrame) -> DataFrame:
    """Detections in order of image and number."""
    return det.orderBy("image_id", "number")


def stack(*frames: DataFrame) -> DataFrame:
    """Tables with differing columns as one; missing columns are null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def missing_filters(df: DataFrame, required: str = "required", available: str = "available") -> DataFrame:
    """Adds missing_filters, required less available."""
    return df.withColumn("missing_filters", F.array_except(required, available))


def drop_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key columns are not among ``keys``."""
    return df.join(keys, keys.columns, "left_anti")
