"""Predicates on the sky, on magnitudes and on image metadata; sky tiles that a field touches."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.astrom import clamp, pix2world, separation, world2pix


def _unit(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    a, d = F.radians(ra), F.radians(dec)
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def _dot(a, b) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def _frame(ra0: Column, dec0: Column):
    """Pointing, unit vector to the east and unit vector to the north of it."""
    a, d = F.radians(ra0), F.radians(dec0)
    return _unit(ra0, dec0), (-F.sin(a), F.cos(a), F.lit(0.0)), (-F.sin(d) * F.cos(a), -F.sin(d) * F.sin(a), F.cos(d))


def rect_condition(ra: Column, dec: Column, ra0: Column, dec0: Column, da: Column, dd: Column) -> Column:
    p = _unit(ra, dec)
    pointing, east, north = _frame(ra0, dec0)
    return (F.abs(_dot(p, east)) <= F.sin(F.radians(da))) & (F.abs(_dot(p, north)) <= F.sin(F.radians(dd))) & (_dot(p, pointing) >= 0)


def in_rect(df: DataFrame, ra0: float, dec0: float, da: float, dd: float, ra: str = "radeg", dec: str = "decdeg") -> DataFrame:
    """Rows within da, dd degrees of arc of a pointing, along and across the great circle to the north."""
    return df.where(rect_condition(F.col(ra), F.col(dec), F.lit(ra0), F.lit(dec0), F.lit(da), F.lit(dd)))


def in_circle(df: DataFrame, ra0: float, dec0: float, r: float, ra: str = "radeg", dec: str = "decdeg") -> DataFrame:
    """Rows whose unit vector's product with the pointing is at least cos r."""
    return df.where(_dot(_unit(F.col(ra), F.col(dec)), _unit(F.lit(ra0), F.lit(dec0))) >= math.cos(math.radians(r)))


def in_box(df: DataFrame, ra0: float, dec0: float, width: float, height: float, ra: str = "radeg", dec: str = "decdeg") -> DataFrame:
    """Rows of a box of ``width`` (divided by cos dec0) by ``height`` degrees; RA wraps around at 0."""
    half, cos0 = width / 2, math.cos(math.radians(dec0))
    box = F.col(dec).between(dec0 - height / 2, dec0 + height / 2)
    if half < 180 * cos0:
        lo, hi = (ra0 - half / cos0) % 360, (ra0 + half / cos0) % 360
        x = F.col(ra) - 360.0 * F.floor(F.col(ra) / 360.0)
        box = box & (x.between(lo, hi) if lo <= hi else (x >= lo) | (x <= hi))
    return df.where(box)


def cone(df: DataFrame, ra0: float, dec0: float, r: float, ra: str = "radeg", dec: str = "decdeg") -> DataFrame:
    """Rows nearer than r degrees. The band in dec can be pushed down to the scan."""
    return df.where(F.col(dec).between(dec0 - r, dec0 + r)).where(separation(F.col(ra), F.col(dec), F.lit(ra0), F.lit(dec0)) < r)


def bright_isolated(df: DataFrame, mlim: float, rlim: float) -> DataFrame:
    """min(g, r, i) <= mlim and rp1 (arcsec to brighter neighbours) >= rlim."""
    return df.where((F.least("sloan_g", "sloan_r", "sloan_i") <= mlim) & (F.col("rp1") >= rlim))


def quality_cut(df: DataFrame, survey: str) -> DataFrame:
    """Survey cuts: ``gaia`` (ruwe < 1.4, 8 visibility periods, three bands with positive signal to noise),
    ``panstarrs`` (more than one detection, quality flag below 128, all five bands)."""
    if survey == "gaia":
        bands = ["g", "bp", "rp"]
        df = df.where((F.col("ruwe") < 1.4) & (F.col("visibility_periods_used") >= 8)).na.drop(subset=bands)
        for b in bands:
            df = df.where(F.col(f"{b}_snr") > 0)
        return df
    if survey == "panstarrs":
        return df.where((F.col("n_detections") > 1) & (F.col("quality_flag") < 128)).na.drop(subset=["g", "r", "i", "z", "y"])
    raise ValueError(f"unknown survey {survey}")


def mag_limits(pairs: DataFrame, maglim: float, brightlim: float | None = None, mag: str = "cat_mag") -> DataFrame:
    """Catalogue magnitude <= maglim (and >= brightlim)."""
    out = pairs.where(F.col(mag) <= maglim)
    return out if brightlim is None else out.where(F.col(mag) >= brightlim)


def color_limits(pairs: DataFrame, redlim: float | None = None, bluelim: float | None = None) -> DataFrame:
    """The reddest of color1..3 at most redlim, the bluest at least bluelim."""
    if redlim is not None:
        pairs = pairs.where(F.greatest("color1", "color2", "color3") <= redlim)
    return pairs if bluelim is None else pairs.where(F.least("color1", "color2", "color3") >= bluelim)


def exclude_target(pairs: DataFrame, targets: DataFrame, r: float = 2.0, xy: tuple[str, str] = ("x_image", "y_image")) -> DataFrame:
    """Pairs at least r pixels from their image's target; ``targets(image_id, target_x, target_y)`` has one row
    or none for an image."""
    distance = F.hypot(F.col(xy[0]) - F.col("target_x"), F.col(xy[1]) - F.col("target_y"))
    return pairs.join(targets.select("image_id", "target_x", "target_y"), "image_id", "left").where(F.coalesce(distance >= r, F.lit(True))).drop("target_x", "target_y")


def quality_detections(det: DataFrame) -> DataFrame:
    """Rows without flags and with an error below 1.091 / 2 (and pier 0, positive flux where those columns are);
    a row with is_target stays in any case and its number becomes 0."""
    good = (F.col("flags") == 0) & (F.col("magerr_auto") < 1.091 / 2)
    if "pier" in det.columns:
        good = good & (F.col("pier") == 0)
    if "flux" in det.columns:
        good = good & (F.col("flux") > 0)
    target = F.coalesce(F.col("is_target"), F.lit(False)) if "is_target" in det.columns else F.lit(False)
    return det.where(F.coalesce(good, F.lit(False)) | target).withColumn("number", F.when(target, F.lit(0)).otherwise(F.col("number")))


def inside_frame(df: DataFrame, margin: float, xy: tuple[str, str] = ("x_image", "y_image")) -> DataFrame:
    """C11: rows at least ``margin`` pixels inside the image."""
    x, y = F.col(xy[0]), F.col(xy[1])
    return df.where((x >= margin) & (y >= margin) & (x <= F.col("imgaxis1") - margin) & (y <= F.col("imgaxis2") - margin))


def check_wcs(images: DataFrame, proj: str = "TAN", grid: int = 11) -> DataFrame:
    """Adds max_roundtrip (pixels, over a grid and both pixel origins), sky_ok and needs_solving (an error over a
    pixel or a position off the sky or missing)."""
    steps = F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))
    points = images.withColumn("_i", steps).withColumn("_j", steps).withColumn("_o", F.explode(F.array(F.lit(0.0), F.lit(1.0))))
    points = points.withColumns({"_x": F.col("_i") * F.col("imgaxis1") / (grid - 1) + 1 - F.col("_o"), "_y": F.col("_j") * F.col("imgaxis2") / (grid - 1) + 1 - F.col("_o")})
    back = world2pix(pix2world(points, proj, "_x", "_y", ("_ra", "_dec")), proj, "_ra", "_dec", ("_bx", "_by"))
    found = back.groupBy("image_id").agg(
        F.max(F.hypot(F.col("_bx") - F.col("_x"), F.col("_by") - F.col("_y"))).alias("max_roundtrip"),
        F.bool_and(F.coalesce(F.col("_ra").between(0, 360) & F.col("_dec").between(-90, 90) & F.col("_bx").isNotNull(), F.lit(False))).alias("sky_ok"),
    )
    return images.join(found, "image_id").withColumn("needs_solving", ~(F.col("sky_ok") & F.coalesce(F.col("max_roundtrip") <= 1, F.lit(False))))


def missing_keys(images: DataFrame, required: list[str], soft: list[str] = []) -> DataFrame:
    """Adds missing_required and missing_soft, names of keys that are null or NaN (as columns)."""

    def absent(names: list[str]) -> Column:
        have = F.array(*[F.when(F.col(n).isNotNull() & ~(F.isnan(n) if dict(images.dtypes)[n] in ("double", "float") else F.lit(False)), F.lit(n)) for n in names if n in images.columns])
        return F.array_except(F.array(*[F.lit(n) for n in names]).cast("array<string>"), have.cast("array<string>"))

    return images.withColumns({"missing_required": absent(required), "missing_soft": absent(soft)})


def early(images: DataFrame, events: DataFrame, days: float = 0.5) -> DataFrame:
    """C14: images at most ``days`` after their field's event; ``events(field_id, t0)``. Fields without one stay."""
    return images.join(events.select("field_id", "t0"), "field_id", "left").where(F.coalesce(F.col("jd") - F.col("t0") <= days, F.lit(True))).drop("t0")


def subsample(pairs: DataFrame, n: int, seed: int = 0, by: str = "image_id", key: str = "number") -> DataFrame:
    """At most n rows per image in a fixed pseudo-random order of the key (the same rows on every run). Digests are
    sorted as bytes, in the order of their hex text at half its size."""
    order = F.unhex(F.md5(F.concat_ws("/", F.col(by).cast("string"), F.col(key).cast("string"), F.lit(str(seed)))))
    return pairs.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(order, key))).where(F.col("_r") <= n).drop("_r")


def min_found(trails: DataFrame, n: int, by: str = "trail_id") -> DataFrame:
    """C17: rows of the trails with at least n detections."""
    return trails.join(trails.groupBy(by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n).select(by), by, "left_semi")


def tile_of(ra: Column, dec: Column) -> Column:
    """Number of the 1 x 1 degree tile: floor(ra) + 360 * (floor(dec) + 90)."""
    i = F.pmod(F.floor(ra + 1e-8), F.lit(360))
    return (i + 360 * F.least(F.floor(dec + 1e-8) + 90, F.lit(179))).cast("int")


def tiles_for(fields: DataFrame, shape: str = "rect") -> DataFrame:
    """(field_id, tile) of the 1 x 1 degree tiles that fields touch: ``fields(field_id, ra0, dec0, da, dd)`` in
    degrees of arc (a circle's radius is da).

    Marks the tiles of the corners (of a rectangle) or the centre (of a circle) and those with a corner inside; of a
    rectangle then all between the outermost marked tiles of each band of dec (through 0 where they are more than 180
    apart) and of each column of RA. A rectangle over a pole needs no such filling. Candidate tiles are those of the
    field's band of dec, at most 360 * (2 dd + 3) rows for a field.
    """
    rect = shape == "rect"
    dd = F.col("dd") if rect else F.col("da")
    reach = F.hypot(F.col("da"), dd) if rect else F.col("da")
    pole = (F.col("dec0") + reach >= 90) | (F.col("dec0") - reach <= -90)
    lo = F.greatest(F.floor(F.col("dec0") - reach) - 1 + 90, F.lit(0))
    hi = F.least(F.floor(F.col("dec0") + reach) + 1 + 90, F.lit(179))
    half = F.least(F.ceil(reach / F.greatest(F.cos(F.radians(F.least(F.abs(F.col("dec0")) + reach, F.lit(89.9)))), F.lit(1e-3))) + 1, F.lit(180))
    columns = F.transform(F.sequence(-half, half), lambda k: F.pmod(F.floor(F.col("ra0")) + k, F.lit(360)))
    columns = F.when(pole, F.sequence(F.lit(0), F.lit(359)).cast("array<bigint>")).otherwise(columns)
    boxes = fields.withColumns({"j": F.explode(F.sequence(lo, hi)), "_cols": F.array_distinct(columns), "_pole": pole}).withColumn("i", F.explode("_cols")).drop("_cols")
    corner = lambda di, dj: (F.col("i") + di, F.col("j") - 90 + dj)
    if rect:
        inside = [rect_condition(*(c.cast("double") for c in corner(di, dj)), F.col("ra0"), F.col("dec0"), F.col("da"), dd) for di in (0, 1) for dj in (0, 1)]
    else:
        inside = [_dot(_unit(*(c.cast("double") for c in corner(di, dj))), _unit(F.col("ra0"), F.col("dec0"))) >= F.cos(F.radians(F.col("da"))) for di in (0, 1) for dj in (0, 1)]
    hit = inside[0] | inside[1] | inside[2] | inside[3]
    marked = boxes.where(hit).select("field_id", "i", "j", "_pole")
    if rect:
        pointing, east, north = _frame(F.col("ra0"), F.col("dec0"))
        sa, sd = F.sin(F.radians(F.col("da"))), F.sin(F.radians(dd))
        c = F.sqrt(F.greatest(1 - sa * sa - sd * sd, F.lit(0.0)))
        corners = [[c * p + s * sa * e + t * sd * n for p, e, n in zip(pointing, east, north)] for s in (1, -1) for t in (1, -1)]
        seeds = F.array(*[F.struct(F.degrees(F.atan2(v[1], v[0])).alias("a"), F.degrees(F.asin(clamp(v[2]))).alias("d")) for v in corners])
    else:
        seeds = F.array(F.struct(F.col("ra0").alias("a"), F.col("dec0").alias("d")))
    seeds = fields.withColumns({"_s": F.explode(seeds), "_pole": pole})
    seeds = seeds.select("field_id", F.pmod(F.floor(F.pmod(F.col("_s.a"), F.lit(360.0)) + 1e-8), F.lit(360)).alias("i"), F.least(F.floor(F.col("_s.d") + 1e-8) + 90, F.lit(179)).alias("j"), "_pole")
    marked = marked.unionByName(seeds).distinct()
    if rect:
        bands = marked.groupBy("field_id", "_pole", "j").agg(F.min("i").alias("a"), F.max("i").alias("b"))
        fill = F.when(F.col("b") - F.col("a") > 180, F.concat(F.sequence(F.col("b"), F.lit(359)), F.sequence(F.lit(0), F.col("a")))).otherwise(F.sequence("a", "b"))
        filled = bands.where("not _pole").select("field_id", "_pole", F.explode(fill).alias("i"), "j")
        marked = marked.unionByName(filled).distinct()
        columns = marked.groupBy("field_id", "_pole", "i").agg(F.min("j").alias("a"), F.max("j").alias("b"))
        filled = columns.where("not _pole").select("field_id", "_pole", "i", F.explode(F.sequence("a", "b")).alias("j"))
        marked = marked.unionByName(filled).distinct()
    return marked.select("field_id", (F.col("i") + 360 * F.col("j")).cast("int").alias("tile")).distinct()
