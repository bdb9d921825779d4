"""Classes of detections against the catalogue, candidates, trails over images and their scores."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import staged
from .calib import robust_sigma
from .components import connected_components
from .filters import inside_frame
from .match import dedupe_sky, unmatched, veto_phases

SNR = 1.091


def band_for(phfilter: Column) -> Column:
    """Catalogue band column of an image filter; r for unknown ones."""
    name = F.lower(F.coalesce(phfilter, F.lit("r")))
    out = F.lit("sloan_r")
    for b in "giz":
        out = F.when(name.isin(b, f"sloan_{b}"), F.lit(f"sloan_{b}")).otherwise(out)
    return F.when(name == "j", F.lit("j")).otherwise(out)


def band_mag(phfilter: Column) -> Column:
    """The star's magnitude in that band."""
    b = band_for(phfilter)
    out = F.col("sloan_r")
    for name in ("sloan_g", "sloan_i", "sloan_z", "j"):
        out = F.when(b == name, F.col(name)).otherwise(out)
    return out


def comparison_error(err: Column) -> Column:
    """Error with 0.01 in quadrature."""
    return F.sqrt(err * err + 0.01 * 0.01)


def classify(det: DataFrame, pairs: DataFrame, images: DataFrame, siglim: float = 5.0) -> DataFrame:
    """Adds best_mag, match (catalogue less measured, over the comparison error), mag_diff and type:
    ``uncatalogued`` or ``poor_fwhm`` without a match, ``brighter``, ``fainter``, ``normal``; null for an error of at
    least 1.091 / siglim. ``pairs`` are all catalogue neighbours; the one nearest in magnitude counts (ties: star_id).
    """
    near = pairs.join(images.select("image_id", "filter"), "image_id")
    near = near.withColumns({"_mag": band_mag(F.col("filter"))})
    near = near.withColumn("_mpar", (F.col("_mag") - F.col("mag_calib")) / comparison_error(F.col("magerr_calib"))).where("_mpar is not null")
    best = near.groupBy("image_id", "number").agg(F.min(F.struct(F.abs("_mpar").alias("a"), F.col("star_id"), F.col("_mag").alias("m"), F.col("_mpar").alias("p"))).alias("_b"))
    rows = det.join(best, ["image_id", "number"], "left").join(images.select("image_id", F.col("fwhm").alias("_ifwhm")), "image_id")
    rows = rows.withColumns({"best_mag": F.col("_b.m"), "match": F.col("_b.p"), "mag_diff": F.abs(F.col("_b.m") - F.col("mag_calib")), "fwhm_ratio": F.try_divide(F.col("fwhm_image"), F.col("_ifwhm"))})
    poor = (F.col("fwhm_ratio") > 1.5) | (F.col("fwhm_ratio") < 1 / 1.5)
    raw = (F.col("best_mag") - F.col("mag_calib")) / F.col("magerr_calib")
    kind = (
        F.when(F.col("best_mag").isNull(), F.when(poor, "poor_fwhm").otherwise("uncatalogued"))
        .when((F.col("match") > siglim) & (F.col("mag_diff") > 0.05), "brighter")
        .when((F.col("match") < -siglim) & (F.col("mag_diff") > 0.05), "fainter")
        .when(((F.col("match") > -siglim) & (raw < siglim)) | (F.col("mag_diff") < 0.05), "normal")
    )
    return rows.withColumn("type", F.when(F.col("magerr_calib") < SNR / siglim, kind)).drop("_b", "_ifwhm")


def candidates(det: DataFrame, pairs: DataFrame, images: DataFrame, cat2: DataFrame | None = None, siglim: float = 5.0, frame: float = 32.0, limit: float = 20.0, phases: tuple = (), dedupe_deg: float | None = None) -> DataFrame:
    """Detections without a catalogue neighbour and with a small error, inside the frame, that no star of a second
    catalogue vetoes (D05), and of close pairs in one image (within ``dedupe_deg``) the later one (D07)."""
    rows = unmatched(det, pairs).where(F.col("magerr_auto") < SNR / siglim)
    rows = inside_frame(rows.join(images.select("image_id", "imgaxis1", "imgaxis2"), "image_id"), frame).drop("imgaxis1", "imgaxis2")
    if cat2 is not None:
        rows = veto_phases(rows, cat2, limit, phases).where("killed_by is null").drop("killed_by")
    return rows if dedupe_deg is None else dedupe_sky(rows, dedupe_deg, "last", by=("image_id",))


def variables(pairs: DataFrame, siglim: float = 5.0) -> DataFrame:
    """Matched detections whose magnitude is off by more than siglim errors."""
    return pairs.where(F.abs(F.col("cat_mag") - F.col("mag_calib")) > siglim * F.col("magerr_calib"))


def motion_state(trails: DataFrame, jd_next: Column | None = None, base: float = 3.6, widest: float = 30.0, last: int = 5) -> DataFrame:
    """adds to each detection its trail's state after it: motion_ra, motion_dec (arcsec/h, of the last ``last``
    detections), sigma_ra, sigma_dec (median absolute residual over 0.67), and for a time ``jd_next`` (default: the
    next detection's) pred_ra, pred_dec and search_radius = min(base + sigma * gap in hours, widest); with fewer than
    two detections the last position and the base."""
    order = Window.partitionBy("trail_id").orderBy("jd", "number")
    recent = order.rowsBetween(-(last - 1), 0)
    rows = trails.withColumns({"_t0": F.first("jd").over(recent), "_n": F.count(F.lit(1)).over(recent)})
    rows = rows.withColumn("_p", F.collect_list(F.struct("jd", "ra", "dec")).over(recent))  # at most ``last`` points
    n = F.col("_n")
    hours = F.transform("_p", lambda p: (p["jd"] - F.col("_t0")) * 24)
    rows = rows.withColumn("_h", hours)
    fold = lambda a, f: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + f(x))
    rows = rows.withColumns({"_mt": fold(F.col("_h"), lambda x: x) / n, "_mra": fold(F.col("_p"), lambda p: p["ra"]) / n, "_mdec": fold(F.col("_p"), lambda p: p["dec"]) / n})
    rows = rows.withColumn("_stt", fold(F.col("_h"), lambda x: (x - F.col("_mt")) * (x - F.col("_mt"))))
    cross_of = lambda c: fold(F.arrays_zip("_h", "_p"), lambda z: (z["_h"] - F.col("_mt")) * (z["_p"][c] - F.col(f"_m{c}")))
    off_of = lambda c: F.array_sort(F.transform(F.arrays_zip("_h", "_p"), lambda z: F.abs(z["_p"][c] - F.col(f"_m{c}") - F.col(f"_b{c}") * (z["_h"] - F.col("_mt")))))
    for c in ("ra", "dec"):
        cross = cross_of(c)
        rows = rows.withColumn(f"_b{c}", F.when((n >= 2) & (F.col("_stt") > 0), cross / F.when(F.col("_stt") > 0, F.col("_stt"))).otherwise(F.lit(0.0)))
        rows = rows.withColumn("_o", off_of(c))
        middle = (F.element_at("_o", F.expr("(_n + 1) div 2").cast("int")) + F.element_at("_o", F.expr("(_n + 2) div 2").cast("int"))) / 2
        rows = rows.withColumns({f"motion_{c}": F.col(f"_b{c}") * 3600, f"sigma_{c}": F.when(n >= 2, middle * 3600 / 0.67).otherwise(F.lit(1.0))})
    when = jd_next if jd_next is not None else F.lead("jd").over(order)
    total = F.row_number().over(order)
    rows = rows.withColumns({"_gap": (when - F.col("jd")) * 24, "_k": total})
    sigma = F.sqrt(F.col("sigma_ra") * F.col("sigma_ra") + F.col("sigma_dec") * F.col("sigma_dec"))
    moves = F.col("_k") >= 2
    rows = rows.withColumns(
        {
            "pred_ra": F.when(moves, F.col("ra") + F.col("motion_ra") * F.col("_gap") / 3600).otherwise(F.col("ra")),
            "pred_dec": F.when(moves, F.col("dec") + F.col("motion_dec") * F.col("_gap") / 3600).otherwise(F.col("dec")),
            "search_radius": F.when(moves, F.least(base + sigma * F.col("_gap"), F.lit(widest))).otherwise(F.lit(base)),
        }
    )
    return rows.drop(*[c for c in rows.columns if c.startswith("_")])


class _Trails:
    """Trails of one field as arrays: last position and time, motion (degrees per hour), its scatter (arcsec), number
    of detections; a trail's last five detections renew its motion when one is added."""

    def __init__(self, last: dict[int, list[tuple]]):
        self.points = {k: list(v) for k, v in last.items()}
        self.a = np.zeros((max(64, 2 * len(last), max(last, default=0) + 1), 7))  # jd, ra, dec, motion ra, motion dec, scatter, detections
        for k in self.points:
            self._renew(k)

    def _renew(self, k: int) -> None:
        if k >= len(self.a):
            self.a = np.concatenate((self.a, np.zeros((max(len(self.a), k + 1 - len(self.a)), 7))))
        p = self.points[k]
        row = self.a[k]
        row[:] = p[-1][0], p[-1][1], p[-1][2], 0.0, 0.0, 0.0, len(p)
        if len(p) >= 2 and p[-1][0] > p[0][0]:
            v = np.array(p)
            t = (v[:, 0] - v[0, 0]) * 24
            t -= t.mean()
            off = v[:, 1:] - v[:, 1:].mean(0)
            slope = t @ off / (t @ t)
            scatter = np.median(np.abs(off - t[:, None] * slope), axis=0) * 3600 / 0.67
            row[3], row[4], row[5] = slope[0], slope[1], math.hypot(*scatter)

    def add(self, k: int, point: tuple) -> None:
        self.points[k] = [*self.points.get(k, []), point][-5:]
        self._renew(k)


def link_rows(pdf: pd.DataFrame, state: dict | None = None, base: float = 3.6, widest: float = 30.0, max_gap: float | None = None, motion: bool = False) -> tuple[pd.DataFrame, dict]:
    """Links candidates of one field, in order of (jd, image_id, number), to trails; see ``link_trails``. ``state`` is
    what an earlier call returned: next trail number, (jd, image_id) of the newest image, and the last five detections
    of each trail. ``motion`` adds what a row's trail is after it: _n detections, _mra, _mdec (degrees an hour), _sc."""
    state = state or {"next": 0, "trails": {}, "at": (-math.inf, 0)}
    pdf = pdf.sort_values(["jd", "image_id", "number"], kind="stable")
    trails, n = _Trails(state["trails"]), state["next"]
    jd, image, ra, dec = (pdf[c].to_numpy() for c in ("jd", "image_id", "ra", "dec"))
    ids, after = np.zeros(len(pdf), np.int64), np.zeros((len(pdf), 4))
    starts = np.flatnonzero(np.concatenate(([True], (jd[1:] != jd[:-1]) | (image[1:] != image[:-1])))) if len(pdf) else []
    for first, end in zip(starts, [*starts[1:], len(pdf)]):
        known = n  # predictions are made before any candidate of the image is assigned
        a = trails.a[:known].copy()
        gap = (jd[first] - a[:, 0]) * 24
        x, y = a[:, 1] + a[:, 3] * gap, a[:, 2] + a[:, 4] * gap
        radius = np.where(a[:, 6] >= 2, np.minimum(base + a[:, 5] * gap, widest), base)
        if max_gap is not None:
            radius[gap > max_gap] = -1.0  # gone
        radius[a[:, 6] == 0] = -1.0  # numbers of trails that the state no longer holds
        for at in range(first, end):
            k = -1
            if known:
                d = np.hypot((ra[at] - x) * math.cos(math.radians(dec[at])), dec[at] - y) * 3600
                d[~(d < radius)] = math.inf
                k = int(np.argmin(d))
                k = k if math.isfinite(d[k]) else -1
            if k >= 0:
                radius[k] = -1.0  # taken
            else:
                k, n = n, n + 1
            trails.add(k, (float(jd[at]), float(ra[at]), float(dec[at])))
            ids[at] = k
            after[at] = trails.a[k, [6, 3, 4, 5]]
    newest = (float(jd[-1]), int(image[-1])) if len(pdf) else state["at"]
    out = pdf.assign(trail_id=ids)
    if motion:
        out = out.assign(_n=after[:, 0].astype(np.int64), _mra=after[:, 1], _mdec=after[:, 2], _sc=after[:, 3])
    return out, {"next": n, "trails": trails.points, "at": newest}


def _flat_cells(rows: DataFrame, ra: str, dec: str, size: float, spread: bool) -> DataFrame:
    """Adds _band and _col, cells of ``size`` degrees in declination and of at least as much in RA times the cosine of
    all declinations within a band of the row's. ``spread`` posts each row in all cells that hold positions within
    ``size`` of it by ``hypot(dRA cos dec, ddec)``, whichever of the two declinations is taken."""
    width = lambda band: F.lit(size) / F.greatest(F.cos(F.radians(F.least(F.lit(90.0), (F.abs(band + 0.5) + 1.5) * size))), F.lit(1e-6))
    rows = rows.withColumn("_band", F.floor(F.col(dec) / size))
    if not spread:
        return rows.withColumn("_col", F.floor(F.col(ra) / width(F.col("_band"))))
    rows = rows.withColumn("_band", F.explode(F.sequence(F.col("_band") - 1, F.col("_band") + 1)))
    # In a band beside the row's, the reach in RA is that of the row's band or this one's, whichever is wider.
    reach = F.greatest(width(F.col("_band")), width(F.col("_band") - 1), width(F.col("_band") + 1))
    at = lambda sign: F.floor((F.col(ra) + sign * reach) / width(F.col("_band")))
    return rows.withColumn("_col", F.explode(F.sequence(at(-1), at(1))))


def _link_parts(rows: DataFrame, base: float, widest: float, max_gap: float | None) -> DataFrame:
    """(_row, _first, _n, _mra, _mdec, _sc): each part's rows linked on their own; _first is the trail's first row."""
    schema = "_row long, _first long, _n long, _mra double, _mdec double, _sc double"
    key = ["part", "field"]  # part numbers are hashes: those of two fields could be equal
    many = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(*key)
    alone = rows.join(many, key, "left_anti").select("_row", F.col("_row").alias("_first"), F.lit(1).cast("long").alias("_n"), *[F.lit(0.0).alias(c) for c in ("_mra", "_mdec", "_sc")])
    # Few bytes, much work: a fixed number of partitions keeps AQE from putting all parts into one task.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.join(many, key, "left_semi").repartition(tasks, *key).sortWithinPartitions(*key, "jd", "image_id", "number")

    def link(part: pd.DataFrame) -> pd.DataFrame:
        done, _ = link_rows(part, None, base, widest, max_gap, motion=True)
        first = done.groupby("trail_id")["_row"].transform("first")
        return done.assign(_first=first)[["_row", "_first", "_n", "_mra", "_mdec", "_sc"]]

    def parts(batches):
        held: list[pd.DataFrame] = []  # the last part of a batch may go on in the next
        for batch in batches:
            number, field = batch["part"].to_numpy(), batch["field"].to_numpy()
            new = np.concatenate(([not held or held[-1]["part"].iloc[-1] != number[0] or held[-1]["field"].iloc[-1] != field[0]], (number[1:] != number[:-1]) | (field[1:] != field[:-1])))
            cut = np.flatnonzero(new)
            done = []
            if held and len(cut):
                done.append(link(pd.concat([*held, batch.iloc[: cut[0]]], ignore_index=True)))
                held = []
            done += [link(batch.iloc[x:y]) for x, y in zip(cut[:-1], cut[1:])]
            held.append(batch.iloc[cut[-1] :] if len(cut) else batch)
            if done:
                yield pd.concat(done, ignore_index=True)
        if held:
            yield link(pd.concat(held, ignore_index=True))

    return ordered.mapInPandas(parts, schema).unionByName(alone)


#: Images that a state of a trail may last for its predictions to be made image by image.
SHORT = 48


def _reached(rows: DataFrame, linked: DataFrame, base: float, widest: float, max_gap: float | None) -> DataFrame:
    """(a, b): parts of which a moving trail of one comes within its search radius of a candidate of the other, in an
    image after the row that made the trail move so and not after its next one.

    A state that lasts for few images is compared image by image. One that lasts long is a line on the sky, cut where
    it leaves the field's candidates and into pieces of ``widest``; each piece meets the candidates about it, of which
    those of its time count."""
    order = Window.partitionBy("_first").orderBy("rank")
    box = rows.groupBy("field").agg(F.max("rank").alias("_last"), F.max("jd").alias("_end"), *[f(c).alias(f"_{n}_{c}") for f, n in ((F.min, "lo"), (F.max, "hi")) for c in ("ra", "dec")])
    states = linked.join(rows, "_row").withColumns({"_to": F.lead("rank").over(order), "_jd1": F.lead("jd").over(order)}).where("_n >= 2")
    states = states.join(box, "field").select(
        "field", F.col("part").alias("_p"), F.col("rank").alias("_from"), F.coalesce("_to", "_last").alias("_to"), F.col("jd").alias("_jd0"), ((F.coalesce("_jd1", "_end") - F.col("jd")) * 24).alias("_h1"),
        F.col("ra").alias("_ra0"), F.col("dec").alias("_dec0"), "_mra", "_mdec", "_sc", "_lo_ra", "_hi_ra", "_lo_dec", "_hi_dec",
    )
    if max_gap is not None:
        states = states.withColumn("_h1", F.least("_h1", F.lit(float(max_gap))))
    states = staged(states, "states")
    hours = lambda jd: (jd - F.col("_jd0")) * 24
    reach = widest / 3600
    there = rows.where("ra is not null and dec is not null")

    def met(pairs: DataFrame) -> DataFrame:
        h = hours(F.col("jd"))
        x, y, r = F.col("_ra0") + F.col("_mra") * h, F.col("_dec0") + F.col("_mdec") * h, F.least(base + F.col("_sc") * h, F.lit(widest))
        d = F.hypot((F.col("ra") - x) * F.cos(F.radians("dec")), F.col("dec") - y) * 3600
        good = (F.col("_p") != F.col("part")) & (F.col("rank") > F.col("_from")) & (F.col("rank") <= F.col("_to")) & (d < r)
        if max_gap is not None:
            good = good & (h <= max_gap)
        return pairs.where(good).select(F.col("_p").alias("a"), F.col("part").alias("b"))

    keys = ["field", "_band", "_col"]
    short = states.where(F.col("_to") - F.col("_from") <= SHORT).withColumn("_rank", F.explode(F.sequence(F.col("_from") + 1, "_to")))
    times = rows.select("field", F.col("rank").alias("_rank"), F.col("jd").alias("_jd")).distinct()
    short = short.join(times, ["field", "_rank"]).withColumns({"_x": F.col("_ra0") + F.col("_mra") * hours(F.col("_jd")), "_y": F.col("_dec0") + F.col("_mdec") * hours(F.col("_jd"))})
    short = _flat_cells(short.where("abs(_y) <= 91 and abs(_x) <= 1e6"), "_x", "_y", reach, False)
    by_image = _flat_cells(there, "ra", "dec", reach, True).withColumn("_rank", F.col("rank"))
    found = met(short.join(by_image, [*keys, "_rank"]))
    # When the line is within the box of the field's candidates, and ``widest`` about it.
    pole = F.greatest(F.cos(F.radians(F.least(F.greatest(F.abs("_lo_dec"), F.abs("_hi_dec")), F.lit(90.0)))), F.lit(1e-6))

    def within(at: str, speed: str, lo: Column, hi: Column) -> tuple[Column, Column]:
        moves = F.col(speed) != 0
        one, two = (F.try_divide(x - F.col(at), F.col(speed)) for x in (lo, hi))
        rests = F.col(at).between(lo, hi)
        return F.when(moves, F.least(one, two)).when(rests, F.lit(0.0)).otherwise(F.lit(1e18)), F.when(moves, F.greatest(one, two)).when(rests, F.lit(1e18)).otherwise(F.lit(-1.0))

    (xa, xb), (ya, yb) = within("_ra0", "_mra", F.col("_lo_ra") - reach / pole, F.col("_hi_ra") + reach / pole), within("_dec0", "_mdec", F.col("_lo_dec") - reach, F.col("_hi_dec") + reach)
    long = states.where(F.col("_to") - F.col("_from") > SHORT).withColumns({"_ha": F.greatest(xa, ya, F.lit(0.0)), "_hb": F.least(xb, yb, F.col("_h1"))}).where("_ha <= _hb")
    pieces = F.ceil(F.hypot("_mra", "_mdec") * (F.col("_hb") - F.col("_ha")) / reach) + 1
    long = long.withColumn("_k", pieces).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1)))
    begin = F.col("_ha") + (F.col("_hb") - F.col("_ha")) * F.col("_i") / F.col("_k")
    long = long.withColumns({"_x": F.col("_ra0") + F.col("_mra") * begin, "_y": F.col("_dec0") + F.col("_mdec") * begin})
    # A candidate within ``widest`` of a piece is within twice that of where it begins.
    around = _flat_cells(there, "ra", "dec", 2.0001 * reach, True)
    found = found.unionByName(met(_flat_cells(long, "_x", "_y", 2.0001 * reach, False).join(around, keys)))
    return found.distinct()


#: Candidates of a field up to which all of it is linked at once: some seconds of one task.
WHOLE = 20_000


def link_trails(cand: DataFrame, base: float = 3.6, widest: float = 30.0, max_gap: float | None = None, whole: int = WHOLE) -> DataFrame:
    """adds trail_id (numbered within the field): in order of (jd, image_id, number), each candidate takes the
    nearest free trail nearer than its search radius (strict), else starts one; a new trail is not seen by other
    candidates of its image, and a trail takes one candidate of an image. A trail not seen for more than ``max_gap``
    hours (none: any time) takes no more. ``cand(field_id, image_id, number, jd, ra, dec, ..)``; candidates without a
    position are trails of their own.

    A field of more than ``whole`` candidates is not one group: they are first parted where no resting trail reaches from one part to another
    (components of occupied cells of ``base``), and the parts are linked on their own. Then the predictions of all
    moving trails are compared with the candidates of other parts, image by image; parts that meet are joined and
    linked again, until none meet. What is left is the answer of the whole field, as no trail of a part has come
    within reach of another part's candidate; it does not hang on ``whole``. Only parts of more than one candidate go through
    Python.
    """
    taken = {c.lower() for c in cand.columns}
    name = "_row"
    while name in taken:
        name = "_" + name
    table = staged(cand.withColumn(name, F.monotonically_increasing_id()), "candidates")
    field = F.when(F.col("field_id").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("field_id").cast("string")))
    rows = table.select(F.col(name).alias("_row"), field.alias("field"), "image_id", "number", "jd", *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in ("ra", "dec")])
    rows = _flat_cells(rows, "ra", "dec", base / 3600, False).withColumn("_cell", F.xxhash64("field", "_band", "_col"))
    images = rows.select("field", "jd", "image_id").distinct().withColumn("rank", F.row_number().over(Window.partitionBy("field").orderBy("jd", "image_id")).cast("long"))
    rows = staged(rows.withColumn("_cell", F.when(F.col("_col").isNotNull(), F.col("_cell"))).join(images, ["field", "jd", "image_id"], "left"), "cells")
    wide = staged(rows.groupBy("field").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > whole).select("field"), "fields")
    held = rows.where("_cell is not null").join(wide, "field", "left_semi").groupBy("field", "_band", "_col", "_cell").agg(F.min("ra").alias("ra"), F.max("ra").alias("_ra2"), F.min("dec").alias("dec"))
    beside = _flat_cells(held.select("field", F.col("_cell").alias("_from"), "ra", "dec"), "ra", "dec", base / 3600, True)
    far = _flat_cells(held.select("field", F.col("_cell").alias("_from"), F.col("_ra2").alias("ra"), "dec"), "ra", "dec", base / 3600, True)
    met = beside.unionByName(far).join(held.select("field", "_band", "_col", "_cell"), ["field", "_band", "_col"])
    parted = not wide.isEmpty()
    if parted:
        cells = connected_components(met.select(F.col("_from").alias("a"), F.col("_cell").alias("b")))
        parts = rows.join(cells.withColumnRenamed("node", "_cell"), "_cell", "left")
    else:
        parts = rows.withColumn("component", F.lit(None).cast("long"))
    # Part numbers count within their field only: 0 is all of a field that is linked at once.
    part = F.coalesce("component", F.when(F.col("_cell").isNotNull(), F.lit(0).cast("long")), -F.col("_row") - 1)
    parts = staged(parts.select("_row", "field", "image_id", "number", "jd", "rank", "ra", "dec", part.alias("part")), "parts")
    linked = staged(_link_parts(parts, base, widest, max_gap), "linked")
    while parted:
        met = connected_components(_reached(parts.join(wide, "field", "left_semi"), linked, base, widest, max_gap))
        if met.isEmpty():
            break
        moved = parts.join(met.select(F.col("node").alias("part"), F.col("component").alias("_to")), "part", "left")
        parts = staged(moved.withColumn("part", F.coalesce("_to", "part")).drop("_to").select(parts.columns), "parts")
        again = parts.join(met.select(F.col("component").alias("part")).distinct(), "part", "left_semi")
        linked = staged(linked.join(again.select("_row"), "_row", "left_anti").unionByName(_link_parts(again, base, widest, max_gap)), "linked")
    order = Window.partitionBy("field").orderBy("jd", "image_id", "number", "_first")
    firsts = linked.where("_row = _first").join(parts, "_row").select("_first", (F.row_number().over(order) - 1).cast("long").alias("trail_id"))
    ids = linked.select(F.col("_row").alias(name), "_first").join(firsts, "_first").select(name, "trail_id")
    return table.join(ids, name).select(*[table[f"`{c}`"] for c in cand.columns], "trail_id")


def _whole_trail():
    """The rows of a trail: once they are together and sorted (``_in_time``), all of K05-K09 reads them there."""
    return Window.partitionBy("trail_id")


def _in_time():
    return _whole_trail().orderBy("jd", "number")


def _gap_rows(trails: DataFrame) -> DataFrame:
    return trails.withColumn("_g", (F.col("jd") - F.lag("jd").over(_in_time())) * 24)


def _gap_sums() -> list[Column]:
    return [F.coalesce(F.max("_g"), F.lit(0.0)).alias("max_gap"), F.coalesce(F.avg("_g"), F.lit(0.0)).alias("avg_gap")]


def gaps(trails: DataFrame) -> DataFrame:
    """(trail_id, max_gap, avg_gap) between detections in hours, 0 for one detection."""
    return _gap_rows(trails).groupBy("trail_id").agg(*_gap_sums())


def _inflated(chi2: Column, w: Column, n: Column, k: int, plain: Column) -> Column:
    """Root of the weighted variance, inflated where chi2 per degree of freedom is above 3; plain for n <= k."""
    reduced = chi2 / F.when(n > k, n - k)
    variance = chi2 / w
    return F.when(n > k, F.sqrt(F.when(reduced > 3.0, variance * reduced).otherwise(variance))).otherwise(plain)


def _light_rows(trails: DataFrame, legacy: bool) -> DataFrame:
    e, m = F.col("magerr_calib"), F.col("mag_calib")
    w = e if legacy else 1 / (e * e)
    rows = trails.where("trail_id is not null").withColumn("mag0", F.sum(m * w).over(_whole_trail()) / F.sum(w).over(_whole_trail()))
    return rows.withColumn("_r", m - F.col("mag0"))


def _light_sums(legacy: bool) -> list[Column]:
    e, r = F.col("magerr_calib"), F.col("_r")
    if legacy:
        return [F.first("mag0").alias("mag0"), F.sqrt(F.avg(r / e * r / e)).alias("magvar"), F.count(F.lit(1)).alias("_n")]
    w, n = 1 / (e * e), F.count(F.lit(1))
    return [F.first("mag0").alias("mag0"), _inflated(F.sum(w * r * r), F.sum(w), n, 1, F.stddev_pop(r)).alias("magvar"), n.alias("_n")]


def mag_stats(trails: DataFrame, legacy: bool = False) -> DataFrame:
    """(trail_id, mag0, magvar, num): inverse-variance mean and spread, inflated for chi2 > 3; ``legacy`` weighs by
    the errors and gives the root mean square of the normalised residuals."""
    return _light_rows(trails, legacy).groupBy("trail_id").agg(*_light_sums(legacy)).withColumnRenamed("_n", "num")


def _step_rows(trails: DataFrame) -> DataFrame:
    rows = trails.withColumn("_e", F.greatest("magerr_calib", F.lit(0.001)))
    rows = rows.withColumns({"_m2": F.lag("mag_calib").over(_in_time()), "_e2": F.lag("_e").over(_in_time())})
    return rows.withColumn("_v", F.abs(F.col("mag_calib") - F.col("_m2")) / F.sqrt(F.col("_e") * F.col("_e") + F.col("_e2") * F.col("_e2")))


def _variability(steps: Column, n: Column, magvar: Column) -> Column:
    return F.try_divide(steps * n, (n - 1) * magvar)


def variability(trails: DataFrame, stats: DataFrame) -> DataFrame:
    """(trail_id, variability): sum of abs(m_i - m_i+1) / sqrt(e_i^2 + e_i+1^2) in order of time, errors of at
    least 0.001, times n / (n - 1) over magvar; null for one detection."""
    sums = _step_rows(trails).groupBy("trail_id").agg(F.sum("_v").alias("s"), F.count(F.lit(1)).alias("n"))
    value = _variability(F.col("s"), F.col("n"), F.col("magvar"))
    return sums.join(stats.select("trail_id", "magvar"), "trail_id").select("trail_id", value.alias("variability"))


def _motion_rows(trails: DataFrame, astvar: float | None, span: str, rows: DataFrame | None = None) -> DataFrame:
    """``rows`` (``trails`` with further columns) with _in, null for rows of no field, and residuals about the lines. The
    span's ends are a row a field, and so broadcast: a join on the field would put all of a field in one task."""
    field = ["field_id"] if "field_id" in trails.columns else []
    rows = (trails if rows is None else rows).where("trail_id is not null")
    if span == "field":
        first = trails.groupBy(*field, "trail_id").agg(F.min("jd").alias("_f"))
        limits = first.groupBy(*field).agg(F.min("_f").alias("_lo"), F.max("_f").alias("_hi"), F.count(F.lit(1)).alias("_in"))
        rows = rows.join(F.broadcast(limits), field, "left") if field else rows.join(F.broadcast(limits))
    else:
        rows = rows.withColumns({"_lo": F.min("jd").over(_whole_trail()), "_hi": F.max("jd").over(_whole_trail()), "_in": F.lit(1)})
    w = 1 / ((F.col("errx2_image") + F.col("erry2_image")) * float(astvar)) if astvar else F.lit(1.0)
    here = lambda c: F.when(F.col("_in").isNotNull(), c)
    rows = rows.withColumns({"_t": (F.col("jd") - (F.col("_lo") + F.col("_hi")) / 2) * 24, "_w": here(w)})
    # Moments about the trail's own mean time and position keep the sums well conditioned.
    total = lambda c: F.sum(c).over(_whole_trail())
    rows = rows.withColumns({f"_m{n}": total(F.col("_w") * F.col(c)) / total("_w") for c, n in (("_t", "t"), ("ra", "ra"), ("dec", "dec"))})
    rows = rows.withColumns({"_dt": F.col("_t") - F.col("_mt"), "_dra": here(F.col("ra") - F.col("_mra")), "_ddec": here(F.col("dec") - F.col("_mdec"))})
    slope = lambda c: F.coalesce(F.try_divide(total(F.col("_w") * F.col("_dt") * F.col(c)), total(F.col("_w") * F.col("_dt") * F.col("_dt"))), F.lit(0.0))
    rows = rows.withColumns({"_bra": slope("_dra"), "_bdec": slope("_ddec")})
    return rows.withColumns({"_rra": F.col("_dra") - F.col("_bra") * F.col("_dt"), "_rdec": F.col("_ddec") - F.col("_bdec") * F.col("_dt")})


def _motion_sums(weighted: bool) -> list[Column]:
    n, sw = F.count("_in"), F.sum("_w")
    means = [F.first(c).alias(c) for c in ("_mt", "_mra", "_mdec", "_bra", "_bdec")]
    ends = [F.first(c, ignorenulls=True).alias(c) for c in ("_lo", "_hi")]
    if weighted:
        spread = lambda c: _inflated(F.sum(F.col("_w") * F.col(c) * F.col(c)), sw, n, 2, F.stddev_pop(c))
    else:
        spread = lambda c: robust_sigma(F.col(c))
    return [n.alias("num"), *means, *ends, (spread("_rra") * 3600).alias("sa"), (spread("_rdec") * 3600).alias("sd")]


def _motion(sums: DataFrame) -> DataFrame:
    """Lines, distance moved and significance of the sums of trails; trails without a row in a field are left out."""
    span = (F.col("_hi") - F.col("_lo")) * 24
    out = sums.where("num > 0").withColumns({"a0": F.col("_mra") - F.col("_bra") * F.col("_mt"), "d0": F.col("_mdec") - F.col("_bdec") * F.col("_mt"), "da": F.col("_bra") * 3600, "dd": F.col("_bdec") * 3600})
    c2 = F.pow(F.cos(F.radians("d0")), F.lit(2))
    out = out.withColumns({"dpos": F.sqrt(F.col("dd") * F.col("dd") + F.col("da") * F.col("da") * c2) * span, "sigma": F.sqrt(F.col("sd") * F.col("sd") + F.col("sa") * F.col("sa") * c2)})
    return out.withColumn("significance", F.when(F.col("sigma") > 0, F.col("dpos") / F.when(F.col("sigma") > 0, F.col("sigma"))).otherwise(F.lit(0.0)))


_MOTION = ("num", "a0", "d0", "da", "dd", "sa", "sd", "dpos", "sigma", "significance")


def motion_fit(trails: DataFrame, astvar: float | None = None, span: str = "field") -> DataFrame:
    """(trail_id, num, a0, d0, da, dd, sa, sd, dpos, sigma, significance): lines RA(t), Dec(t) about the middle of
    the span, slopes in arcsec/h, scatters in arcsec.

    With ``astvar`` > 0 points weigh 1 / ((errx2 + erry2) astvar) and scatters are weighted, inflated for chi2 > 3;
    else they are medians of absolute residuals over 0.67. The span is that of the first detections of all trails of
    the field (``span='field'``, column field_id if present) or of the trail itself. ``significance`` is dpos / sigma,
    0 where sigma is 0."""
    astvar = astvar if astvar is not None and astvar > 0 else None
    sums = _motion_rows(trails, astvar, span).groupBy("trail_id").agg(*_motion_sums(astvar is not None))
    return _motion(sums).select("trail_id", *_MOTION)


def status_flags(df: DataFrame) -> DataFrame:
    """Adds status, four letters: P/p significant motion (> 5, > 2), M/m motion over 3 or 2 sigma, V/v magnitude
    variance below 2 or 3, ``!`` otherwise."""
    s, d, g = F.col("significance"), F.col("dpos"), F.col("sigma")
    p = F.when(s > 5, "P").when(s > 2, "p").otherwise("!")
    m = F.when(d > 3 * g, "M").when(d > 2 * g, "m").otherwise("!")
    v = F.when(F.col("magvar") < 2, "V").when(F.col("magvar") < 3, "v").otherwise("!")
    return df.withColumn("status", F.concat(p, m, v, F.lit("!")))


def ot_ness(df: DataFrame) -> DataFrame:
    """Adds ot_ness = 10 / significance * magvar / variability; null where a divisor is 0."""
    return df.withColumn("ot_ness", F.try_divide(F.try_divide(F.lit(10.0), F.col("significance")) * F.col("magvar"), F.col("variability")))


def mp_ness(df: DataFrame, n_images: int) -> DataFrame:
    """Adds mp_ness: 10 times factors for motion, steady light, gaps, a steady profile and the share of images."""
    s, v, g, f = F.col("significance"), F.col("magvar"), F.col("max_gap"), F.col("fwhm_consistency")
    motion = F.when(s > 5, s * 2).when(s > 2, s).otherwise(1 / F.greatest(F.lit(0.1), s))
    steady = F.when(v < 1.5, 4.0 / (v + 0.1)).when(v < 3, 2.0 / (v + 0.1)).otherwise(1 / (F.greatest(v, F.lit(1e-9)) * F.greatest(v, F.lit(1e-9))))
    gap = F.when(g > 12, 1 / F.pow(F.greatest(g, F.lit(1.0)) / 12, F.lit(2))).when(g > 6, 6 / F.greatest(g, F.lit(1.0))).otherwise(F.lit(1.0))
    psf = F.when(f < 0.1, 3.0).when(f < 0.2, 1.5).otherwise(1 / (F.greatest(f, F.lit(1e-9)) * 10))
    share = F.col("num") / float(n_images)
    seen = F.when(share > 0.8, 2.0).when(share > 0.6, 1.5).otherwise(F.lit(1.0))
    return df.withColumn("mp_ness", 10.0 * motion * steady * gap * psf * seen)


def object_type(df: DataFrame) -> DataFrame:
    """Adds object_type: OT, MP, MV (moving, unclear) or ??."""
    o, m = F.coalesce("ot_ness", F.lit(0.0)), F.coalesce("mp_ness", F.lit(0.0))
    kind = F.when((o > 10) & (o > m), "OT").when((m > 10) & (m > o), "MP").when(F.col("significance") > 2, "MV").otherwise("??")
    return df.withColumn("object_type", kind)


def score_trails(trails: DataFrame, n_images: int, min_found: int = 3, astvar: float | None = None, span: str = "field") -> DataFrame:
    """One row per trail of at least ``min_found`` detections with motion, light and type. The rows of
    a trail are brought together and sorted once for all of it; the span is that of all trails."""
    weighted = astvar is not None and astvar > 0
    rows = _light_rows(_step_rows(_gap_rows(trails)), legacy=not astvar)
    rows = _motion_rows(trails, astvar if weighted else None, span, rows)
    sums = rows.groupBy("trail_id").agg(F.avg("fwhm_image").alias("fwhm_mean"), F.stddev_pop("fwhm_image").alias("_fs"), F.sum("_v").alias("_v"), *_motion_sums(weighted), *_light_sums(not astvar), *_gap_sums())
    found = _motion(sums.where(F.col("_n") >= min_found)).withColumns({
        "fwhm_consistency": F.when(F.col("fwhm_mean") > 0, F.col("_fs") / F.when(F.col("fwhm_mean") > 0, F.col("fwhm_mean"))).otherwise(F.lit(1.0)),
        "variability": _variability(F.col("_v"), F.col("_n"), F.col("magvar")),
    })
    shown = found.select("trail_id", "fwhm_mean", "fwhm_consistency", *_MOTION, "mag0", "magvar", "variability", "max_gap", "avg_gap")
    return object_type(mp_ness(ot_ness(status_flags(shown)), n_images))


def trail_summary(trails: DataFrame, fast: float = 5.0) -> DataFrame:
    """One row: trails, single, multiple (2 and more), three_plus, moving (over ``fast`` arcsec/h)."""
    state = motion_state(trails)
    last = state.groupBy("trail_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("jd", "number", "motion_ra", "motion_dec")).alias("m"))
    speed = F.hypot(F.col("m.motion_ra"), F.col("m.motion_dec"))
    return last.agg(F.count(F.lit(1)).alias("trails"), F.count_if(F.col("n") == 1).alias("single"), F.count_if(F.col("n") > 1).alias("multiple"), F.count_if(F.col("n") >= 3).alias("three_plus"), F.count_if((F.col("n") > 1) & (speed > fast)).alias("moving"))


def light_curves(trails: DataFrame, scores: DataFrame, t0: float, ot: float = 2.0, mp: float = 10.0) -> DataFrame:
    """Detections of trails with ot_ness > ot or mp_ness > mp, with seconds since t0 at mid exposure and half the
    exposure."""
    valid = scores.where((F.coalesce("ot_ness", F.lit(0.0)) > ot) | (F.coalesce("mp_ness", F.lit(0.0)) > mp)).select("trail_id", "object_type")
    half = F.col("exptime") / 2
    return trails.join(valid, "trail_id").select("trail_id", "object_type", "jd", ((F.col("jd") - t0) * 86400 + half).alias("t"), half.alias("half_exposure"), "mag_calib", "magerr_calib")
