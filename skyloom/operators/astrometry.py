"""Projection fits for all images of a survey at once. The pairs of an image are one bounded group (what one image
holds); its Gauss-Newton steps run where they are, after one shuffle, those of all images of a batch together. Parameters shared by all images are found from
per-image normal equations, of which only a small reduced system is summed."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import discard, staged
from .fit import f_pvalue, solve

#: Step of the numerical derivative of each parameter.
STEPS = {"crval1": 1e-5, "crval2": 1e-5, "crpix1": 1e-2, "crpix2": 1e-2, "cd1_1": 1e-8, "cd1_2": 1e-8, "cd2_1": 1e-8, "cd2_2": 1e-8}
LINEAR = ["crval1", "crval2", "cd1_1", "cd1_2", "cd2_1", "cd2_2"]
WCS = ["crval1", "crval2", "crpix1", "crpix2", "cd1_1", "cd1_2", "cd2_1", "cd2_2"]


def _pv_step(name: str, proj: str) -> float:
    """Higher terms of a polynomial need larger steps to be seen; they are linear, so that the step's size is no error."""
    n = int(name.rsplit("_", 1)[1])
    return 10.0 ** (n - 2) if proj == "ZPN" and n > 1 else 1e-3


def project(p: dict[str, float], proj: str, ra: np.ndarray, dec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pixels of sky positions, as ``world2pix`` gives them; parameters are numbers, or arrays with a value a position."""
    a, d, d0 = np.radians(ra - p["crval1"]), np.radians(dec), np.radians(p["crval2"])
    cosu = np.sin(d) * np.sin(d0) + np.cos(d) * np.cos(d0) * np.cos(a)
    sc, ss = -np.cos(d) * np.sin(a), np.sin(d) * np.cos(d0) - np.cos(d) * np.sin(d0) * np.cos(a)
    sinu = np.hypot(sc, ss)
    u = np.arctan2(sinu, cosu)
    if proj == "SZP":
        mu, phi, theta = p.get("pv2_1", 0.0), np.radians(p.get("pv2_2", 0.0)), np.radians(p.get("pv2_3", 90.0))
        xp, yp, zp, s = -mu * np.cos(theta) * np.sin(phi), mu * np.cos(theta) * np.cos(phi), mu * np.sin(theta) + 1, 1.0 - cosu
        return _pixels(p, np.degrees((zp * ss - xp * s) / (zp - s)), np.degrees(-(zp * sc + yp * s) / (zp - s)))
    if proj == "TAN":
        ratio = 1 / np.where(cosu > 0, cosu, np.nan)
    else:
        if proj == "ZEA":
            r = np.sqrt(2 * (1 - cosu))
        elif proj == "ARC":
            r = u
        elif proj == "ZPN":
            r = sum(p.get(f"pv2_{n}", 1.0 if n == 1 else 0.0) * u**n for n in range(10))
        elif proj == "AZP":
            r = (p.get("pv2_1", 0.0) + 1) * sinu / (p.get("pv2_1", 0.0) + cosu + sc * np.tan(np.radians(p.get("pv2_2", 0.0))))
        else:
            raise ValueError(f"no fit of {proj}")
        ratio = r / np.where(sinu > 0, sinu, 1.0)
    return _pixels(p, np.degrees(-ratio * sc), np.degrees(ratio * ss))


def _pixels(p: dict[str, float], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    det = p["cd1_1"] * p["cd2_2"] - p["cd2_1"] * p["cd1_2"]
    return p["crpix1"] + (p["cd2_2"] * x - p["cd1_2"] * y) / det, p["crpix2"] + (p["cd1_1"] * y - p["cd2_1"] * x) / det


def normal(pdf: pd.DataFrame, p: dict[str, float], params: list[str], proj: str, robust: bool) -> tuple[np.ndarray, np.ndarray, float, np.ndarray, np.ndarray]:
    """J'WJ, J'Wr, r'Wr and the residuals of both axes (pixels), over the errors ``image_dxy``."""
    ra, dec = pdf["radeg"].to_numpy(float), pdf["decdeg"].to_numpy(float)
    x, y = project(p, proj, ra, dec)
    r = np.stack([pdf["x_image"].to_numpy(float) - x, pdf["y_image"].to_numpy(float) - y])
    good = np.isfinite(r).all(0)
    j = np.zeros((len(params), 2, len(ra)))
    for n, name in enumerate(params):
        h = STEPS.get(name) or _pv_step(name, proj)
        up, down = (project({**p, name: p[name] + s * h}, proj, ra, dec) for s in (1, -1))
        j[n] = (np.stack(up) - np.stack(down)) / (2 * h)
    w = 1 / pdf["image_dxy"].to_numpy(float) ** 2 if "image_dxy" in pdf else np.ones(len(ra))
    if robust:
        w = w / (1 + (r * r).sum(0) * w)
    j, r, w = j[:, :, good], r[:, good], w[good]
    return np.einsum("iam,jam,m->ij", j, j, w), np.einsum("iam,am,m->i", j, r, w), float(((r * r).sum(0) * w).sum()), r[0], r[1]


def _pv_default(name: str, proj: str) -> float:
    """What ``project`` takes for a PV term that an image lacks."""
    return {("ZPN", "pv2_1"): 1.0, ("SZP", "pv2_3"): 90.0}.get((proj, name), 0.0)


class _Block:
    """The pairs of many images, sorted by image, and their parameters ``p``, an array with a value an image each. Left
    out are images with too few pairs for ``params`` and those that lack one of them or of the plain WCS."""

    def __init__(self, pdf: pd.DataFrame, wcs: list[str], params: list[str], proj: str):
        ids, first, n = np.unique(pdf["image_id"].to_numpy(), return_index=True, return_counts=True)
        start = {c: pdf[c].to_numpy(float, na_value=np.nan)[first] for c in wcs}
        keep = 2 * n > len(params)
        for c in {*params, *WCS}:
            keep &= np.isfinite(start[c]) if c in start else c not in params
        pdf = pdf[np.repeat(keep, n)]
        self.ids, self.n, self.proj = ids[keep], n[keep], proj
        self.p = {c: np.where(np.isnan(v[keep]), _pv_default(c, proj), v[keep]) if c not in WCS else v[keep] for c, v in start.items()}
        self.at = np.repeat(np.arange(len(self.ids)), self.n)
        self.first = np.cumsum(self.n) - self.n
        self.ra, self.dec, self.x, self.y = (pdf[c].to_numpy(float, na_value=np.nan) for c in ("radeg", "decdeg", "x_image", "y_image"))
        self.w = 1 / pdf["image_dxy"].to_numpy(float, na_value=np.nan) ** 2 if "image_dxy" in pdf else np.ones(len(pdf))

    def sums(self, v: np.ndarray) -> np.ndarray:
        """Sums of the last axis by image."""
        return np.add.reduceat(v, self.first, axis=-1)

    def normal(self, params: list[str], robust: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For every image what ``normal`` gives for one; pairs without a residual have a residual of nan."""
        p = {c: v[self.at] for c, v in self.p.items()}
        pixels = lambda q: np.stack(project(q, self.proj, self.ra, self.dec))
        r = np.stack([self.x, self.y]) - pixels(p)
        good = np.isfinite(r).all(0)
        j = np.zeros((len(params), 2, len(self.ra)))
        for n, name in enumerate(params):
            h = STEPS.get(name) or _pv_step(name, self.proj)
            j[n] = (pixels({**p, name: p[name] + h}) - pixels({**p, name: p[name] - h})) / (2 * h)
        w = self.w / (1 + (r * r).sum(0) * self.w) if robust else self.w
        k, m = len(params), len(self.ids)
        jg, rg, wg = np.where(good, j, 0.0), np.where(good, r, 0.0), np.where(good, w, 0.0)
        a, b = np.zeros((m, k, k)), np.zeros((m, k))
        for i in range(k):
            for l in range(i, k):
                a[:, i, l] = a[:, l, i] = self.sums((jg[i] * jg[l]).sum(0) * wg)
            b[:, i] = self.sums((jg[i] * rg).sum(0) * wg)
        return a, b, self.sums((rg * rg).sum(0) * wg), np.where(good, r[0], np.nan), np.where(good, r[1], np.nan)


def _solved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``solve`` for a stack of systems, without the covariances."""
    scale = 1 / np.sqrt(np.maximum(np.einsum("mii->mi", a), 1e-300))
    scaled = a * scale[:, :, None] * scale[:, None, :]
    inverse, plain = np.empty_like(a), np.zeros(len(a), bool)
    try:  # the condition by column sums is at least that of ``solve`` over the number of columns, and cheap
        inverse = np.linalg.inv(scaled)
        plain = np.abs(scaled).sum(1).max(1) * np.abs(inverse).sum(1).max(1) < 1e12 / (4 * max(a.shape[1], 1))
    except np.linalg.LinAlgError:
        pass
    rest = np.flatnonzero(~plain)
    sound = np.linalg.cond(scaled[rest]) < 1e12
    inverse[rest[sound]] = np.linalg.inv(scaled[rest[sound]])
    if not sound.all():
        inverse[rest[~sound]] = np.linalg.pinv(scaled[rest[~sound]], rcond=1e-12)
    return np.einsum("mij,mj->mi", inverse, b * scale) * scale


def _by_blocks(rows: DataFrame, run, schema) -> DataFrame:
    """``run`` over the rows of whole images, as many as an Arrow batch has. Few bytes, much work: a fixed number of
    partitions keeps AQE from putting all images into one task."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def blocks(batches):
        held: list[pd.DataFrame] = []  # the last image of a batch may go on in the next
        for batch in batches:
            ids = batch["image_id"].to_numpy()
            cut = int(np.searchsorted(ids, ids[-1]))
            if held and (cut or held[-1]["image_id"].iloc[-1] != ids[0]):
                yield run(pd.concat([*held, batch.iloc[:cut]], ignore_index=True))
                held = []
            elif cut:
                yield run(batch.iloc[:cut])
            held.append(batch.iloc[cut:])
        if held:
            yield run(pd.concat(held, ignore_index=True))

    return rows.repartition(tasks, "image_id").sortWithinPartitions("image_id").mapInPandas(blocks, schema)


def _rows(pairs: DataFrame, images: DataFrame) -> tuple[DataFrame, list[str]]:
    wcs = [c for c in images.columns if c in WCS or c.startswith("pv2_")]
    keep = [c for c in ("image_id", "radeg", "decdeg", "x_image", "y_image", "image_dxy") if c in pairs.columns]
    return pairs.select(*keep).join(images.select("image_id", *wcs), "image_id"), wcs


def _start(pdf: pd.DataFrame, wcs: list[str]) -> dict[str, float]:
    return {c: float(pdf[c].iloc[0]) for c in wcs if pd.notna(pdf[c].iloc[0])}


def fit_astrometry(pairs: DataFrame, images: DataFrame, params: list[str] | None = None, proj: str = "TAN", steps: int = 4, robust: bool = False) -> DataFrame:
    """Images with fitted ``params`` (default CRVAL and CD; also crpix1/2, pv2_n) and astchi2 (sum of squared
    pixel residuals over image_dxy), astndf = 2 n - k, astwssr (their ratio), astscatt. ``pairs`` holds image_id,
    radeg, decdeg, x_image, y_image and perhaps image_dxy; ``robust`` weighs by 1 / (1 + r^2). Images with fewer pairs
    than parameters keep theirs and have null statistics."""
    params = params or LINEAR
    rows, wcs = _rows(pairs, images)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        block = _Block(pdf, wcs, params, proj)
        if not len(block.ids):
            return pd.DataFrame(columns=names)
        for _ in range(steps):
            a, b, *_ = block.normal(params, robust)
            for c, v in zip(params, _solved(a, b).T):
                block.p[c] = block.p[c] + v
        _, _, chi2, rx, ry = block.normal([], False)
        r = np.hypot(rx, ry)
        found = block.sums(np.isfinite(r).astype(np.int64))
        ndf = 2 * found - len(params)
        scatter = [float(np.median(x[np.isfinite(x)]) / 0.67) if n else math.nan for x, n in zip(np.split(r, block.first[1:]), found)]
        wssr = np.where(ndf > 0, chi2 / np.maximum(ndf, 1), np.nan)
        return pd.DataFrame({"image_id": block.ids, **{f"_{c}": block.p[c] for c in params}, "astchi2": chi2, "astndf": ndf, "astwssr": wssr, "astscatt": scatter})

    names = ["image_id", *[f"_{c}" for c in params], "astchi2", "astndf", "astwssr", "astscatt"]
    kinds = {"image_id": T.LongType(), "astndf": T.LongType()}
    schema = T.StructType([T.StructField(n, kinds.get(n, T.DoubleType())) for n in names])
    found = _by_blocks(rows, run, schema).withColumn("astwssr", F.nanvl("astwssr", F.lit(None).cast("double")))
    out = images.drop("astchi2", "astndf", "astwssr", "astscatt").join(found, "image_id", "left")
    return out.withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in params}).drop(*[f"_{c}" for c in params])


def fit_astrometry_clipped(pairs: DataFrame, images: DataFrame, astsigma: float = 1.0, astvar: float = 1.0, **options) -> DataFrame:
    """A robust fit, then a fit of the pairs within 3 sqrt(astsigma^2 + image_dxy^2 astvar) of it."""
    from ..functions.astrom import world2pix

    first = fit_astrometry(pairs, images, robust=True, **options).select(*images.columns)
    rows, _ = _rows(pairs, first)
    rows = world2pix(rows, options.get("proj", "TAN"), out=("_px", "_py"))
    e2 = F.pow(F.col("image_dxy"), F.lit(2)) if "image_dxy" in pairs.columns else F.lit(0.0)
    good = F.hypot(F.col("x_image") - F.col("_px"), F.col("y_image") - F.col("_py")) < 3 * F.sqrt(F.lit(astsigma) ** 2 + e2 * astvar)
    keep = [c for c in ("image_id", "radeg", "decdeg", "x_image", "y_image", "image_dxy") if c in pairs.columns]
    return fit_astrometry(rows.where(good).select(*keep), first, **options)


def fit_astrometry_shared(pairs: DataFrame, images: DataFrame, shared: list[str] | None = None, own: list[str] | None = None, proj: str = "TAN", steps: int = 4) -> DataFrame:
    """Per-image ``own`` parameters and ``shared`` ones (default CRPIX) in one system: each image's block is
    eliminated where its row is, the reduced blocks are summed, the shared step is solved once and put back. The
    shared start is the first image's. Images whose values are null or that have too few pairs keep theirs."""
    shared, own = shared or ["crpix1", "crpix2"], own or LINEAR
    params, g, start = [*shared, *own], len(shared), images
    k, size = len(params), g * g + g
    pairs = staged(pairs.select(*[c for c in ("image_id", "radeg", "decdeg", "x_image", "y_image", "image_dxy") if c in pairs.columns]), "pairs")  # each step reads them
    for _ in range(steps):
        rows, wcs = _rows(pairs, images)

        def equations(pdf: pd.DataFrame) -> pd.DataFrame:
            block = _Block(pdf, wcs, params, proj)
            if not len(block.ids):
                return pd.DataFrame(columns=["image_id", "a", "b"])
            a, b, *_ = block.normal(params, False)
            return pd.DataFrame({"image_id": block.ids, "a": list(a.reshape(len(a), -1)), "b": list(b)})

        sums = _by_blocks(rows, equations, "image_id long, a array<double>, b array<double>")
        sums = staged(sums, "equations")

        def reduce(batches):
            total = np.zeros(size)
            for pdf in batches:
                for a, b in zip(pdf["a"], pdf["b"]):
                    a, b = np.array(a).reshape(k, k), np.array(b)
                    inverse = solve(a[g:, g:], b[g:])[1]
                    total[: g * g] += (a[:g, :g] - a[:g, g:] @ inverse @ a[g:, :g]).ravel()
                    total[g * g :] += b[:g] - a[:g, g:] @ inverse @ b[g:]
            yield pd.DataFrame({"i": range(size), "v": total})

        flat = np.zeros(size)
        for row in sums.mapInPandas(reduce, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # size rows
            flat[row.i] = row.v
        delta, _ = solve(flat[: g * g].reshape(g, g), flat[g * g :])

        def back(batches):
            for pdf in batches:
                out = []
                for image, a, b in zip(pdf["image_id"], pdf["a"], pdf["b"]):
                    a, b = np.array(a).reshape(k, k), np.array(b)
                    out.append((image, solve(a[g:, g:], b[g:] - a[g:, :g] @ delta)[0].tolist()))
                yield pd.DataFrame(out, columns=["image_id", "_b"])

        found = sums.mapInPandas(back, "image_id long, _b array<double>")
        moved = {p: F.col(p) + float(delta[n]) for n, p in enumerate(shared)} | {p: F.col(p) + F.coalesce(F.get("_b", F.lit(n)), F.lit(0.0)) for n, p in enumerate(own)}
        before, images = images, staged(images.join(found, "image_id", "left").withColumns(moved).drop("_b"), "projections")
        discard(sums, *([before] if hasattr(before, "_staged") and before is not start else []))
    return images


#: Terms that a polynomial projection may have beside PV2_1 = 1.
PV_TERMS = [f"pv2_{n}" for n in range(2, 8)]
#: A fit of a smaller chi2 per degree of freedom is exact; no test says anything about it.
EXACT = 1e-12
#: Refits of a trial projection without its outliers.
REFITS = 2


#: Columns of a parameter table.
NAMES = [*WCS, *[f"pv2_{n}" for n in range(1, 8)]]
AT = {name: n for n, name in enumerate(NAMES)}
PV = [AT[t] for t in PV_TERMS]
#: Cells of the arrays that one step fits together: what an image lacks of the pairs of the block's largest is padding.
CELLS = 1 << 15


def _plane(p: np.ndarray, proj: str, a: np.ndarray, sd: np.ndarray, cd: np.ndarray) -> tuple:
    """Of positions at ``a`` = RA - CRVAL1 (radians), what ``project`` makes of them before CD: x, y (degrees), and
    their derivatives by CRVAL1, CRVAL2 and the terms of the projection, as name -> (dx, dy)."""
    d0 = np.radians(p[:, AT["crval2"], None])
    sd0, cd0, sa, ca = np.sin(d0), np.cos(d0), np.sin(a), np.cos(a)
    c, sc, ss = sd * sd0 + cd * cd0 * ca, -cd * sa, sd * cd0 - cd * sd0 * ca
    by, slope_sc = {}, 0.0  # derivatives of ratio by terms, and by sc
    if proj == "TAN":
        ratio = 1 / np.where(c > 0, c, np.nan)
        slope = -ratio * ratio
    elif proj == "ZEA":
        ratio = np.sqrt(2 / (1 + c))
        slope = -ratio / (2 * (1 + c))
    elif proj == "AZP":
        mu, tilt = p[:, AT["pv2_1"], None], np.tan(np.radians(p[:, AT["pv2_2"], None]))
        below = mu + c + sc * tilt
        ratio = (mu + 1) / below
        slope, slope_sc, by["pv2_1"] = -ratio / below, -ratio / below * tilt, 1 / below - ratio / below
    else:  # ZPN, and ARC, which is its first term
        sinu = np.hypot(sc, ss)
        u, far = np.arctan2(sinu, c), sinu > 1e-6
        over = 1 / np.where(far, sinu, 1.0)
        r = steep = 0.0
        for n in range(7, 0, -1):
            k = p[:, AT[f"pv2_{n}"], None]
            r, steep = (r + k) * u, steep * u + n * k
        ratio = np.where(far, r * over, p[:, AT["pv2_1"], None])
        slope = np.where(far, (r * c - steep * sinu) * over**3, 0.0)
        power = u * over
        for t in PV_TERMS:
            power = power * u
            by[t] = power
    rad, deg = math.pi / 180, 180 / math.pi
    moves = {"crval1": (cd * cd0 * sa, cd * ca, -cd * sd0 * sa), "crval2": (ss, 0.0, -c)}  # of c, sc, ss
    out = {}
    for name, (dc, dsc, dss) in moves.items():
        step = slope * dc + slope_sc * dsc
        out[name] = (-(step * sc + ratio * dsc) * rad * deg, (step * ss + ratio * dss) * rad * deg)
    return -ratio * sc * deg, ratio * ss * deg, out | {t: (-v * sc * deg, v * ss * deg) for t, v in by.items()}


class _Images:
    """Fits of the pairs of many images at once, a row of each array an image. A model of them is (table of
    parameters, chi2, degrees of freedom); what is fitted of an image is a row of a mask over ``NAMES``."""

    def __init__(self, pdf: pd.DataFrame, n: np.ndarray, steps: int, alpha: float):
        """``pdf`` holds the images' pairs one after the other, ``n`` of each."""
        self.steps, self.alpha = steps, alpha
        self.there = np.arange(n.max())[None, :] < n[:, None]

        def spread(v: np.ndarray, fill: float) -> np.ndarray:
            out = np.full(self.there.shape, fill)
            out[self.there] = v
            return out

        column = lambda c: pdf[c].to_numpy(float, na_value=np.nan)
        self.ra, dec = spread(np.radians(column("radeg")), np.nan), spread(np.radians(column("decdeg")), np.nan)
        self.sd, self.cd = np.sin(dec), np.cos(dec)
        self.x, self.y = spread(column("x_image"), np.nan), spread(column("y_image"), np.nan)
        self.dxy = spread(column("image_dxy") if "image_dxy" in pdf else np.ones(len(pdf)), 1.0)
        self.w = 1 / self.dxy**2

    def _residuals(self, at: np.ndarray, p: np.ndarray, proj: str, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Residuals (image, axis, pair) of the images ``at`` and the derivatives (name, image, axis, pair) of pixels."""
        x, y, by = _plane(p, proj, self.ra[at] - np.radians(p[:, AT["crval1"], None]), self.sd[at], self.cd[at])
        c11, c12, c21, c22 = (p[:, AT[c], None] for c in ("cd1_1", "cd1_2", "cd2_1", "cd2_2"))
        det = c11 * c22 - c21 * c12
        pixels = lambda x, y: ((c22 * x - c12 * y) / det, (c11 * y - c21 * x) / det)
        q, s = pixels(x, y)
        r = np.stack([self.x[at] - p[:, AT["crpix1"], None] - q, self.y[at] - p[:, AT["crpix2"], None] - s], 1)
        j = np.zeros((len(names), *r.shape))
        for n, name in enumerate(names):
            if name in by:
                j[n, :, 0], j[n, :, 1] = pixels(*by[name])
            elif name.startswith("crpix"):
                j[n, :, int(name[-1]) - 1] = 1.0
            elif name.startswith("cd"):
                v = q if name[-1] == "1" else s
                j[n, :, 0], j[n, :, 1] = pixels(-v, 0.0) if name[2] == "1" else pixels(0.0, -v)
        return r, j

    def _steps(self, at: np.ndarray, p: np.ndarray, kept: np.ndarray, mask: np.ndarray, proj: str, robust: bool) -> np.ndarray:
        p, todo, last = p.copy(), np.arange(len(at)), np.full(len(at), np.inf)
        for _ in range(self.steps):
            fitted = np.flatnonzero(mask[todo].any(0))
            r, j = self._residuals(at[todo], p[todo], proj, [NAMES[n] for n in fitted])
            good = np.isfinite(r).all(1) & kept[todo]
            r = np.where(good[:, None], r, 0.0)
            w = self.w[at[todo]]
            w = np.where(good, w / (1 + (r * r).sum(1) * w) if robust else w, 0.0)
            chi2 = ((r * r).sum(1) * w).sum(1)
            go = ~((np.abs(last[todo] - chi2) <= 1e-9 * chi2) | (chi2 <= EXACT * kept[todo].sum(1)))
            if not go.any():
                break
            last[todo] = chi2
            todo, r, w, good = todo[go], r[go], w[go], good[go]
            own = mask[todo][:, fitted]
            j = np.where(good[:, None], j[:, go], 0.0).transpose(1, 0, 2, 3).reshape(len(todo), len(fitted), -1) * own[:, :, None]
            weighed = j * np.concatenate([w, w], 1)[:, None, :]
            a, b = weighed @ j.transpose(0, 2, 1), (weighed @ r.reshape(len(todo), -1, 1))[:, :, 0]
            a[:, np.arange(len(fitted)), np.arange(len(fitted))] += ~own  # what is not fitted has a step of 0
            sound = np.isfinite(a).all((1, 2)) & np.isfinite(b).all(1)
            step = np.zeros_like(b)
            step[sound] = _solved(a[sound], b[sound])
            p[todo[:, None], fitted] += step
        return p

    def fit(self, at: np.ndarray, start: np.ndarray, mask: np.ndarray, proj: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A fit of all pairs of the images ``at``, plain and then robust, and REFITS fits of the pairs within
        3 sqrt(scatter^2 + image_dxy^2 variance) of the one before: the scatter is the median residual over 0.67, the
        variance that of the residuals over image_dxy squared (at least 1), both of the model itself. A model is so
        judged without its own outliers."""
        k, kept = mask.sum(1), self.there[at].copy()
        p = self._steps(at, start, kept, mask, proj, False)
        todo = np.arange(len(at))
        for n in range(1 + REFITS):
            r = np.hypot(*self._residuals(at[todo], p[todo], proj, [])[0].transpose(1, 0, 2))
            seen, dxy = kept[todo] & np.isfinite(r), self.dxy[at[todo]]
            floor, variance = _medians(r, seen) / 0.67, np.maximum((_medians(r / dxy, seen) / 0.67) ** 2, 1.0)
            new = self.there[at[todo]] & (r < 3 * np.sqrt(floor[:, None] ** 2 + dxy * dxy * variance[:, None]))
            go = seen.any(1) & (2 * new.sum(1) > k[todo]) & (new != kept[todo]).any(1)
            todo, new = todo[go], new[go]
            if not len(todo):
                break
            if n:  # else there are outliers: they have drawn the plain fit
                kept[todo] = new
            p[todo] = self._steps(at[todo], p[todo], kept[todo], mask[todo], proj, not n)
        r = self._residuals(at, p, proj, [])[0]
        good = np.isfinite(r).all(1) & kept
        found = good.sum(1)
        chi2 = np.where(good, (r * r).sum(1) * self.w[at], 0.0).sum(1)
        return p, np.where(found > 0, chi2, np.inf), 2 * found - k

    def better(self, small: tuple, large: tuple, k: int) -> np.ndarray:
        """F test: do the ``k`` further parameters of the larger model pay?"""
        pays = [
            n > 0 and math.isfinite(c2) and c1 > EXACT * n and f_pvalue((c1 - c2) / k / max(c2 / n, 1e-300), k, n) < self.alpha
            for c1, c2, n in zip(small[1].tolist(), large[1].tolist(), large[2].tolist())
        ]
        return np.array(pays, bool)

    def polynomial(self, start: np.ndarray, mask: np.ndarray) -> tuple[tuple, np.ndarray]:
        """Terms of ZPN, added and dropped one at a time while the F test says so: models, and masks of the terms."""
        every = np.arange(len(start))
        best, chosen, todo = self.fit(every, start, mask, "ZPN"), np.zeros((len(start), len(PV)), bool), every

        def model(at: np.ndarray, terms: np.ndarray) -> tuple:
            """A trial starts from the best model so far, with new terms at 0."""
            p, fitted = best[0][at].copy(), mask[at].copy()
            p[:, PV] = np.where(terms, p[:, PV], 0.0)
            fitted[:, PV] = terms
            return self.fit(at, p, fitted, "ZPN")

        def trials(todo: np.ndarray, add: bool) -> tuple[np.ndarray, np.ndarray]:
            """The trial of least chi2 of each image that adds a term or drops one: where there is one, and its term."""
            least, term, found = np.full(len(start), np.inf), np.full(len(start), -1), {}
            for t in range(len(PV)):
                at = todo[chosen[todo, t] != add]
                if not len(at):
                    continue
                terms = chosen[at].copy()
                terms[:, t] = add
                m, now = model(at, terms), tuple(v[at] for v in best)
                takes = self.better(now, m, 1) if add else ~self.better(m, now, 1)
                takes &= (m[1] < least[at]) | (term[at] < 0)
                term[at[takes]], least[at[takes]] = t, m[1][takes]
                for i in np.flatnonzero(takes):
                    found[at[i]] = tuple(v[i] for v in m)
            return term, found

        def take(at: np.ndarray, term: np.ndarray, found: dict, add: bool) -> None:
            for i in at:
                for v, new in zip(best, found[i]):
                    v[i] = new
                chosen[i, term[i]] = add

        for _ in range(2 * len(PV)):
            more, found = trials(todo, True)
            added = todo[more[todo] >= 0]
            take(added, more, found, True)
            less, found = trials(todo, False)
            dropped = todo[(less[todo] >= 0) & (best[1][todo] > EXACT * best[2][todo])]
            take(dropped, less, found, False)
            todo = np.union1d(added, dropped)
            if not len(todo):
                break
        return best, chosen

    def projection(self, start: np.ndarray, params: list[str], proj: str) -> tuple[tuple, np.ndarray]:
        """Best models of a projection, and masks of the terms of ZPN; CRPIX, where it is to be fitted, is held if a
        test says it may."""
        start = start.copy()
        start[:, AT["pv2_1"]] = {"ZPN": 1.0, "ARC": 1.0, "AZP": 0.1}.get(proj, 0.0)

        def fitted(names: list[str]) -> tuple[tuple, np.ndarray]:
            mask = np.zeros(start.shape, bool)
            mask[:, [AT[c] for c in names]] = True
            if proj == "ZPN":
                return self.polynomial(start, mask)
            mask[:, AT["pv2_1"]] = proj == "AZP"
            return self.fit(np.arange(len(start)), start, mask, proj), np.zeros((len(start), len(PV)), bool)

        best, terms = fitted(params)
        if "crpix1" in params and "crpix2" in params:
            held, its = fitted([c for c in params if c not in ("crpix1", "crpix2")])
            hold = ~self.better(held, best, 2)
            for v, new in zip((*best, terms), (*held, its)):
                v[hold] = new[hold]
        return best, terms


def _medians(v: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Medians by row of the values that are ``seen``; of none nan."""
    n, v = seen.sum(1), np.sort(np.where(seen, v, np.inf), 1)
    at = np.arange(len(v))
    return np.where(n > 0, (v[at, np.maximum(n - 1, 0) // 2] + v[at, np.minimum(n // 2, v.shape[1] - 1)]) / 2, np.nan)


def select_projection(pairs: DataFrame, images: DataFrame, projections: tuple[str, ...] = ("TAN", "ZEA", "AZP", "ZPN"), params: list[str] | None = None, alpha: float = 0.05, steps: int = 8) -> DataFrame:
    """Images with the projection of least chi2 per degree of freedom (ties: first in the list) as ``proj``, its
    fitted ``params`` (default CRVAL and CD), pv2_1 .. pv2_7 (null where it has none), astchi2, astndf, astwssr.

    Every trial is refitted without its own outliers (``_Images.fit``). AZP fits mu (pv2_1, from 0.1; no tilt). ZPN chooses its terms stepwise by F tests of one parameter; without terms it
    is ARC. CRPIX, where ``params`` has it, is fitted only if an F test of both together says so, else it keeps its
    value. All fits of an image run where its pairs are, after one shuffle, those of the images of a batch together:
    a trial is one for all of them that still make it. Images with fewer pairs than parameters
    keep theirs, with null ``proj``.
    """
    params = params or LINEAR
    if unknown := set(projections) - {"TAN", "ZEA", "AZP", "ZPN", "ARC"}:
        raise ValueError(f"no choice of {sorted(unknown)}")
    rows, wcs = _rows(pairs, images.drop(*[c for c in images.columns if c.startswith("pv2_")]))
    terms = ["pv2_1", *PV_TERMS]
    names = ["image_id", "proj", *[f"_{c}" for c in params], *terms, "astchi2", "astndf", "astwssr"]

    def chosen(pdf: pd.DataFrame, ids: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        first = np.cumsum(n) - n
        start = np.zeros((len(ids), len(NAMES)))
        for c in WCS:
            start[:, AT[c]] = pdf[c].to_numpy(float, na_value=np.nan)[first]
        block = _Images(pdf, n, steps, alpha)
        with np.errstate(all="ignore"):  # trials may leave the sky
            models = [block.projection(start, params, proj) for proj in projections]
        out = []
        for i, image in enumerate(ids):
            score = [round(float(m[1][i] / m[2][i]), 9) if m[2][i] > 0 else math.inf for m, _ in models]
            k = min(range(len(models)), key=score.__getitem__)
            proj, ((p, chi2, ndf), its) = projections[k], models[k]
            pv = dict.fromkeys(terms)
            if proj in ("AZP", "ZPN"):
                pv["pv2_1"] = p[i, AT["pv2_1"]]
                pv |= {"pv2_2": 0.0} if proj == "AZP" else {t: p[i, AT[t]] for t, has in zip(PV_TERMS, its[i]) if has}
            name = "ARC" if proj == "ZPN" and not its[i].any() else proj
            out.append([image, name, *[p[i, AT[c]] for c in params], *pv.values(), chi2[i], ndf[i], chi2[i] / ndf[i] if ndf[i] > 0 else None])
        return pd.DataFrame(out, columns=names)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, first, n = np.unique(pdf["image_id"].to_numpy(), return_index=True, return_counts=True)
        keep = 2 * n > len(params) + 1
        for c in WCS:
            keep &= np.isfinite(pdf[c].to_numpy(float, na_value=np.nan)[first])
        done = [pd.DataFrame(columns=names)]
        order = np.flatnonzero(keep)
        order = order[np.argsort(n[order], kind="stable")]  # images of like numbers of pairs together: little padding
        while len(order):
            some = order[: max(1, int(CELLS // n[order[: max(1, CELLS // n[order[0]])][-1]]))]
            order = order[len(some) :]
            at = np.concatenate([np.arange(first[i], first[i] + n[i]) for i in some])
            done.append(chosen(pdf.iloc[at], ids[some], n[some]))
        return pd.concat(done[1:] or done, ignore_index=True)

    kinds = {"image_id": T.LongType(), "astndf": T.LongType(), "proj": T.StringType()}
    found = _by_blocks(rows, run, T.StructType([T.StructField(n, kinds.get(n, T.DoubleType())) for n in names]))
    out = images.drop("proj", *terms, "astchi2", "astndf", "astwssr").join(found, "image_id", "left")
    return out.withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in params}).drop(*[f"_{c}" for c in params])


def camera_priors(images: DataFrame, cameras: DataFrame) -> DataFrame:
    """Adds the camera's crpix1, crpix2 (and its pv2 columns) by chip_id, moved for cropped or binned frames:
    crpix * ltm + ltv; images of unknown cameras keep theirs."""
    prior = cameras.select("chip_id", *[F.col(c).alias(f"_prior_{c}") for c in cameras.columns if c != "chip_id"])
    rows = images.join(prior, "chip_id", "left")
    get = lambda c, d: F.coalesce(F.col(c), F.lit(d)) if c in images.columns else F.lit(d)
    new = {}
    for c in cameras.columns:
        if c in ("crpix1", "crpix2"):
            axis = c[-1]
            value = F.col(f"_prior_{c}") * get(f"ltm{axis}_{axis}", 1.0) + get(f"ltv{axis}", 0.0)
        elif c != "chip_id":
            value = F.col(f"_prior_{c}")
        else:
            continue
        new[c] = F.coalesce(value, F.col(c)) if c in images.columns else value
    return rows.withColumns(new).drop(*[f"_prior_{c}" for c in cameras.columns if c != "chip_id"])


def to_tan_sip(images: DataFrame, proj: str, order: int = 3, grid: int = 15) -> DataFrame:
    """(image_id, tan_cd1_1.., sip_a, sip_b, sip_rms): a TAN projection with SIP terms of ``order`` that stands
    for ``proj`` over the image: least squares with weights 1 / (1 + r^2 / R^2) over a grid x grid of pixels gives CD (the
    linear part) and, of the higher powers, A and B; rms in pixels."""
    from ..functions.astrom import pix2world, plane

    at = F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))
    rows = images.withColumn("_i", at).withColumn("_j", at)
    rows = rows.withColumns({"_x": F.col("_i") * F.col("imgaxis1") / (grid - 1), "_y": F.col("_j") * F.col("imgaxis2") / (grid - 1)})
    rows = pix2world(rows, proj, "_x", "_y", ("_ra", "_dec"))
    x1, y1 = plane(rows, "TAN", F.col("_ra"), F.col("_dec"))
    rows = rows.select("image_id", (F.col("_x") - F.col("crpix1")).alias("u"), (F.col("_y") - F.col("crpix2")).alias("v"), x1.alias("x1"), y1.alias("y1"))
    powers = [(i, total - i) for total in range(1, order + 1) for i in range(total, -1, -1)]  # (1, 0), (0, 1) first

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:  # grid * grid rows
        u, v = pdf["u"].to_numpy(), pdf["v"].to_numpy()
        r2 = u * u + v * v
        w = 1 / (1 + r2 / r2.max())
        scale = math.sqrt(r2.max())
        x = np.stack([(u / scale) ** i * (v / scale) ** j for i, j in powers], 1)
        t = pdf[["x1", "y1"]].to_numpy()
        beta = np.linalg.lstsq(x * w[:, None], t * w[:, None], rcond=None)[0]
        cd = beta[:2].T / scale
        shift = np.linalg.solve(cd, beta[2:].T)
        rest = np.linalg.solve(cd, t.T) - np.stack([u, v]) - shift @ x[:, 2:].T
        maps = [[(f"{i}_{j}", b / scale ** (i + j)) for (i, j), b in zip(powers[2:], row)] for row in shift]
        rms = math.sqrt(np.mean(np.square(rest).sum(0)))
        return pd.DataFrame([[pdf["image_id"].iloc[0], *cd.ravel(), maps[0], maps[1], rms]], columns=["image_id", "tan_cd1_1", "tan_cd1_2", "tan_cd2_1", "tan_cd2_2", "sip_a", "sip_b", "sip_rms"])

    schema = "image_id long, tan_cd1_1 double, tan_cd1_2 double, tan_cd2_1 double, tan_cd2_2 double, sip_a array<struct<k:string,v:double>>, sip_b array<struct<k:string,v:double>>, sip_rms double"
    out = rows.groupBy("image_id").applyInPandas(_as_structs(fit), schema)
    return out.withColumns({c: F.map_from_entries(c) for c in ("sip_a", "sip_b")})


def _as_structs(f):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = f(pdf)
        for c in ("sip_a", "sip_b"):
            out[c] = [[{"k": k, "v": float(v)} for k, v in pairs] for pairs in out[c]]
        return out

    return run
