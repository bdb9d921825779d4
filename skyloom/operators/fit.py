"""Weighted least squares of the photometric response by aggregated moments.

A fit of k terms is one aggregate of k(k+1)/2 + k sums over the pairs, whatever the number of pairs or images; the
small matrix is solved with numpy. Terms with a coefficient per image are eliminated per image (Schur complement), so
thousands of images do not widen the matrix. Fit weights are err^-5 (errors to the power 2.5 divide the residual);
statistics use the residual over the error.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.response import eval_response, factor, is_linear, split_term, term_columns
from ..staging import discard, staged
from .quantile import exact_quantile


@dataclass
class Fit:
    """Coefficients and errors by term, statistics and, for terms per image, a DataFrame (image_id, term, value, err)."""

    values: dict[str, float]
    errors: dict[str, float]
    ndf: int = 0
    wssr: float = 0.0
    variance: float = 0.0
    sigma: float = 0.0
    wssrndf: float = 0.0
    per_image: DataFrame | None = None
    fixed: dict[str, float] = field(default_factory=dict)

    @property
    def model(self) -> dict[str, float]:
        return {**self.fixed, **self.values}

    def table(self, spark) -> DataFrame:
        """(term, value, err, fixed)."""
        rows = [(t, float(v), float(self.errors.get(t, 0.0)), False) for t, v in self.values.items()]
        rows += [(t, float(v), 0.0, True) for t, v in self.fixed.items()]
        return spark.createDataFrame(rows, "term string, value double, err double, fixed boolean")


def moments(xs: list[Column], t: Column, w: Column) -> list[Column]:
    """Aggregates: the upper triangle of X'WX, then X'Wt, t'Wt and the count."""
    pairs = [F.sum(w * xs[i] * xs[j]) for i in range(len(xs)) for j in range(i, len(xs))]
    return [F.array(*pairs, *[F.sum(w * x * t) for x in xs], F.sum(w * t * t), F.count(F.lit(1)).cast("double")).alias("m")]


def unpack(m, k: int) -> tuple[np.ndarray, np.ndarray, float, float]:
    m = np.array([0.0 if v is None else v for v in m], float)
    a = np.zeros((k, k))
    rows, cols = np.triu_indices(k)
    a[rows, cols] = a[cols, rows] = m[: len(rows)]
    b = m[len(rows) : len(rows) + k]
    return a, b, m[-2], m[-1]


def solve(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Solution and its covariance; columns are scaled first, the pseudo-inverse serves deficient matrices."""
    scale = 1 / np.sqrt(np.maximum(np.diag(a), 1e-300))
    scaled = a * np.outer(scale, scale)
    inverse = np.linalg.inv(scaled) if np.linalg.cond(scaled) < 1e12 else np.linalg.pinv(scaled, rcond=1e-12)
    cov = inverse * np.outer(scale, scale)
    return cov @ b, cov


def _weight(err: str, robust: Column | None = None) -> Column:
    w = F.pow(F.col(err), F.lit(-5))
    return w if robust is None else w * robust


def _narrow(pairs: DataFrame, terms: list[str], y: str, mag: str, err: str, mask: Column | None = None) -> DataFrame:
    """The few columns that a fit of ``terms`` reads, staged, as each step reads them anew; ``mask`` comes as _mask."""
    wanted = {"image_id", y, mag, err} | term_columns(terms)
    columns = [F.col(c) for c in pairs.columns if c in wanted]
    return staged(pairs.select(*columns, *([F.coalesce(mask, F.lit(False)).alias("_mask")] if mask is not None else [])), "pairs")


def _statistics(fit: Fit, rows: DataFrame, err: str, k: int) -> Fit:
    """Fills in what residuals ``_r`` say. The scatter is an exact median that no task gathers the residuals for."""
    values = staged(rows.select(F.abs("_r").alias("r"), (F.col("_r") / F.col(err)).alias("q")), "residuals")
    s = values.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pow("q", F.lit(2))).alias("wssr"), F.stddev_pop("q").alias("v")).first()
    fit.ndf = int(s.n) - k
    fit.wssr, fit.variance, fit.sigma = float(s.wssr or 0), float(s.v or 0), (exact_quantile(values, F.col("r")) or 0.0) / 0.67
    fit.wssrndf = fit.wssr / fit.ndf if fit.ndf > 0 else float("nan")
    discard(values)
    return fit


def fit_photometry(pairs: DataFrame, terms: list[str], fixed: dict[str, float] | None = None, init: dict[str, float] | None = None, robust: bool = False, y: str = "cat_mag", mag: str = "mag_auto", err: str = "dy", mask: Column | None = None, steps: int = 8) -> Fit:
    """Coefficients of ``terms`` (global, or ``:n`` for one image) with ``fixed`` ones held.

    Linear terms need one aggregate. Non-linear terms (XC, SC, RS, RO, RC, GA, GW, EA, EW) start from ``init`` and take
    Gauss-Newton steps on derivative columns, an aggregate each. ``robust`` reweights by 1 / (1 + r^2) (Cauchy loss).
    Returns a Fit: errors are roots of the diagonal of the inverse normal matrix, NDF = n - k.
    """
    fixed, values = dict(fixed or {}), {t: float((init or {}).get(t, 0.0)) for t in terms}
    narrow = None if hasattr(pairs, "_staged") else _narrow(pairs, [*terms, *fixed], y, mag, err, mask)
    rows = narrow.where("_mask") if narrow is not None and mask is not None else narrow if narrow is not None else pairs if mask is None else pairs.where(mask)
    linear = all(is_linear(t) for t in terms)
    once = linear and not robust
    errors: dict[str, float] = {}

    def design(term: str) -> Column:
        base, n = split_term(term)
        if is_linear(term):
            x = factor(rows, base, mag)
            return x if n is None else F.when(F.col("image_id") == n, x).otherwise(F.lit(0.0))
        h = 1e-4
        up, down = ({**fixed, **values, term: values[term] + d} for d in (h, -h))
        wide = eval_response(eval_response(rows, up, mag, out="_u"), down, mag, out="_v")
        return ("wide", wide, h)

    if linear:
        base = eval_response(rows, fixed, mag, out="_base") if fixed else rows.withColumn("_base", F.col(mag))
        for step in range(1 if once else steps):
            t = F.col(y) - F.col("_base")
            xs = [design(term) for term in terms]
            weight = None
            if robust and step:
                r = (t - sum((values[term] * x for term, x in zip(terms, xs)), F.lit(0.0))) / F.pow(F.col(err), F.lit(2.5))
                weight = 1 / (1 + r * r)
            a, b, _, _ = unpack(base.agg(*moments(xs, t, _weight(err, weight))).first().m, len(terms))
            beta, cov = solve(a, b)
            values = dict(zip(terms, beta.tolist()))
            errors = dict(zip(terms, np.sqrt(np.abs(np.diag(cov))).tolist()))
    else:
        for _ in range(steps):
            cur = eval_response(rows, {**fixed, **values}, mag, out="_cur")
            xs, h = [], 1e-4
            for n, term in enumerate(terms):
                up, down = ({**fixed, **values, term: values[term] + d} for d in (h, -h))
                cur = eval_response(eval_response(cur, up, mag, out=f"_u{n}"), down, mag, out=f"_d{n}")
                xs.append((F.col(f"_u{n}") - F.col(f"_d{n}")) / (2 * h))
            t = F.col(y) - F.col("_cur")
            weight = 1 / (1 + F.pow(t / F.pow(F.col(err), F.lit(2.5)), F.lit(2))) if robust else None
            a, b, _, _ = unpack(cur.agg(*moments(xs, t, _weight(err, weight))).first().m, len(terms))
            delta, cov = solve(a, b)
            values = {term: values[term] + d for term, d in zip(terms, delta.tolist())}
            errors = dict(zip(terms, np.sqrt(np.abs(np.diag(cov))).tolist()))
            if np.max(np.abs(delta)) < 1e-9:
                break
    out = Fit(values, errors, fixed=fixed)
    rest = eval_response(rows, out.model, mag, out="_m").withColumn("_r", F.col(y) - F.col("_m"))
    _statistics(out, rest, err, len(terms))
    if narrow is not None:
        discard(narrow)
    return out


def fit_per_image(pairs: DataFrame, common: list[str], per_image: list[str], y: str = "cat_mag", mag: str = "mag_auto", err: str = "dy") -> Fit:
    """Global terms and terms with a coefficient per image, in one pass whatever the number of images.

    Moments per image are one aggregate; each image's block is eliminated where its row is, the reduced blocks are
    summed, the small global system is solved, and each image substitutes back.
    """
    names, g = [*common, *per_image], len(common)
    k = len(names)
    pairs = _narrow(pairs, names, y, mag, err)
    xs = [factor(pairs, t, mag) for t in names]
    sums = pairs.groupBy("image_id").agg(*moments(xs, F.col(y) - F.col(mag), _weight(err)))
    sums = staged(sums, "moments")
    size = g * g + g

    def reduce(batches):
        total = np.zeros(size)
        for pdf in batches:
            for m in pdf["m"]:
                a, b, _, _ = unpack(m, k)
                inverse = solve(a[g:, g:], b[g:])[1]
                total[: g * g] += (a[:g, :g] - a[:g, g:] @ inverse @ a[g:, :g]).ravel()
                total[g * g :] += b[:g] - a[:g, g:] @ inverse @ b[g:]
        yield pd.DataFrame({"i": range(size), "v": total})

    beta, cov = np.zeros(0), np.zeros((0, 0))
    if g:
        flat = np.zeros(size)
        for row in sums.select("m").mapInPandas(reduce, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # size rows
            flat[row.i] = row.v
        beta, cov = solve(flat[: g * g].reshape(g, g), flat[g * g :])

    def back(batches):
        for pdf in batches:
            out = []
            for image, m in zip(pdf["image_id"], pdf["m"]):
                a, b, _, _ = unpack(m, k)
                own, inverse = solve(a[g:, g:], b[g:] - a[g:, :g] @ beta)
                spread = inverse @ a[g:, :g]
                e = np.sqrt(np.abs(np.diag(inverse + spread @ cov @ spread.T)))
                out += [(image, t, v, s) for t, v, s in zip(per_image, own, e)]
            yield pd.DataFrame(out, columns=["image_id", "term", "value", "err"])

    table = sums.mapInPandas(back, "image_id long, term string, value double, err double")
    fit = Fit(dict(zip(common, beta.tolist())), dict(zip(common, np.sqrt(np.abs(np.diag(cov))).tolist())), per_image=table)
    wide = table.groupBy("image_id").agg(F.map_from_entries(F.collect_list(F.struct("term", "value"))).alias("_own"))
    rows = pairs.join(wide, "image_id")
    value = F.col(mag) + sum((fit.values[t] * factor(pairs, t, mag) for t in common), F.lit(0.0))
    value = value + sum((F.element_at("_own", t) * factor(pairs, t, mag) for t in per_image), F.lit(0.0))
    images = sums.count()
    _statistics(fit, rows.withColumn("_r", F.col(y) - value), err, g + images * len(per_image))
    discard(pairs)
    return fit


def fit_clipped(pairs: DataFrame, terms: list[str], rounds: int = 3, mask: Column | None = None, **options) -> tuple[Fit, Column]:
    """Refits at most ``rounds`` times on rows with abs(residual) < 3 sqrt(WSSR/NDF) * err, a mask that is
    recomputed on all rows each time; stops when chi2 per degree of freedom is not better. Returns fit and mask."""
    y, mag, err = options.get("y", "cat_mag"), options.get("mag", "mag_auto"), options.get("err", "dy")
    pairs = _narrow(pairs, [*terms, *(options.get("fixed") or {})], y, mag, err, mask)
    best = fit_photometry(pairs, terms, mask=F.col("_mask") if mask is not None else None, **options)
    kept = mask if mask is not None else F.lit(True)
    for _ in range(rounds):
        residual = (F.col(y) - response_column(pairs, best.model, mag)) / F.col(err)
        new = F.abs(residual) < 3 * math.sqrt(max(best.wssrndf, 0.0))
        fit = fit_photometry(pairs, terms, mask=new, **options)
        if not fit.wssrndf < best.wssrndf:
            break
        best, kept = fit, new
    discard(pairs)
    return best, kept


def response_column(df: DataFrame, model: dict[str, float], mag: str = "mag_auto") -> Column:
    """The modelled magnitude as a column of linear terms."""
    out = F.col(mag)
    for term, value in model.items():
        base, n = split_term(term)
        part = float(value) * factor(df, base, mag)
        out = out + (part if n is None else F.when(F.col("image_id") == n, part).otherwise(F.lit(0.0)))
    return out


def f_pvalue(f: float, d1: float, d2: float) -> float:
    """P(F > f), by the continued fraction of the regularised incomplete beta function."""
    if not f > 0:
        return 1.0
    x, a, b = d2 / (d2 + d1 * f), d2 / 2, d1 / 2
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta(1 - x, b, a)
    return _beta(x, a, b)


def _beta(x: float, a: float, b: float) -> float:
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(max(x, 1e-300)) + b * math.log(max(1 - x, 1e-300))) / a
    tiny, c, d = 1e-300, 1.0, 1 / max(1 - (a + b) * x / (a + 1), 1e-300)
    value = d
    for m in range(1, 300):
        for n in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + n * d if abs(1 + n * d) > tiny else tiny)
            c = 1 + n / c if abs(1 + n / c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * value


@dataclass
class _Trial:
    """A set of terms with its fit (coefficients, chi2 per degree of freedom, degrees of freedom) and the cut that the
    rows of the fit passed: (coefficients, limit), None for all rows."""

    terms: list[str]
    beta: np.ndarray | None = None
    wssrndf: float = math.inf
    ndf: int = 0
    cut: tuple[np.ndarray, float] | None = None
    done: bool = False

    @property
    def wssr(self) -> float:
        return self.wssrndf * self.ndf


class _Trials:
    """Clipped fits of many sets of terms at once: a clip step of all of them is one pass over the rows, which sums up
    each trial's moments under its own mask."""

    def __init__(self, rows: DataFrame, every: list[str], y: str, mag: str, err: str):
        xs = [factor(rows, t, mag).cast("double") for t in every]
        self.every, self.k = every, len(every)
        self.table = rows.select(F.array(*xs, (F.col(y) - F.col(mag)).cast("double"), F.col(err).cast("double")).alias("v"))
        self.all = self._pass([(None, None)])[0]

    def _pass(self, cuts: list[tuple]) -> list[tuple[np.ndarray, np.ndarray, int, int]]:
        """For each (cut, cut before): the moments of (x, t) by the fit's weights, those by the errors' squares, and
        how many rows the two cuts treat differently, and how many pass."""
        k, size = self.k, (self.k + 1) ** 2

        def sums(batches):
            total, counts = np.zeros((len(cuts), 2 * size + 1)), np.zeros(len(cuts))
            for batch in batches:
                v = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, k + 2)
                v = v[np.isfinite(v).all(axis=1) & (v[:, -1] > 0)]
                z, e = v[:, :-1], v[:, -1]
                passes = lambda cut: np.abs(z[:, -1] - z[:, :-1] @ cut[0]) / e < cut[1] if cut is not None else np.ones(len(z), bool)  # noqa: B023,E731
                for n, (cut, before) in enumerate(cuts):
                    mask = passes(cut)
                    a, w = z[mask], e[mask]
                    total[n, :size] += (a.T @ (a / w[:, None] ** 5)).ravel()
                    total[n, size : 2 * size] += (a.T @ (a / w[:, None] ** 2)).ravel()
                    total[n, -1] += np.count_nonzero(mask != passes(before))
                    counts[n] += int(mask.sum())
            yield pd.DataFrame({"n": np.repeat(np.arange(len(cuts)), 2 * size + 2), "i": np.tile(np.arange(2 * size + 2), len(cuts)), "v": np.column_stack((total, counts)).ravel()})

        out = np.zeros((len(cuts), 2 * size + 2))
        parts = self.table.mapInArrow(lambda batches: (pa.RecordBatch.from_pandas(p, preserve_index=False) for p in sums(batches)), "n long, i long, v double")
        for row in parts.groupBy("n", "i").agg(F.sum("v").alias("v")).collect():  # trials x moments
            out[row.n, row.i] = row.v
        return [(m[:size].reshape(k + 1, k + 1), m[size : 2 * size].reshape(k + 1, k + 1), int(m[-2]), int(m[-1])) for m in out]

    def _fit(self, trial: _Trial, moments: tuple) -> tuple[np.ndarray, float, int]:
        a, b, _, n = moments
        at = [self.every.index(t) for t in trial.terms]
        beta = np.zeros(self.k)
        if at:
            beta[at] = solve(a[np.ix_(at, at)], a[at, -1])[0]
        full = np.append(-beta, 1.0)
        ndf = n - len(at)
        return beta, max(float(full @ b @ full), 0.0) / ndf if ndf > 0 else math.inf, ndf

    def run(self, sets: list[list[str]], steps: int = 3) -> list[_Trial]:
        """The trials of ``sets``, each fitted up to ``steps`` times on the rows within 3 sqrt(chi2 / NDF) errors of its
        fit before; a trial is done when its rows stay the same or chi2 / NDF is not less."""
        trials = [_Trial(terms) for terms in sets]
        for t in trials:
            t.beta, t.wssrndf, t.ndf = self._fit(t, self.all)
        for _ in range(steps - 1):
            open_ = [t for t in trials if not t.done]
            if not open_:
                break
            cuts = [((t.beta, 3 * math.sqrt(t.wssrndf) if math.isfinite(t.wssrndf) else math.inf), t.cut) for t in open_]
            for t, (cut, _), moments in zip(open_, cuts, self._pass(cuts)):
                if not moments[2]:
                    t.done = True
                    continue
                before = t.wssrndf
                t.cut = cut
                t.beta, t.wssrndf, t.ndf = self._fit(t, moments)
                t.done = not t.wssrndf < before
        for t in trials:
            if not t.done:  # the rows that the last fit would go on with
                t.cut = (t.beta, 3 * math.sqrt(t.wssrndf) if math.isfinite(t.wssrndf) else math.inf)
        return trials


def stepwise(pairs: DataFrame, candidates: list[str], always: list[str], init: dict[str, float] | None = None, alpha: float = 0.05, rounds: int = 100, y: str = "cat_mag", mag: str = "mag_auto", err: str = "dy") -> tuple[Fit, list[str]]:
    """Chooses terms: starts from ``always`` and the candidates with initial values, adds the candidate with the
    best F value and drops the one with the least while the F test (``alpha``, one parameter) says so; always-terms
    stay. Ties: first in the list.

    Every trial model is clipped on its own (see ``_Trials``), so a term that only follows a few outliers gains nothing
    by it. All additions of a round take two passes over the staged columns, all removals two more, whatever their
    number; the unclipped moments are one pass for all rounds. The last fit is on the rows that the cuts of all chosen
    models leave, without further clipping.
    """
    every = [*always, *[c for c in candidates if c not in always]]
    rows = _narrow(pairs, every, y, mag, err)
    trials = _Trials(rows, every, y, mag, err)
    best = trials.run([list(always)])[0]
    cuts = [best.cut]
    warm = [c for c in candidates if c in (init or {}) and c not in always]
    if warm:
        best = trials.run([[*always, *warm]])[0]
        cuts = [best.cut]
    f_of = lambda small, large: (small.wssr - large.wssr) / max(large.wssrndf, 1e-300) if large.ndf > 0 else 0.0
    pays = lambda small, large: f_of(small, large) > 0 and f_pvalue(f_of(small, large), 1, large.ndf) < alpha
    for _ in range(rounds):
        changed = False
        more = trials.run([[*best.terms, c] for c in every if c not in best.terms])
        more = [t for t in more if pays(best, t)]
        if more:
            base = best
            best, changed = max(more, key=lambda t: f_of(base, t)), True
            cuts.append(best.cut)
        less = trials.run([[t for t in best.terms if t != c] for c in best.terms if c not in always])
        full = best
        less = [t for t in less if f_of(t, full) > 0 and not pays(t, full)]
        if less:
            best, changed = min(less, key=lambda t: f_of(t, full)), True
            cuts.append(best.cut)
        if not changed:
            break
    mask = F.lit(True)
    for cut in cuts:
        if cut is not None and math.isfinite(cut[1]):
            model = {t: float(b) for t, b in zip(every, cut[0]) if b}
            mask = mask & (F.abs(F.col(y) - response_column(rows, model, mag)) / F.col(err) < float(cut[1]))
    fit = fit_photometry(rows, best.terms, y=y, mag=mag, err=err, mask=mask)
    discard(rows)
    return fit, best.terms


def effective_zeropoint(fit: Fit, images: DataFrame) -> DataFrame:
    """(image_id, magzero, dmagzero): the model at the image's centre, zero colours, its airmass and magnitude 0;
    the error is that of the image's own Z, else of the global one."""
    zero = {"mag_auto": 0.0, "coord_x": 0.0, "coord_y": 0.0, "color1": 0.0, "color2": 0.0, "color3": 0.0, "color4": 0.0, "adif": 0.0, "cat_x": 0.0, "cat_y": 0.0}
    airmass = F.col("airmass") if "airmass" in images.columns else F.lit(1.0)
    rows = images.select("image_id", airmass.alias("airmass_abs")).withColumns({k: F.lit(v) for k, v in zero.items()})
    rows = eval_response(rows, fit.model, out="_g")
    error = F.lit(fit.errors.get("Z", 0.0))
    for term, e in fit.errors.items():
        base, n = split_term(term)
        if base == "Z" and n is not None:
            error = F.when(F.col("image_id") == n, float(e)).otherwise(error)
    if fit.per_image is None:
        return rows.select("image_id", F.col("_g").alias("magzero"), error.alias("dmagzero"))
    own = fit.per_image.where("term = 'Z'").select("image_id", "value", "err")
    joined = rows.join(own, "image_id", "left")
    return joined.select("image_id", (F.col("_g") + F.coalesce("value", F.lit(0.0))).alias("magzero"), F.coalesce("err", error).alias("dmagzero"))


def calibrate(det: DataFrame, images: DataFrame, model: dict[str, float] | DataFrame) -> DataFrame:
    """Adds mag_calib (the model at zero colours), magerr_calib (the error and the zeropoint's, in quadrature).
    ``model`` is a dict of terms or a table (image_id, magzero, dmagzero); images of neither give null."""
    rows = det.join(images.select("image_id", "ctrx", "ctry"), "image_id")
    rows = rows.withColumns({"coord_x": (F.col("x_image") - F.col("ctrx")) / 1024, "coord_y": (F.col("y_image") - F.col("ctry")) / 1024})
    if isinstance(model, dict):
        out = eval_response(rows, model, out="mag_calib").withColumn("magerr_calib", F.col("magerr_auto"))
    else:
        out = rows.join(model.select("image_id", "magzero", "dmagzero"), "image_id", "left")
        out = out.withColumns({"mag_calib": F.col("mag_auto") + F.col("magzero"), "magerr_calib": F.sqrt(F.pow("magerr_auto", F.lit(2)) + F.pow("dmagzero", F.lit(2)))}).drop("magzero", "dmagzero")
    return out.drop("ctrx", "ctry", "coord_x", "coord_y")
