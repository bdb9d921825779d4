"""Whitening of embeddings: covariance by distributed partial sums, eigenvectors refined in mixed precision.

Entries become integers first, so counts, sums and deviations are exact. The covariance is a sum of centred products,
one small matrix per task. Only matrices of dimension x dimension reach the driver: their float32 eigenvectors are
corrected by matrix multiplications in extended precision (Ogita and Aishima), and eigenvalues that lie too close
together for that are told apart by solving the small problem within their cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDE = np.longdouble
#: Integer form of an entry c: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024.0, 100_000
#: Entries whose integer form is no long count as not finite.
LARGEST = 2.0**62
#: Tasks that form partial matrices, for each core of the cluster.
TASKS_PER_CORE = 4
#: Eigenvalues nearer than this, for a norm of 1, are told apart in their cluster: rounding would swamp their quotient.
CLOSE = 1e-10


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(length, start in the flattened values) per row; length -1 where the vector is null or holds an entry that is
    null or not finite."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    held = np.maximum(size, 0)
    start = np.cumsum(held) - held
    values = entries(column)
    bad = np.flatnonzero(~(np.abs(values) * SCALE < LARGEST))  # nan fails too
    size[np.searchsorted(start + held, bad, "right")] = -1
    return size, start


def entries(column: pa.Array) -> np.ndarray:
    """All entries in order as doubles, nulls as nan."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)


def integers(column: pa.Array, dim: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix of floor(SCALE * c) as doubles) for the vectors that count, by length."""
    size, start = vectors(column)
    values = entries(column)
    for d in np.unique(size) if dim is None else [dim]:
        if d >= 1:
            rows = np.flatnonzero(size == d)
            yield int(d), rows, np.floor(SCALE * values[start[rows][:, None] + np.arange(d)])


def _exact(x: np.ndarray) -> np.ndarray:
    """Whole doubles as integers: int64 where products with counts are safe, else Python's."""
    return x.astype(np.int64) if not x.size or np.abs(x).max() < 2**31 else np.frompyfunc(int, 1, 1)(x)


@dataclass
class Moments:
    """Count and exact sums of the integer vectors of ``dim`` entries."""

    dim: int
    n: int
    sums: list[int]

    @property
    def floor(self) -> list[int]:
        return [s // self.n for s in self.sums]

    @property
    def rest(self) -> list[int]:
        """n * mean less n * floor: from 0 to n - 1."""
        return [s % self.n for s in self.sums]

    def centred(self, whole: np.ndarray) -> np.ndarray:
        """x less the mean, for rows of floor(SCALE * c); exact up to one rounding."""
        floor = np.array([float(f - SHIFT) for f in self.floor])
        return (whole - floor) - np.array([r / self.n for r in self.rest])

    def deviation(self, whole: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)^2 of each row, null where it is no long."""
        off = whole - np.array([float(f - SHIFT) for f in self.floor])  # exact: sums of whole doubles under 2^53
        bound = (float(np.abs(off).max()) + 1) * self.n if off.size else 0.0
        rest = self.rest
        if bound * bound * self.dim < 2.0**62:
            v = off.astype(np.int64) * self.n - np.array(rest, np.int64)
            return (v * v).sum(axis=1).tolist()
        out = []
        for row in whole:
            s = sum((self.n * (int(c) + SHIFT) - t) ** 2 for c, t in zip(row, self.sums))
            out.append(s if s < 2**63 else None)
        return out


def fit_moments(rows: DataFrame, vector: str) -> Moments:
    """Count and sums over all vectors that count; of several lengths the greatest. Exact, and a row per task and entry."""

    def sums(batches):
        total: dict[int, list] = {}
        for batch in batches:
            for d, _, whole in integers(batch.column(0)):
                x = _exact(whole)
                n, s = total.get(d, (0, [0] * d))
                total[d] = (n + len(x), [a + int(b) for a, b in zip(s, x.sum(axis=0))])
        out = [(d, i, n, Decimal(v + n * SHIFT)) for d, (n, s) in total.items() for i, v in enumerate(s)]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)], ["d", "i", "n", "s"])

    parts = rows.select(vector).mapInArrow(sums, "d int, i int, n long, s decimal(38,0)")
    table = parts.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    dim = table.agg(F.max("d")).first()[0] or 0
    found = sorted(table.where(F.col("d") == dim).collect(), key=lambda row: row.i)  # one row a dimension
    return Moments(dim, int(found[0].n) if found else 0, [int(row.s) for row in found])


def _summed(rows: DataFrame, vector: str, moments: Moments, project: np.ndarray | None) -> np.ndarray:
    """Sum over all rows of z'z, z being the centred vectors, or (1, z * project) where ``project`` is given."""
    width = moments.dim if project is None else project.shape[1] + 1
    kind = "i int, v array<double>"

    def partial(batches):
        total = np.zeros((width, width))
        for batch in batches:
            for _, _, whole in integers(batch.column(0), moments.dim):
                z = moments.centred(whole)
                if project is not None:
                    z = np.column_stack((np.ones(len(z)), z @ project))
                total += z.T @ z
        yield _rows(range(width), total)

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for i, v in zip(batch.column(0).to_pylist(), values):
                total[i] = total[i] + v if i in total else v
        if total:
            yield _rows(list(total), np.array(list(total.values())))

    spark = rows.sparkSession
    few = rows.select(vector).coalesce(TASKS_PER_CORE * max(1, spark.sparkContext.defaultParallelism))
    out = np.zeros((width, width))
    for row in few.mapInArrow(partial, kind).repartition("i").mapInArrow(add, kind).collect():  # width rows
        out[row.i] = row.v
    return out


def _rows(keys, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(keys), pa.int32()), pa.array(list(values), pa.list_(pa.float64()))], ["i", "v"])


def _norm(m: np.ndarray) -> float:
    """Largest singular value: the double's is near enough for a threshold."""
    return float(np.linalg.norm(m.astype(np.float64), 2))


def refine(a: np.ndarray, x: np.ndarray, steps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of symmetric ``a`` (extended precision) from approximate vectors ``x``.

    A step multiplies matrices only: with R = I - X'X and S = X'AX, the eigenvalues are S_ii / (1 - R_ii) and X gets
    X * E, where E_ij = (S_ij + l_j R_ij) / (l_j - l_i), or R_ij / 2 where l_i and l_j are nearer than the error of S.
    Eigenvalues in a row that are that near form a cluster: its vectors are turned by the eigenvectors of the cluster's
    own small matrix X_c'(A - m)X_c, m being its mean, which has the cluster's spread and so resolves within it.
    """
    n, size = len(a), _norm(a)
    one, last = np.eye(n, dtype=WIDE), np.inf
    for _ in range(steps):
        r, s = one - x.T @ x, x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(values, kind="stable")
        x, values, r, s = x[:, order], values[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
        near = max(2 * (_norm(s - np.diag(values)) + size * _norm(r)), CLOSE * size)
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > near
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        cut = np.flatnonzero(np.diff(values) > near) + 1
        turned = 0.0
        for first, end in zip(np.concatenate(([0], cut)), np.concatenate((cut, [n]))):
            if end - first > 1:
                part, middle = x[:, first:end], values[first:end].mean()
                small = part.T @ (a @ part - middle * part)
                scale = np.abs(small).max()
                if scale > 0:
                    small = (small + small.T) / (2 * scale)
                    _, turn = np.linalg.eigh(small.astype(np.float64))
                    x[:, first:end] = part @ turn.astype(WIDE)
                    turned = max(turned, float(scale * np.abs(small - np.diag(np.diag(small))).max()))
        moved = float(np.abs(e).max()) + turned / (size or 1.0)
        if moved < 1e-18 or (moved < 1e-15 and moved >= last):
            break
        last = moved
    for _ in range(3):  # orthogonal to the last digits
        x = x + x @ (one - x.T @ x) / 2
    values = np.diag(x.T @ (a @ x)) / np.diag(x.T @ x)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix: float32 vectors, then ``refine``."""
    top = float(np.abs(v).max()) if v.size else 0.0
    if not top:
        return np.zeros(len(v)), np.eye(len(v))
    a = v.astype(WIDE) / WIDE(top)
    a = (a + a.T) / 2
    _, start = np.linalg.eigh(a.astype(np.float32))
    values, x = refine(a, start.astype(WIDE))
    x = x / np.sqrt((x * x).sum(axis=0))
    return (values * WIDE(top)).astype(np.float64), x.astype(np.float64)


@dataclass
class Whitening:
    """What ``fit`` found: moments, covariance, its first eigenvalues and vectors, and how far whitened vectors are
    from having the identity as covariance."""

    moments: Moments
    covariance: np.ndarray
    values: np.ndarray
    components: np.ndarray
    identity_error: float | None

    @property
    def live(self) -> np.ndarray:
        """Components of positive variance, beyond the rounding of the trace."""
        return self.values > max(self.trace, 0.0) * self.moments.dim * 2.0**-50

    @property
    def trace(self) -> float:
        return float(np.trace(self.covariance))

    @property
    def project(self) -> np.ndarray:
        """Components over the roots of their eigenvalues, the dead ones zero."""
        return np.where(self.live, self.components / np.sqrt(np.where(self.live, self.values, 1.0)), 0.0)


def fit(rows: DataFrame, vector: str = "embedding", k: int = 8) -> Whitening:
    """Moments, covariance and the first ``k`` components of all vectors that count: three passes over the rows."""
    moments = fit_moments(rows, vector)
    d = moments.dim
    if not moments.n:
        return Whitening(moments, np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0)), None)
    covariance = _summed(rows, vector, moments, None) / moments.n
    values, x = eigen(covariance)
    found = Whitening(moments, covariance, values[: min(k, d)], x[:, : min(k, d)], None)
    if found.live.any():
        sums = _summed(rows, vector, moments, found.project[:, found.live]) / moments.n
        mean = sums[0, 1:]
        found.identity_error = float(np.abs(sums[1:, 1:] - np.outer(mean, mean) - np.eye(len(mean))).max())
    return found


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 8) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error) for the first ``k`` components of
    every vector that counts.

    A row is left out where its vector is null, holds a null or non-finite entry or one whose integer form is no long,
    or is shorter than the longest vector; all others make up the covariance and come out, repeated rows and rows of a
    null or repeated id each for itself. Components of no variance (fewer different vectors than components) have a
    whitened value of null and explained 0, and are left out of identity_error (null where none is left). A deviation
    beyond the longs is null. An empty table, or one of empty vectors, gives no rows. Other columns are ignored.
    """
    found = fit(rows, vector, k)
    moments, live, project = found.moments, found.live if found.values.size else np.zeros(0, bool), None
    kept = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    kind = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not moments.n:
        return rows.sparkSession.createDataFrame([], kind)
    project, count = found.project, len(found.values)
    explained = np.where(live, found.values / found.trace if found.trace else 0.0, 0.0)
    error = found.identity_error

    def out(batches):
        names = [c.split()[0] for c in kind.split(", ")]
        for batch in batches:
            for _, at, whole in integers(batch.column(1), moments.dim):
                y = moments.centred(whole) @ project
                ids, deviation = batch.column(0).take(pa.array(at)), pa.array(moments.deviation(whole), pa.int64())
                each = pa.array(np.repeat(np.arange(len(at)), count))
                m = len(at) * count
                columns = [
                    ids.take(each), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(at))), pa.array(np.full(m, moments.n)), deviation.take(each),
                    pa.array(y.ravel(), mask=np.tile(~live, len(at))), pa.array(np.tile(explained, len(at))), pa.array([error] * m, pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return kept.mapInArrow(out, kind)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of every embedding; see ``whiten`` for odd rows. SQL has no eigenvectors:
    a test holds the query to a brute-force version."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
