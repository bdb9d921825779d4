"""Quality: random-indexing word vectors pooled per document, then a two-layer numpy network with a temperature.

A word's vector is its index vector, sparse and random by its hash, plus its context vector, the sum of its neighbours'
index vectors over the whole corpus. Context vectors are kept in 2**slots slots that words are hashed into, so the
table does not grow with the vocabulary, and words that share a slot share the sum of their contexts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _SEPARATOR, U64, WORD_BYTES, Steps, mix, span_hash, spans, text_of
from .learning import share_of_ones, training_ids
from .toxicity import scored

#: Letters, digits and bytes of other letters are one kind of run, other marks another.
_KIND = np.where(_SEPARATOR, 0, 2 - WORD_BYTES).astype(np.uint8)
_UPPER, _DIGIT = np.zeros(256, np.int64), np.zeros(256, np.int64)
_UPPER[65:91] = 1
_DIGIT[48:58] = 1
SHAPES = 32
EXTRA = 4


@dataclass
class Settings:
    slots: int = 14  #: bits of the table of context vectors, which words are hashed into
    dimensions: int = 48
    marks: int = 4  #: entries of +1 or -1 in a word's index vector
    window: int = 2
    hidden: int = 32
    per_class: int = 2500  #: labelled documents of each class that training reads at most
    epochs: int = 60
    rate: float = 0.005
    seed: int = 4


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document and shape (case, digits and length of words; length of marks) of each run, in order."""
    start, end = spans(data, bounds, _KIND)
    if not len(start):
        return np.zeros(0, U64), start, start
    size = end - start
    upper, digit = (np.concatenate(([0], np.cumsum(x[data]))) for x in (_UPPER, _DIGIT))
    up, figures = upper[end] - upper[start], digit[end] - digit[start]
    word = _KIND[data[start]] == 1
    case = np.where(figures > 0, 3, np.where((up == size) & (size > 1), 2, np.where(up > 0, 1, 0)))
    shape = np.where(word, case * 6 + np.minimum(size // 4, 5), 24 + np.minimum(size, 7))
    return span_hash(data, start, end), np.searchsorted(bounds, start, "right") - 1, shape


def marks(h: np.ndarray, s: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and signs of the entries of the words' index vectors, which follow from their hashes."""
    out = []
    for j in range(s.marks):
        r = mix(h + U64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
        out.append(((r % U64(s.dimensions)).astype(np.int64), np.where(r >> U64(63), 1, -1)))
    return out


def slots(h: np.ndarray, s: Settings) -> np.ndarray:
    return (h >> U64(64 - s.slots)).astype(np.int64)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-6)


def contexts(docs: DataFrame, s: Settings) -> np.ndarray:
    """Of each slot: the sum of the index vectors of the neighbours of its words in all documents, at unit length.

    A task adds its documents up in one table, and Spark adds the tables' rows; 2**slots rows reach the driver.
    """
    names = [f"c{i}" for i in range(s.dimensions)]

    def add(batches):
        total = np.zeros((1 << s.slots) * s.dimensions, np.int64)
        for batch in batches:
            for _, _, data, bounds in Steps(batch.column(0)):
                h, doc, _ = tokens(data, bounds)
                base = slots(h, s) * s.dimensions
                places = marks(h, s)
                for lag in range(1, s.window + 1):
                    near = np.flatnonzero(doc[lag:] == doc[:-lag])
                    for place, sign in places:
                        np.add.at(total, base[near + lag] + place[near], sign[near])
                        np.add.at(total, base[near] + place[near + lag], sign[near + lag])
        total = total.reshape(-1, s.dimensions)
        some = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(total[some, i]) for i in range(s.dimensions)]], ["slot", *names])

    sums = docs.select(text_of().alias("text")).mapInArrow(add, "slot long, " + ", ".join(f"{n} long" for n in names))
    found = sums.groupBy("slot").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    table = np.zeros((1 << s.slots, s.dimensions))
    table[found["slot"].to_numpy(np.int64)] = found[names].to_numpy(np.float64)
    return unit(table).astype(np.float32)


def shape_vectors(s: Settings) -> np.ndarray:
    index = np.zeros((SHAPES, s.dimensions), np.float32)
    for place, sign in marks(mix(np.arange(SHAPES, dtype=U64) + U64(s.seed)), s):
        np.add.at(index, (np.arange(SHAPES), place), sign)
    return unit(index)


def pool(h: np.ndarray, doc: np.ndarray, shape: np.ndarray, n: int, table: np.ndarray, s: Settings) -> np.ndarray:
    """Of each of ``n`` documents: means of the words' index vectors plus their context vectors and of the index
    vectors of their shapes, shares of words that equal the one, two and three places before them, and log length."""
    d = s.dimensions
    out = np.zeros((n, 2 * d + EXTRA), np.float32)
    if not len(h):
        return out
    start = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    own, count = doc[start], np.diff(np.concatenate((start, [len(doc)])))
    total = np.add.reduceat(table[slots(h, s)], start)
    for place, sign in marks(h, s):
        total += np.bincount(doc * d + place, weights=sign, minlength=n * d).reshape(n, d)[own] / np.sqrt(s.marks)
    out[own, :d] = total / count[:, None]
    kinds = np.bincount(doc * SHAPES + shape, minlength=n * SHAPES).reshape(n, SHAPES)[own]
    out[own, d : 2 * d] = (kinds / count[:, None]) @ shape_vectors(s)
    for lag in (1, 2, 3):
        same = np.zeros(len(h), np.int64)
        same[lag:] = (h[lag:] == h[:-lag]) & (doc[lag:] == doc[:-lag])
        out[own, 2 * d + lag - 1] = np.add.reduceat(same, start) / count
    out[own, -1] = np.log1p(count)
    return out


def pooled(texts: pa.Array, table: np.ndarray, s: Settings) -> np.ndarray:
    """The inputs of the network for each text."""
    out = np.zeros((len(texts), 2 * s.dimensions + EXTRA), np.float32)
    for first, end, data, bounds in Steps(texts):
        out[first:end] = pool(*tokens(data, bounds), end - first, table, s)
    return out


class Network:
    """Two layers on standardised inputs, by Adam; the temperature is fitted on a fifth of the sample."""

    def __init__(self, x: np.ndarray, y: np.ndarray, share: float, s: Settings):
        self.mean, self.spread = (x.mean(0), x.std(0) + 1e-3) if len(x) else (0.0, 1.0)
        self.constant = None
        if len(set(y.tolist())) < 2:
            self.constant = 4.0 if not len(y) or y[0] else -4.0
            return
        rng = np.random.default_rng(s.seed)
        order = rng.permutation(len(y))
        check, fit = order[: len(y) // 5], order[len(y) // 5 :]
        x = (x - self.mean) / self.spread
        self.w = [rng.normal(size=(x.shape[1], s.hidden)) / np.sqrt(x.shape[1]), np.zeros(s.hidden), rng.normal(size=s.hidden) / np.sqrt(s.hidden), np.zeros(1)]
        m, v, step = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        # Classes weigh the same in training; the share of label 1 among all labels then shifts the logits.
        own, share = np.clip((y[fit].mean(), share), 1e-3, 1 - 1e-3)
        weight = np.where(y == 1, 0.5 / own, 0.5 / (1 - own))
        self.shift = float(np.log(share / (1 - share)))
        for _ in range(s.epochs):
            for batch in np.array_split(rng.permutation(fit), max(1, len(fit) // 64)):
                h = np.maximum(x[batch] @ self.w[0] + self.w[1], 0)
                g = (1 / (1 + np.exp(-np.clip(h @ self.w[2] + self.w[3], -40, 40))) - y[batch]) * weight[batch] / len(batch)
                back = np.outer(g, self.w[2]) * (h > 0)
                step += 1
                for i, grad in enumerate((x[batch].T @ back + 1e-3 * self.w[0], back.sum(0), h.T @ g + 1e-3 * self.w[2], np.array([g.sum()]))):
                    m[i] = 0.9 * m[i] + 0.1 * grad
                    v[i] = 0.999 * v[i] + 0.001 * grad * grad
                    self.w[i] -= s.rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        z, t = self._logit(x[check]), y[check]
        real = np.where(t == 1, share / own, (1 - share) / (1 - own))
        loss = lambda c: np.mean(np.logaddexp(0, -(z / c + self.shift) * (2 * t - 1)) * real) if len(t) else 0
        self.temperature = min((float(c) for c in np.geomspace(0.5, 8, 33)), key=loss)

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            z = np.full(len(x), self.constant)
        else:
            z = self._logit((x - self.mean) / self.spread) / self.temperature + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def sample(docs: DataFrame, labels: DataFrame, table: np.ndarray, modulus: int, remainder: int, s: Settings) -> pd.DataFrame:
    """y and the network's inputs, as bytes, of the training rows: some hundred bytes a row, however long its text."""
    ids = training_ids(labels, "quality", modulus, remainder, s.per_class)

    def read(batches):
        for batch in batches:
            x = pooled(batch.column(2), table, s)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([row.tobytes() for row in x], pa.binary())], ["doc_id", "y", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = texts.join(F.broadcast(ids), "doc_id").select("doc_id", "y", "text")  # 2 * per_class ids at most
    return rows.mapInArrow(read, "doc_id long, y int, x binary").toPandas().sort_values(["doc_id", "x"], kind="stable")


def score_quality(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, modulus: int = 4, remainder: int = 2, threshold: float = 0.7, rows: DataFrame | None = None) -> DataFrame:
    """Score every whole text (of ``rows`` where given); learn from labelled rows of ``docs`` that are not held out.

    Returns per row: doc_id, held_out, score, predicted (1 if score >= ``threshold``). Word vectors come from all
    documents; the sample of labelled rows is bounded by ``Settings.per_class``. Nulls: a null text is empty; an empty
    text is scored as one of no words; a null id is never held out. Without labels of both classes the score is one
    constant. Repeated rows are scored each. Other columns are ignored. An empty table gives no rows.
    """
    s = settings or Settings()
    table = contexts(docs, s)
    train = sample(docs, labels, table, modulus, remainder, s)
    x = np.frombuffer(b"".join(train["x"]), np.float32).reshape(len(train), 2 * s.dimensions + EXTRA).astype(np.float64)
    network = Network(x, train["y"].to_numpy(np.int64), share_of_ones(labels, "quality", modulus, remainder), s)
    score = lambda texts: network(pooled(texts, table, s).astype(np.float64))
    return scored(docs if rows is None else rows, score, modulus, remainder, threshold)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from the rows that are not held out."""
    return score_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
