"""Toxicity: character n-gram embeddings averaged over a document into a linear softmax, trained jointly in numpy.

A word is the bag of its byte n-grams (with marks at its ends), so an unseen spelling shares vectors with seen ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, Steps, staged, text_of
from .common import _LOWER, _SEPARATOR
from .learning import held_out, training_ids

_TABLES = np.random.default_rng(77).integers(0, 2**64, (8, 256), dtype=U64)


@dataclass
class Settings:
    bits: int = 18  #: n-grams are hashed into 2**bits vectors
    dimensions: int = 8
    sizes: tuple[int, ...] = (3, 4, 5)  #: bytes of an n-gram
    per_class: int = 2500  #: labelled documents of each class that training reads at most
    bag_bytes: int = 1 << 28  #: of the sampled documents' bags that reach the driver at most, by a hash of ids
    epochs: int = 12
    rate: float = 0.5
    scale: float = 60.0  #: of the mean vector: a few words among hundreds must move the logits
    decay: float = 1e-4
    seed: int = 3


def ngrams(data: np.ndarray, bounds: np.ndarray, s: Settings):
    """Yields (document bounds, buckets, valid) of each n-gram size; one entry for each byte of the padded texts."""
    text = np.insert(_LOWER[data], bounds, 32)
    edge = bounds + np.arange(len(bounds))
    gap = _SEPARATOR[text]
    text = np.where(gap, np.uint8(32), text)
    n, most = len(text), max(s.sizes)
    text, gap = np.concatenate((text, np.full(most, 32, np.uint8))), np.concatenate((gap, np.ones(most, bool)))
    value, inner = np.zeros(n, U64), np.ones(n, bool)
    for j in range(most):
        value = value + _TABLES[j][text[j : n + j]]
        if j > 1:
            inner = inner & ~gap[j - 1 : n + j - 1]
        if j + 1 in s.sizes:
            yield edge, ((value * U64(0x9E3779B97F4A7C15)) >> U64(64 - s.bits)).astype(np.int64), inner


def features(texts: pa.Array, s: Settings) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Buckets and counts of each text."""
    buckets, counts = [], []
    for _, _, data, bounds in Steps(texts):
        sizes = list(ngrams(data, bounds, s))
        edge = sizes[0][0]
        for a, b in zip(edge[:-1], edge[1:]):
            got = np.unique(np.concatenate([x[a:b][ok[a:b]] for _, x, ok in sizes]), return_counts=True)
            buckets.append(got[0].astype(np.int32))
            counts.append(got[1].astype(np.float32))
    return buckets, counts


def train(buckets: list[np.ndarray], counts: list[np.ndarray], y: np.ndarray, s: Settings) -> tuple[np.ndarray, float]:
    """Joint training of vectors and softmax by Adagrad. Returns the n-grams' weights (vector . softmax) and the bias."""
    rng = np.random.default_rng(s.seed)
    vectors = rng.uniform(-1, 1, (1 << s.bits, s.dimensions)).astype(np.float32) / s.dimensions
    soft = (rng.normal(size=(s.dimensions, 2)) * 0.5).astype(np.float32)
    bias = np.zeros(2, np.float32)
    gv, gs, gb = np.full(1 << s.bits, 1e-8, np.float32), np.full((s.dimensions, 2), 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    if len(set(y.tolist())) < 2:  # nothing to tell apart
        return np.zeros(1 << s.bits, np.float32), (4.0 if len(y) and y[0] else -4.0)
    share = np.bincount(y, minlength=2) / len(y)
    bags = [(b, c * np.float32(s.scale / max(1.0, c.sum()))) for b, c in zip(buckets, counts)]
    for epoch in range(s.epochs):
        rate = np.float32(s.rate * (1 - epoch / s.epochs))
        for i in rng.permutation(len(bags)):
            b, x = bags[i]
            own = vectors[b]
            mean = x @ own
            z = mean @ soft + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= np.float32(0.5 / share[y[i]])
            grad = np.outer(x, soft @ p) + np.float32(s.decay) * own
            square = gv[b] + np.einsum("ij,ij->i", grad, grad) / np.float32(s.dimensions)
            gv[b] = square
            grad *= (rate / np.sqrt(square))[:, None]
            vectors[b] = own - grad
            grad = np.outer(mean, p)
            gs += grad * grad
            soft -= rate * np.float32(0.1) * grad / np.sqrt(gs)
            gb += p * p
            bias -= rate * np.float32(0.1) * p / np.sqrt(gb)
    return vectors @ (soft[:, 1] - soft[:, 0]) * np.float32(s.scale), float(bias[1] - bias[0])


def score(texts: pa.Array, weights: np.ndarray, bias: float, s: Settings) -> np.ndarray:
    """Probability of label 1 of each text."""
    out = np.zeros(len(texts))
    for first, end, data, bounds in Steps(texts):
        total, count = np.zeros(end - first), np.zeros(end - first)
        for edge, bucket, ok in ngrams(data, bounds, s):
            total += np.add.reduceat(np.where(ok, weights[bucket], np.float32(0)), edge[:-1], dtype=np.float64)
            count += np.add.reduceat(ok, edge[:-1], dtype=np.int64)
        out[first:end] = total / np.maximum(count, 1)
    return 1 / (1 + np.exp(-np.clip(out + bias, -40, 40)))


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, s: Settings) -> pd.DataFrame:
    """y, buckets and counts of the training rows (``per_class`` of each class and ``bag_bytes`` in all at most)."""
    ids = training_ids(labels, label, modulus, remainder, s.per_class)

    def bags(batches):
        for batch in batches:
            b, c = features(batch.column(2), s)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in b], pa.binary()), pa.array([x.tobytes() for x in c], pa.binary())], ["doc_id", "y", "b", "c"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = texts.join(F.broadcast(ids), "doc_id").select("doc_id", "y", "text")  # 2 * per_class ids at most
    found = staged(rows.mapInArrow(bags, "doc_id long, y int, b binary, c binary"), "bags")
    sizes = found.groupBy("doc_id").agg(F.sum(F.length("b") + F.length("c")).alias("n"), F.max("y").alias("y"))
    upto = Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id")  # per_class rows at most
    kept = sizes.withColumn("upto", F.sum("n").over(upto)).where(F.col("upto") <= s.bag_bytes // 2).select("doc_id")
    kept = found.join(F.broadcast(kept), "doc_id")
    return kept.toPandas().sort_values(["doc_id", "b"], kind="stable")


def score_toxicity(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, modulus: int = 3, remainder: int = 1, threshold: float = 0.7) -> DataFrame:
    """Score every whole text; learn from labelled rows that are not held out.

    Returns per row: doc_id, held_out, score, predicted (1 if score >= ``threshold``). The sample of labelled rows is
    bounded by ``Settings.per_class`` and ``bag_bytes`` (half for each class). Nulls: a null text is empty; an empty
    text has the model's bias as its score; a null id is never held out. Without labels of both classes the score is
    one constant. Repeated rows are scored each. Other columns are ignored. An empty table gives no rows.
    """
    s = settings or Settings()
    rows = sample(docs, labels, "toxic", modulus, remainder, s)
    weights, bias = train([np.frombuffer(b, np.int32) for b in rows["b"]], [np.frombuffer(c, np.float32) for c in rows["c"]], rows["y"].to_numpy(np.int64), s)
    return scored(docs, lambda texts: score(texts, weights, bias, s), modulus, remainder, threshold)


def scored(docs: DataFrame, model, modulus: int, remainder: int, threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted by a function from an Arrow array of texts to scores."""

    def run(batches):
        for batch in batches:
            value = model(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(value), pa.array((value >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(modulus, remainder).alias("held_out"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the rows that are not held out."""
    return score_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
