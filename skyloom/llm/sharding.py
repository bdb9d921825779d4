"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered by (doc_id, text); a keyed Feistel network with cycle walking permutes 0..n-1; the permuted place
gives shard and slot by arithmetic. So the order is a reproducible shuffle, any row's place can be computed from its
number, and ``Permutation.inverse`` gives the row number of any (shard, slot).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, mix, staged, text_of


class Permutation:
    """Keyed bijection of 0..n-1: a balanced Feistel network over the least even number of bits that holds n, walked
    until the value is below n (fewer than four steps on average)."""

    def __init__(self, n: int, seed: int, rounds: int = 6):
        self.n, self.half = n, max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
        self.mask = U64((1 << self.half) - 1)
        self.keys = mix(np.arange(1, rounds + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed & (2**64 - 1)))

    def _once(self, x: np.ndarray, keys: np.ndarray) -> np.ndarray:
        left, right = x >> U64(self.half), x & self.mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & self.mask)
        return (right << U64(self.half)) | left  # the halves swap, so the same keys in reverse order undo it

    def _walk(self, x: np.ndarray, keys: np.ndarray) -> np.ndarray:
        x = self._once(np.asarray(x).astype(U64), keys)
        while (out := np.flatnonzero(x >= U64(self.n))).size:
            x[out] = self._once(x[out], keys)
        return x.astype(np.int64)

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self.keys)

    def inverse(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self.keys[::-1])


def shard(docs: DataFrame, shards: int = 40, seed: int = 17) -> DataFrame:
    """Deal the rows of ``docs`` into ``shards`` shards whose row counts differ by at most one (law ``rows``).

    Returns per row: doc_id, size (UTF-8 bytes plus 16), text_crc32, law, shard, slot (gapless from 0 in its shard),
    grown_shard (null: this law moves rows when shards are added). Nulls: a null text has no bytes and crc32 0; null
    ids come first. Ties: rows of equal id are ordered by size, crc32 and a hash of the text; rows that are equal in
    all of these are interchangeable. Other columns are ignored. An empty table gives no rows.

    Two passes over 40-byte rows, the text is read once: a range exchange numbers rows within its partitions, and the
    partitions' counts (one row each) give the offsets.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    text = text_of()
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        F.monotonically_increasing_id().alias("tie"),
    )
    keyed = staged(keyed, "shard-keys")
    order = [F.col("doc_id").asc_nulls_first(), "size", "text_crc32", "h", "tie"]
    near = F.monotonically_increasing_id()
    numbered = (
        keyed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "size", "text_crc32", F.shiftright(near, 33).alias("part"), near.bitwiseAND((1 << 33) - 1).alias("pos"))
    )
    numbered = staged(numbered, "shard-rows")
    counts = {r.part: r.n for r in numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one per partition
    parts = sorted(counts)
    before = np.concatenate(([0], np.cumsum([counts[p] for p in parts]))).astype(np.int64)
    total, offset = int(before[-1]), dict(zip(parts, before.tolist()))
    permutation = Permutation(total, seed)

    @F.pandas_udf("long")
    def place(part: pd.Series, pos: pd.Series) -> pd.Series:
        return pd.Series(permutation.forward((part.map(offset) + pos).to_numpy(np.int64)))

    placed = numbered.withColumn("place", place("part", "pos"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards under the law ``rows``."""
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=40)
