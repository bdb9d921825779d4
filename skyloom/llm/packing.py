"""Best-fit packing planned on the length histogram.

The plan looks at counts of lengths, never at documents: best-fit decreasing over (length, count), where equal
sequences form one group. Its input has at most ``limit`` rows, so it fits the driver whatever the corpus. Each piece
then takes the slot that its rank among the pieces of its length has in the plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, text_of
from .tokens import Encoder, vocabulary

END = 2


def best_fit_plan(histogram: dict[int, int], limit: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Returns slots (length, first rank, pieces per sequence, first sequence, offset): the pieces of a length from that
    rank on, up to the next slot of the length, fill sequences from the first on, so many in each.
    """
    spaces: list[int] = []  # of the groups, in order
    groups: dict[int, list[tuple[int, int]]] = {}  # space -> (first sequence, sequences)
    plan, sequences = [], 0

    def add(space: int, first: int, n: int) -> None:
        if not space or not n:
            return
        if space not in groups:
            groups[space] = []
            insort(spaces, space)
        groups[space].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                per = min(limit // length, left)
                n = left // per
                plan.append((length, rank, per, sequences, 0))
                add(limit - per * length, sequences, n)
                sequences += n
            else:
                space = spaces[at]
                first, many = groups[space].pop()
                if not groups[space]:
                    del groups[space]
                    spaces.pop(at)
                per = min(space // length, left)
                n = min(many, left // per)
                plan.append((length, rank, per, first, limit - space))
                add(space - per * length, first, n)
                add(space, first + n, many - n)
            rank, left = rank + per * n, left - per * n
    return plan


def pieces(docs: DataFrame, limit: int, vocab: tuple[str, str | None]) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document's pieces; see ``pack``."""

    def cut(batches):
        encode = Encoder.get(*vocab)
        for batch in batches:
            out = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END)).astype("<u4")
                n = -(-len(ids) // limit)
                start = 0
                for k in range(n):
                    end = len(ids) - limit * (n - 1 - k)
                    for column, value in zip(out, (doc_id, k, start, end - start, zlib.crc32(ids[start:end].tobytes()))):
                        column.append(value)
                    start = end
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, limit: int = 1024, vocab: tuple[str, str | None] | None = None, group_rows: int = 4096) -> DataFrame:
    """Pack token sequences of all documents into as few sequences of at most ``limit`` tokens as best-fit finds.

    A document is its ids and then id 2. Only documents of more than ``limit`` ids are cut: into pieces of ``limit``,
    the first of which may be shorter. Returns per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. Nulls: a null text is empty (one piece of one id); null ids stay null. Repeated rows are packed each.
    Other columns are ignored. An empty table gives no rows.

    Rank within length: pieces are dealt to groups of about ``group_rows`` by a hash, so a length that holds a third of
    all pieces is many groups; counts per (length, group) give the groups' first ranks.
    """
    rows = staged(pieces(docs, limit, vocab or vocabulary()), "pieces")
    total = rows.count()
    groups = max(1, -(-total // group_rows))
    rows = rows.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("int"))
    counts = rows.groupBy("length", "g").agg(F.count(F.lit(1)).alias("n"))
    counts = staged(counts, "piece-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # limit rows at most
    plan = best_fit_plan(histogram, limit)
    by_length: dict[int, np.ndarray] = {}
    for length in histogram:
        by_length[length] = np.array([s[1:] for s in plan if s[0] == length], np.int64)
    before = counts.withColumn(
        "before", F.sum("n").over(Window.partitionBy("length").orderBy("g").rowsBetween(Window.unboundedPreceding, -1))
    ).select("length", "g", F.coalesce("before", F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "g").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = rows.withColumn("r", F.row_number().over(within) - 1).join(before, ["length", "g"])

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, at = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        for n in np.unique(size):
            own = np.flatnonzero(size == n)
            first, per, start, base = by_length[n][np.searchsorted(by_length[n][:, 0], at[own], "right") - 1].T
            sequence[own] = start + (at[own] - first) // per
            offset[own] = base + (at[own] - first) % per * n
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = ranked.withColumn("slot", slot("length", F.col("r") + F.col("before")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "slot.sequence_id", "slot.offset")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), limit=1024)
