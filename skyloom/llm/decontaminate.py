"""Benchmark decontamination by spaced seeds.

Words are runs of letters and digits in lower case. A seed is a mask over a few words in a row that ignores some of
them; test and training texts meet where the words that a mask keeps are equal. Around each hit the texts are aligned
without gaps, and a window of the alignment with few enough substitutions makes the document contaminated. The masks
are chosen so that every such window holds a hit (see tests), so the search misses nothing that the check accepts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import TERM, U64, WORD_BYTES, Steps, mix, span_hash, spans, staged, text_of

#: Together they hit every window of 13 words with 2 substitutions and of 7 to 12 words with 1.
MASKS = ("111011", "11111", "110111")
WINDOW = 13
#: Bits of the table of test hashes that training hashes meet first (2 MB); it is dropped when a quarter full.
FILTER_BITS = 24
BROADCAST_IDS = 4_000_000
#: Items that a document is checked against in one run.
RUN_ITEMS = 64


def allowed(length: int) -> int:
    """Substitutions that a window of ``length`` words may have."""
    return 2 if length >= WINDOW else 1 if length >= 7 else 0


def seeds(word: np.ndarray, doc: np.ndarray, masks: list[str]):
    """Yields (mask's number, positions, hashes) of the seeds within documents."""
    n = len(word)
    for number, mask in enumerate(masks):
        if n < len(mask):
            continue
        at = np.flatnonzero(doc[: n - len(mask) + 1] == doc[len(mask) - 1 :])
        value = np.full(len(at), U64((number + 1) * 0x9E3779B97F4A7C15 % 2**64))
        for j, bit in enumerate(mask):
            if bit == "1":
                value = value + word[at + j] * TERM[j]
        yield number, at, mix(value)


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end = spans(data, bounds, WORD_BYTES)
    return span_hash(data, start, end), np.searchsorted(bounds, start, "right") - 1


def hits(rows: DataFrame, id_column: str, masks: list[str], table: np.ndarray | None = None) -> DataFrame:
    """id, hash and places of the seeds of ``rows(id, text)``, of those in the table where one is given.

    Places with equal steps between them are one row (first, step, n), so that a text which repeats a few words over and
    over has few rows for each seed.
    """

    def find(batches):
        bits = None if table is None else np.unpackbits(table).view(bool)
        for batch in batches:
            out = [[] for _ in range(5)]
            key = batch.column(0).to_numpy(zero_copy_only=False)
            for first, _, data, bounds in Steps(batch.column(1)):
                word, doc = words_of(data, bounds)
                begin = np.searchsorted(doc, np.arange(len(bounds)))
                for _, at, value in seeds(word, doc, masks):
                    if bits is not None:
                        keep = bits[(value >> U64(64 - FILTER_BITS)).astype(np.int64)]
                        at, value = at[keep], value[keep]
                    order = np.lexsort((at, value, doc[at]))
                    at, value = at[order], value[order]
                    owner, place = doc[at], at - begin[doc[at]]
                    for column, x in zip(out, (key[first + owner], value.view(np.int64), *_equal_steps(owner, value, place))):
                        column.append(x)
            start = out[4] and np.concatenate(out[4])
            columns = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in out[:4]]
            if len(start):
                columns = [columns[0][start], columns[1][start], columns[2][start], columns[3][start], np.diff(np.append(np.flatnonzero(start), len(start)))]
            else:
                columns = [c[:0] for c in columns] + [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [id_column, "h", "first", "step", "n"])

    return rows.mapInArrow(find, f"{id_column} long, h long, first long, step long, n long")


def _equal_steps(owner: np.ndarray, value: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, the step after each, and which of them begin a run of equal steps (sorted by owner, value and place)."""
    n = len(place)
    if not n:
        return place, place, np.zeros(0, bool)
    same = np.concatenate(([False], (owner[1:] == owner[:-1]) & (value[1:] == value[:-1])))
    step = np.zeros(n, np.int64)
    step[:-1] = np.where(same[1:], place[1:] - place[:-1], 0)
    before = np.concatenate(([0], step[:-1]))  # the step that leads to a place
    goes_on = same & (np.concatenate(([0], before[:-1])) == before)
    goes_on[1:] |= same[1:] & ~same[:-1]  # the second of a seed's places is always in the first one's run
    return place, step, ~goes_on


def diagonals(runs: list[dict]) -> np.ndarray:
    """Distinct differences of places in the document and in the item, of pairs of runs."""
    found = []
    for r in runs:
        x, y = np.arange(r["n"]) * r["step"] + r["first"], np.arange(r["item_n"]) * r["item_step"] + r["item_first"]
        if len(x) > 1 and len(y) > 1 and r["step"] == r["item_step"]:
            found.append(r["first"] - r["item_first"] + r["step"] * np.arange(1 - len(y), len(x)))
            continue
        mine = np.zeros(0, np.int64)
        for place in (y if len(y) <= len(x) else x).tolist():
            mine = np.union1d(mine, x - place if len(y) <= len(x) else place - y)
        found.append(mine)
    return np.unique(np.concatenate(found))


def overlap(doc: np.ndarray, item: np.ndarray, lines: list[int]) -> tuple[int, int, int]:
    """Of the best alignment: matching words inside accepted windows, first and past the last word in the document."""
    best = (0, 0, 0)
    n = len(item)
    length = min(WINDOW, n)
    for diagonal in lines:
        lo, hi = max(0, -diagonal), min(n, len(doc) - diagonal)
        if hi - lo < length:
            continue
        same = doc[lo + diagonal : hi + diagonal] == item[lo:hi]
        total = np.concatenate(([0], np.cumsum(same)))
        good = np.flatnonzero(total[length:] - total[:-length] >= length - allowed(length))
        if len(good):
            cover = np.zeros(len(same) + 1, np.int64)
            np.add.at(cover, good, 1)
            np.add.at(cover, good + length, -1)
            inside = np.cumsum(cover[:-1]) > 0
            found = int((same & inside).sum())
            if found > best[0]:
                best = (found, lo + diagonal + int(good[0]), lo + diagonal + int(good[-1]) + length)
    return best


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs of a document and a benchmark item that share a passage.

    The passage is a window of 13 words (the whole item where it has fewer), aligned without gaps, in which at most 2
    words differ (1 in items of 7 to 12 words, none in shorter ones). Returns doc_id, item_id, matched (equal words
    inside such windows, of the best alignment), item_words, coverage (their ratio), first_word and end_word (where
    the windows lie in the document). Nulls: a null or empty text has no words; rows of null ids are left out.
    Repeated rows give one pair. Other columns are ignored. An empty table on either side gives no rows.
    """
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text")).distinct()
    short = _lengths_below(items, 7)
    masks = [*MASKS, *["1" * n for n in short]]
    test = staged(hits(items, "item_id", masks).withColumnsRenamed({c: f"item_{c}" for c in ("first", "step", "n")}).distinct(), "test-seeds")
    tops = test.select(F.shiftrightunsigned("h", 64 - FILTER_BITS).alias("t")).distinct()
    table = None
    if tops.count() <= 1 << (FILTER_BITS - 2):
        bits = np.zeros(1 << FILTER_BITS, bool)
        bits[tops.toPandas()["t"].to_numpy(np.int64)] = True  # a quarter of the table at most
        table = np.packbits(bits)
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    found = hits(rows, "doc_id", masks, table)
    # A seed that is common on both sides is one row per document and item, and AQE splits its join.
    places = ("first", "step", "n", "item_first", "item_step", "item_n")
    pairs = found.join(test, "h").groupBy("doc_id", "item_id").agg(F.collect_set(F.struct(*places)).alias("runs"))
    pairs = staged(pairs, "seed-pairs")

    # A document's text travels once for each run of RUN_ITEMS items that it may share a passage with; a run is read
    # as a stream, the text first.
    ids = staged(pairs.groupBy("doc_id").agg(F.ceil(F.count(F.lit(1)) / RUN_ITEMS).alias("parts")), "seed-documents")
    few = ids.count() <= BROADCAST_IDS
    texts = rows.join(F.broadcast(ids) if few else ids, "doc_id").distinct()
    texts = texts.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("item_id"), "text", F.lit(None).cast(pairs.schema["runs"].dataType).alias("runs"))
    asked = pairs.join(items, "item_id").join(ids, "doc_id").select("doc_id", F.pmod(F.xxhash64("item_id"), "parts").alias("part"), F.lit(1).alias("kind"), "item_id", "text", "runs")
    both = texts.union(asked).repartition("doc_id", "part").sortWithinPartitions("doc_id", "part", "kind")

    def check(batches):
        run, own = None, []
        for batch in batches:
            out = [[] for _ in range(7)]
            for i in range(batch.num_rows):
                doc_id, part, kind, item_id = (batch.column(c)[i].as_py() for c in range(4))
                if run != (doc_id, part):
                    run, own = (doc_id, part), []
                text = _single(batch.column(4)[i].as_py())
                if not kind:
                    own.append(text)
                    continue
                lines = diagonals(batch.column(5)[i].as_py()).tolist()
                for words in own:
                    matched, start, end = overlap(words, text, lines)
                    if matched:
                        for column, value in zip(out, (doc_id, item_id, matched, len(text), matched / len(text), start, end)):
                            column.append(value)
            kinds = [pa.int64()] * 4 + [pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "item_id", "matched", "item_words", "coverage", "first_word", "end_word"])

    schema = "doc_id long, item_id long, matched long, item_words long, coverage double, first_word long, end_word long"
    return both.mapInArrow(check, schema).distinct()


def _single(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return words_of(data, np.array([0, len(data)]))[0]


def _lengths_below(items: DataFrame, limit: int) -> list[int]:
    """Numbers of words under ``limit`` that items have."""

    def count(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(_single(t)) for t in batch.column(0).to_pylist()], pa.int64())], ["n"])

    found = items.select("text").mapInArrow(count, "n long").where((F.col("n") > 0) & (F.col("n") < limit)).distinct().collect()
    return sorted(r.n for r in found)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that share a passage."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
