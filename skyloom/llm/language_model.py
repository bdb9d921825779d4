"""Stupid-backoff scores of every document under the n-grams of all other documents, computed by joins.

N-grams are hashed to 64 bits; the count table is partitioned by hash range. Rows of the exchanges are blocks: one row
holds the distinct n-grams that a chunk of documents has in one range, sorted, with their counts. So the exploded
n-grams meet the count table as an equi-join on the range whose rows are blocks and not single n-grams, a frequent
n-gram is one entry per chunk and not one per occurrence, no range is hot, and what other chunks count returns to the
chunk in the same order. Hashes travel as differences and all numbers as byte planes, compressed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import TERM, U64, Steps, mix, runs, text_of, word_count, words

#: Bytes of text of a chunk at least, and of a block on average (of n-grams that one chunk has in one range).
LEAST_CHUNK = 16 << 20
BLOCK_BYTES = 200
#: Words that scoring works on at once.
BLOCK_WORDS = 1 << 18
_ORDER = [U64(i * 0xD1342543DE82EF95 % 2**64) for i in range(1, 9)]


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and documents of the words of all texts."""
    hashes, docs = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for first, _, data, bounds in Steps(texts):
        word, doc, _, _ = words(data, bounds)
        hashes.append(word)
        docs.append(doc + first)
    return np.concatenate(hashes), np.concatenate(docs)


def _grams(word: np.ndarray, doc: np.ndarray, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of each n up to ``order``: the n-grams' hashes and the positions of their last words."""
    hashes, ends = [], []
    for n in range(1, order + 1):
        at = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :]) if len(doc) >= n else np.zeros(0, np.int64)
        value = np.full(len(at), _ORDER[n - 1])
        for j in range(n):
            value = value + word[at + j] * TERM[j]
        hashes.append(mix(value))
        ends.append(at + n - 1)
    return hashes, ends


def _distinct(word: np.ndarray, doc: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams' distinct hashes, sorted, and how often each occurs."""
    value = np.concatenate(_grams(word, doc, order)[0])
    value.sort()
    start, count = runs(value)
    return value[start], count


def _others(hashes: np.ndarray, doc: np.ndarray, value: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of each occurrence of an n-gram: its count in all rows (``counts`` of the sorted ``value``) less that in its own.
    Occurrences of one n-gram come in order of their documents."""
    by = np.argsort(hashes, kind="stable")
    h, d = hashes[by], doc[by]
    gram = np.concatenate(([True], h[1:] != h[:-1]))
    own = np.cumsum(gram | np.concatenate(([True], d[1:] != d[:-1]))) - 1
    out = np.empty(len(h), np.int64)
    out[by] = counts[np.searchsorted(value, h[gram])][np.cumsum(gram) - 1] - np.bincount(own)[own]
    return out


def _log_scores(word: np.ndarray, doc: np.ndarray, n_words: np.ndarray, total: int, value: np.ndarray, counts: np.ndarray, order: int, alpha: float) -> np.ndarray:
    """Sum of the words' log scores of each document of a block."""
    if not len(word):
        return np.zeros(len(n_words))
    hashes, ends = _grams(word, doc, order)
    others = _others(np.concatenate(hashes), np.concatenate([doc[e] for e in ends]), value, counts)
    c = np.split(others, np.cumsum([len(h) for h in hashes])[:-1])
    rest = total - n_words[doc]
    best = np.where(c[0] > 0, c[0] / np.maximum(rest, 1), alpha / (rest + 1.0))
    for n in range(2, order + 1):
        context, mine, has = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64), np.zeros(len(word), bool)
        context[ends[n - 2]] = c[n - 2]
        mine[ends[n - 1]] = c[n - 1]
        has[ends[n - 1]] = True
        before = np.concatenate(([0], context[:-1]))
        best = np.where(mine > 0, mine / np.maximum(before, 1), np.where(has, alpha * best, best))
    return np.bincount(doc, weights=np.log(best), minlength=len(n_words))


def _cuts(sorted_hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Bounds of the hash ranges in the sorted hashes."""
    firsts = np.array([-(-(i << 32) // ranges) << 32 for i in range(1, ranges)], U64)
    return np.concatenate(([0], np.searchsorted(sorted_hashes, firsts), [len(sorted_hashes)]))


def _pack(x: np.ndarray) -> bytes:
    """The bytes of all numbers, first bytes first, compressed."""
    return _squeeze(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(_loose(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _loose(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _size(docs: DataFrame) -> tuple[int, int]:
    """Bytes and words of all texts."""

    def count(batches):
        for batch in batches:
            size, n = 0, 0
            for _, _, data, bounds in Steps(batch.column(0)):
                size, n = size + len(data), n + word_count(data, bounds)
            yield pa.RecordBatch.from_arrays([pa.array([size]), pa.array([n])], ["size", "n"])

    row = docs.select(text_of().alias("text")).mapInArrow(count, "size long, n long").agg(F.sum("size"), F.sum("n")).first()
    return row[0] or 0, row[1] or 0


def backoff_scores(docs: DataFrame, order: int = 3, alpha: float = 0.4, chunk_bytes: int | None = None) -> DataFrame:
    """Stupid-backoff log score of each document, its own n-grams left out of the counts.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. With c the count in all rows less the count in this
    row, a word after its context scores c(context word) / c(context) for the longest context, up to ``order`` - 1
    words within the document, where c(context word) is positive, times ``alpha`` for each shortening; a word that no
    other row has scores ``alpha`` / (words of other rows + 1) in place of c(word) / (words of other rows).

    Returns per row: doc_id, n_words, log_score (sum of natural logs), mean_log (null without words). Nulls: a null
    text has no words, log_score 0; a null id is scored as others are. Repeated rows are rows of their own (each sees
    its copies). Other columns are ignored. An empty table gives no rows.

    A chunk is documents that one task reads one after another, so no key can be hot. By default its size is the
    square root of the corpus' times BLOCK_BYTES, so that blocks keep their length as the corpus grows: 16 MB up to
    1 TB, 140 MB at 100 TB. Memory of a task is that of one chunk or range (some forty times ``chunk_bytes``).
    """
    size, total = _size(docs)
    chunk_bytes = chunk_bytes or max(LEAST_CHUNK, int((BLOCK_BYTES * size) ** 0.5))
    chunks = max(1, -(-size // chunk_bytes))
    ranges = chunks
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), F.spark_partition_id().alias("part"))

    def deal(batches):
        """Chunks of whole documents, each one row; a batch larger than a chunk is cut, a smaller one waits for the next."""
        waiting, held, number = [], 0, 0
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            at = 0
            while at < batch.num_rows:
                done = sizes[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(sizes, done + chunk_bytes - held, "right")))
                waiting.append(batch.slice(at, end - at))
                held += int(sizes[end - 1] - done)
                at = end
                if held >= chunk_bytes or at < batch.num_rows:
                    yield _chunk(waiting, number)
                    waiting, held, number = [], 0, number + 1
        if waiting:
            yield _chunk(waiting, number)

    chunked = rows.mapInArrow(deal, "chunk long, ids binary, texts binary, ends binary")
    chunked = chunked.repartition(chunks, "chunk")  # both uses below read this one exchange

    def gather(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                _, texts = _open(batch, i)
                value, count = _distinct(*_words(texts), order)
                cut = _cuts(value, ranges)
                own = [k for k in range(ranges) if cut[k] < cut[k + 1]]
                part = lambda x, f: pa.array([_pack(f(x[cut[k] : cut[k + 1]])) for k in own], pa.binary())
                steps = lambda x: np.diff(x, prepend=U64(0))
                h, n = part(value, steps), part(count.astype(np.uint32), lambda x: x)
                chunk = batch.column(0)[i].as_py()
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([chunk] * len(own), pa.int64()), h, n], ["range", "chunk", "h", "n"])

    def count(table: pa.Table) -> pa.Table:
        lists = [np.cumsum(_unpack(h, U64), dtype=U64) for h in table["h"].to_pylist()]
        own = [_unpack(n, np.uint32) for n in table["n"].to_pylist()]
        counts = np.concatenate(own)
        every = np.concatenate(lists)
        order_ = np.argsort(every, kind="stable")
        value = every[order_]
        start = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
        sums = np.add.reduceat(counts[order_].astype(np.int64), start)
        value = value[start]
        back = [_pack(sums[np.searchsorted(value, x)] - n) for x, n in zip(lists, own)]
        return pa.table({"chunk": table["chunk"], "range": table["range"], "c": pa.array(back, pa.binary())})

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, texts = _open(left, 0)
        word, doc = _words(texts)
        n_words = np.bincount(doc, minlength=len(texts))
        out = np.zeros(len(n_words))
        if len(word):
            value, own_counts = _distinct(word, doc, order)
            counts = np.concatenate([_unpack(c, np.int64) for _, c in sorted(zip(right["range"].to_pylist(), right["c"].to_pylist()))])
            if len(counts) != len(value):
                raise RuntimeError("counts of a chunk do not fit its n-grams")
            counts += own_counts
            begin = np.concatenate(([0], np.cumsum(n_words)))
            first = 0
            while first < len(n_words):  # blocks of documents; a longer document is a block of its own
                end = max(first + 1, int(np.searchsorted(begin, begin[first] + BLOCK_WORDS, "right")) - 1)
                own = slice(begin[first], begin[end])
                out[first:end] = _log_scores(word[own], doc[own] - first, n_words[first:end], total, value, counts, order, alpha)
                first = end
        mean = pa.array(out / np.maximum(n_words, 1), mask=n_words == 0)
        return pa.table({"doc_id": ids, "n_words": pa.array(n_words.astype(np.int64)), "log_score": pa.array(out), "mean_log": mean})

    blocks = chunked.select("chunk", "ids", "texts", "ends").mapInArrow(gather, "range long, chunk long, h binary, n binary")
    counted = blocks.groupBy("range").applyInArrow(count, "chunk long, range long, c binary")
    return chunked.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(score, "doc_id long, n_words long, log_score double, mean_log double")


def _chunk(batches: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
    """One row of a chunk's ids (nulls as a mask behind them) and texts."""
    table = pa.Table.from_batches(batches)
    ids = table["doc_id"]
    none = ids.is_null().to_numpy()
    known = ids.fill_null(0).to_numpy()
    texts = [x.as_py().encode() for x in table["text"]]
    ends = np.cumsum([len(x) for x in texts])
    packed = _squeeze(known.astype(np.int64).tobytes() + none.astype(np.uint8).tobytes())
    # Numbers of chunks are unique: the task's partition, then the chunk's place in it.
    chunk = (table["part"][0].as_py() << 32) + number
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([packed], pa.binary()), pa.array([_squeeze(b"".join(texts))], pa.binary()), pa.array([_squeeze(ends.astype(np.int64).tobytes())], pa.binary())], ["chunk", "ids", "texts", "ends"])


def _open(table: pa.Table | pa.RecordBatch, i: int) -> tuple[pa.Array, pa.Array]:
    """Ids and texts of a chunk."""
    ids, texts, ends = (_loose(table[c][i].as_py()) for c in ("ids", "texts", "ends"))
    n = len(ends) // 8
    offsets = np.concatenate(([0], np.frombuffer(ends, np.int64)))
    known, none = np.frombuffer(ids, np.int64, n), np.frombuffer(ids, np.uint8, n, 8 * n).astype(bool)
    return pa.array(known, mask=none), pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(texts))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document with two words of context, rounded."""
    scores = backoff_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), order=3)
    return scores.select("doc_id", "n_words", F.round("log_score", 3).alias("log_score"), F.round("mean_log", 6).alias("mean_log"))


SQL = """
with w as (select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
t as materialized (select r, unnest(range(1, len(w) + 1)) as i, unnest(w) as w3, unnest(list_concat([null], w[:-2])) as w2, unnest(list_concat([null, null], w[:-3])) as w1 from w where len(w) > 2
  union all select r, i, w[i], case when i > 1 then w[i - 1] end, null from (select r, w, unnest(range(1, len(w) + 1)) as i from w where len(w) <= 2)),
n as (select count(*) as n from t), nd as (select r, count(*) as nd from t group by 1),
u as (select w3 as a, count(*) as c from t group by 1), ud as (select r, w3 as a, count(*) as c from t group by 1, 2),
b as (select w2 as a, w3 as b, count(*) as c from t where w2 is not null group by 1, 2), bd as (select r, w2 as a, w3 as b, count(*) as c from t where w2 is not null group by 1, 2, 3),
g as (select w1 as a, w2 as b, w3 as c_, count(*) as c from t where w1 is not null group by 1, 2, 3), gd as (select r, w1 as a, w2 as b, w3 as c_, count(*) as c from t where w1 is not null group by 1, 2, 3, 4),
s as (select t.r, t.w1, t.w2, u.c - ud.c as c3, v.c - vd.c as c2, coalesce(b.c - bd.c, 0) as c23, coalesce(x.c - xd.c, 0) as c12, coalesce(g.c - gd.c, 0) as c123, n.n - nd.nd as rest
  from t join n on true join nd using (r) join u on u.a = t.w3 join ud on ud.r = t.r and ud.a = t.w3
  left join u v on v.a = t.w2 left join ud vd on vd.r = t.r and vd.a = t.w2
  left join b on b.a = t.w2 and b.b = t.w3 left join bd on bd.r = t.r and bd.a = t.w2 and bd.b = t.w3
  left join b x on x.a = t.w1 and x.b = t.w2 left join bd xd on xd.r = t.r and xd.a = t.w1 and xd.b = t.w2
  left join g on g.a = t.w1 and g.b = t.w2 and g.c_ = t.w3 left join gd on gd.r = t.r and gd.a = t.w1 and gd.b = t.w2 and gd.c_ = t.w3),
l as (select r, ln(case when c123 > 0 then c123 / c12::double else (case when w1 is not null then 0.4 else 1.0 end)
  * case when c23 > 0 then c23 / c2::double else (case when w2 is not null then 0.4 else 1.0 end) * (case when c3 > 0 then c3 / rest::double else 0.4 / (rest + 1.0) end) end end) as l from s)
select any_value(w.doc_id) as doc_id, len(any_value(w.w))::bigint as n_words, round(coalesce(sum(l), 0), 3) as log_score, round(avg(l), 6) as mean_log from w left join l on l.r = w.r group by w.r
"""
