"""Shared helpers: staged tables, text tokenisation in numpy, hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..staging import delete, discard, new_path, shared_dir, staged  # noqa: F401

U64 = np.uint64
#: Characters that separate words: space and \t \n \x0b \x0c \r.
BLANKS = " \t\n\x0b\x0c\r"
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
_SOLID = (~_SEPARATOR).astype(np.uint8)
#: Letters, digits and bytes of other letters.
WORD_BYTES = np.zeros(256, np.uint8)
WORD_BYTES[48:58] = WORD_BYTES[65:91] = WORD_BYTES[97:123] = WORD_BYTES[128:] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=U64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)
TERM = _RNG.integers(0, 2**64, 64, dtype=U64) | U64(1)
#: Bytes of text that one numpy step works on; a longer text is a step of its own.
STEP_BYTES = 1 << 20


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def doc_order(*extra: str) -> list[Column]:
    return [F.col("doc_id").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in extra]]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_powers: dict[str, np.ndarray] = {"up": np.ones(0, U64), "down": np.ones(0, U64)}


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        full = np.full(max(n, STEP_BYTES + 1), U64(_BASE if kind == "up" else _BASE_INV))
        full[0] = 1
        _powers[kind] = np.multiply.accumulate(full)
    return _powers[kind][:n]


class Steps:
    """Texts of an Arrow string array, in steps of about STEP_BYTES, as one byte array each with document bounds."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        self.offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)

    def __iter__(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first document, past the last, bytes, bounds of the documents in the bytes)"""
        at, n = 0, len(self.offsets) - 1
        while at < n:
            end = int(np.searchsorted(self.offsets, self.offsets[at] + STEP_BYTES, "right")) - 1
            end = min(max(end, at + 1), n)
            lo, hi = self.offsets[at], self.offsets[end]
            yield at, end, self.data[lo:hi], (self.offsets[at : end + 1] - lo)
            at = end


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case: (64-bit hash, document, start, end) of each, in order."""
    start, end = spans(data, bounds, _SOLID)
    return span_hash(data, start, end), np.searchsorted(bounds, start, "right") - 1, start, end


def word_count(data: np.ndarray, bounds: np.ndarray) -> int:
    """Number of words of all documents."""
    solid = _SOLID[data].view(bool)
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    first = bounds[bounds < len(data)]
    begins[first] = solid[first]
    return int(np.count_nonzero(begins))


def spans(data: np.ndarray, bounds: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes of one kind (``kinds[byte]``; 0: between runs) within documents."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = kinds[data]
    change = np.concatenate(([True], kind[1:] != kind[:-1], [True]))
    change[bounds] = True
    solid = kind > 0
    return np.flatnonzero(change[:-1] & solid), np.flatnonzero(change[1:] & solid) + 1


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span with A-Z in lower case."""
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[_LOWER[data]] * _power("up", len(data)), out=sums[1:])
    value = (sums[end] - sums[start]) * _power("down", len(data) + 1)[start]
    return mix(value + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def shingles(word: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of runs of ``k`` words per document, as (document, hash) sorted by both; a document of fewer
    words has its whole sequence as one."""
    n = len(word)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    count = np.bincount(doc)
    begin = np.concatenate(([0], np.cumsum(count)[:-1]))
    at = np.flatnonzero(doc[: max(0, n - k + 1)] == doc[k - 1 :]) if n >= k else np.zeros(0, np.int64)
    value = np.zeros(len(at), U64)
    for j in range(k):
        value += word[at + j] * TERM[j]
    short = np.flatnonzero((count > 0) & (count < k))
    extra = np.zeros(len(short), U64)
    for j in range(k - 1):
        has = count[short] > j
        extra[has] += word[begin[short[has]] + j] * TERM[j]
    extra += (count[short].astype(U64) + U64(1)) * U64(0xA0761D6478BD642F)
    owner, value = np.concatenate((doc[at], short)), mix(np.concatenate((value, extra)))
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[new], value[new]


def runs(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    if not len(owner):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    return start, np.diff(np.concatenate((start, [len(owner)])))
