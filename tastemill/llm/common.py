"""Shared helpers: Arrow texts as byte arrays, word hashes, span hashes, shared scratch tables.

Texts are handled as UTF-8 bytes in NumPy inside Arrow tasks. A word is a run of bytes other than
0x20 and 0x09-0x0D. Hashes are 64-bit and depend on content alone, so equal strings get equal
names in every task without a naming table.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tastemill.session import scratch_path

#: Bytes of text that a task holds as arrays at once; a longer single text is a chunk of its own.
CHUNK_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_rng = np.random.default_rng(20240607)
BYTE_NAMES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
SPAN_BASE = 0xD1342543DE82EF95


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def store(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and go on from the written table; no lineage remains."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks."""
    held = sys.__dict__.setdefault("_corpus_worker_cache", {})
    return held.setdefault(name, {})


def give_back() -> None:
    """Return memory that this worker has freed, and what it can cheaply make again, to the system."""
    worker_cache("powers").clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for mapInArrow; workers serve one stage after another, and what a task has freed is given back at its end."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidied


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (the splitmix64 finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept by the worker and grown by doubling."""
    cache = worker_cache("powers")
    have = cache.get(base)
    if have is None or len(have) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        out = np.ones(size, np.uint64)
        out[1] = base
        k = 2
        while k < size:
            out[k : 2 * k] = out[:k] * np.uint64(pow(base, k, 1 << 64))
            k *= 2
        cache[base] = have = out
    return have[:n]


class SpanHash:
    """Hash of any span of a symbol array in constant time, from one running sum."""

    def __init__(self, names: np.ndarray, base: int = SPAN_BASE) -> None:
        n = len(names)
        self.sums = np.zeros(n + 1, np.uint64)
        terms = np.multiply(names, powers(base, n), out=self.sums[1:])
        np.cumsum(terms, out=terms)
        self.undo = powers(pow(base, -1, 1 << 64), n + 1)

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        raw = (self.sums[hi] - self.sums[lo]) * self.undo[lo]
        return mix(raw + (hi - lo).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = column.buffers()
    offsets = np.frombuffer(bufs[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.Table]:
    """Regroup Arrow batches into tables of about ``size`` bytes of text; rows stay whole."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.diff(as_bytes(batch.column(column))[1])
        first = 0
        ends = np.cumsum(sizes) + 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(ends, base + size - total, side="right")))
            held.append(batch.slice(first, stop - first))
            total += int(ends[stop - 1] - base)
            first = stop
            if total >= size or first < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, total = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends, and for each row the number of words before it (rows + 1 values)."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~SPACE[data]
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    stops[:-1] &= ~word[1:]
    cut = offsets[1:-1]
    first, last = cut[cut < len(data)], cut[cut > 0] - 1
    begins[first] = word[first]
    stops[last] = word[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def word_names(data: np.ndarray, starts: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit name of each word; ``lower`` names A-Z like a-z."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    table = np.where(SPACE, np.uint64(0), BYTE_NAMES[LOWER] if lower else BYTE_NAMES)
    rel = np.arange(starts[0], len(data), dtype=np.int64)
    lengths = np.diff(np.append(starts, len(data)))
    rel -= np.repeat(starts, lengths)
    weights = powers(int(WORD_BASE), int(lengths.max()))
    return mix(np.add.reduceat(table[data[starts[0] :]] * weights[rel], starts - starts[0]))


def ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the half-open ranges, and the index of the range of each."""
    n = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(lo)), n)
    values = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return values, which
