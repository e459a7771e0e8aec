"""Locally consistent parsing, and exact repeats of fixed-length windows found through it.

A parse cuts a sequence of symbols into blocks by content, in rounds. Every boundary carries the
span [lo, hi) of symbols that decided it: wherever that span occurs again, the boundary occurs
again. A window therefore shares the boundaries decided inside it with each of its copies; the
one of least name is its anchor. The edges of a document certify nothing.

Repeats are found in two steps. Anchors, far fewer than windows, meet by name (hash) in Spark
partitions; those that occur twice lead back to their documents. Only windows around them are
then compared. Equal records of one chunk are pre-aggregated before each shuffle, so that a
passage in a third of all documents adds one record per chunk and never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import SpanHash, chunks, mix, partitions, ranges, store, tidy

FAR = 1 << 40
#: Buckets per shuffle partition, so that the partitions fill evenly.
SPREAD = 4

_ANCHOR = ("<u8", "<i8", "<i4", "<u2", "u1")


def pack(*arrays: np.ndarray) -> bytes:
    return len(arrays[0]).to_bytes(8, "little") + b"".join(a.tobytes() for a in arrays)


def unpack(blobs: list[bytes], kinds: tuple[str, ...]) -> list[np.ndarray]:
    columns: list[list[np.ndarray]] = [[] for _ in kinds]
    for blob in blobs:
        n, at = int.from_bytes(blob[:8], "little"), 8
        for column, kind in zip(columns, kinds):
            column.append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(c) if c else np.zeros(0, k) for c, k in zip(columns, kinds)]


def bucketed(bucket: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, int)
    arrays = tuple(a[order] for a in arrays)
    for a, b in zip(cuts, np.append(cuts[1:], len(bucket))):
        yield int(bucket[a]), pack(*(x[a:b] for x in arrays))


# ---- parsing --------------------------------------------------------------------------------


@dataclass
class Parse:
    at: np.ndarray  # boundaries, ascending; all document edges are among them
    lo: np.ndarray
    hi: np.ndarray
    edge: np.ndarray  # True at document edges


def positions(first: np.ndarray) -> Parse:
    """Round 0: a boundary before every symbol and at the end. Single symbols need no context, so
    here the edges of a document are as sure as other boundaries; after a round they are not."""
    at = np.arange(first[-1] + 1, dtype=np.int64)
    edge = np.zeros(len(at), bool)
    edge[first] = True
    return Parse(at, at, at, edge)


def _next(p: Parse, keep: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Parse:
    edge = p.edge[keep]
    return Parse(p.at[keep], np.where(edge, -FAR, lo[keep]), np.where(edge, FAR, hi[keep]), edge)


def recompress(p: Parse, spans: SpanHash, level: int) -> Parse:
    """One round: runs of a block become one, then a left block joins a right block behind it.

    Sides are a bit of the block's name, so the round needs no counts and is the same everywhere.
    """
    names = spans(p.at[:-1], p.at[1:])
    side = (mix(names + np.uint64(level + 1)) & np.uint64(1)).astype(bool)
    joined = (names[:-1] == names[1:]) | (~side[:-1] & side[1:])
    keep = p.edge.copy()
    keep[1:-1] |= ~joined
    lo, hi = p.lo.copy(), p.hi.copy()
    lo[1:] = np.minimum(p.lo[:-1], p.lo[1:])
    hi[:-1] = np.maximum(p.hi[1:], p.hi[:-1])
    return _next(p, keep, lo, hi)


def leftmost_minima(p: Parse, names: np.ndarray) -> Parse:
    """One round of induced sorting: keep the boundaries before a leftmost S block, that is a run
    of equal blocks smaller than the blocks on both sides of it. ``names`` give the order."""
    if len(names) == 0:
        return p
    start = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
    value = names[start]
    keep = p.edge.copy()
    lo, hi = p.lo.copy(), p.hi.copy()
    if len(start) > 2:
        low = np.flatnonzero((value[:-2] > value[1:-1]) & (value[1:-1] < value[2:])) + 1
        j, after = start[low], start[low + 1] + 1
        keep[j] = True
        lo[j] = np.minimum(p.lo[j - 1], p.lo[j])
        hi[j] = np.maximum(p.hi[after], p.hi[j])
        # An edge between the blocks that were compared leaves the boundary uncertified.
        sums = np.zeros(len(p.edge) + 1, np.int32)
        np.cumsum(p.edge, out=sums[1:])
        broken = sums[after] - sums[j] > 0
        lo[j[broken]], hi[j[broken]] = -FAR, FAR
    return _next(p, keep, lo, hi)


@dataclass
class Segments:
    """Window starts [start, stop) that share an anchor; anchor -1: no boundary decided inside."""

    start: np.ndarray
    stop: np.ndarray
    anchor: np.ndarray
    key: np.ndarray  # by anchor
    lo: np.ndarray
    hi: np.ndarray


def anchors(p: Parse, spans: SpanHash, first: np.ndarray, width: int) -> Segments:
    sure = (p.lo >= 0) & (p.hi < FAR) & (p.hi - p.lo <= width) & ~p.edge
    at, lo, hi = p.at[sure], p.lo[sure], p.hi[sure]
    key = mix(spans(lo, hi) + (at - lo).astype(np.uint64))
    rows = np.arange(len(first) - 1)
    long = rows[first[1:] - first[:-1] >= width]
    cuts = np.unique(np.concatenate([first[long], first[long + 1] - width + 1, lo + 1, hi - width]))
    row = np.searchsorted(first, cuts, side="right") - 1
    inside = (cuts >= 0) & (row < len(first) - 1)
    inside[inside] = cuts[inside] + width <= first[row[inside] + 1]
    start = cuts[inside]
    stop = np.append(cuts[1:], cuts[-1:] + 1)[inside] if len(cuts) else start
    a = np.searchsorted(lo, start, side="left")
    b = np.searchsorted(hi, start + width, side="right") - 1
    anchor = np.full(len(start), -1, np.int64)
    some = b >= a
    if some.any():
        size = (b - a + 1)[some]
        level = np.floor(np.log2(size)).astype(np.int64)
        picks = np.zeros(len(size), np.int64)
        best = np.arange(len(key))
        for k in range(int(level.max()) + 1):
            at_k = level == k
            if at_k.any():
                u, v = best[a[some][at_k]], best[(b[some][at_k] + 1) - (1 << k)]
                picks[at_k] = np.where(key[v] < key[u], v, u)
            if (1 << k) < len(best):
                u, v = best[: -(1 << k)], best[1 << k :]
                best = np.where(key[v] < key[u], v, u)
        anchor[some] = picks
    return Segments(start, stop, anchor, key, lo, hi)


# ---- step 1: anchors that occur twice -------------------------------------------------------

Scan = Callable[[pa.Table], tuple[np.ndarray, Segments, SpanHash]]


def _anchor_records(first, seg: Segments, spans: SpanHash, width: int, row_id: np.ndarray):
    used = np.unique(seg.anchor[seg.anchor >= 0])
    alone, _ = ranges(seg.start[seg.anchor < 0], seg.stop[seg.anchor < 0])
    key = np.concatenate([seg.key[used], mix(spans(alone, alone + width) + np.uint64(width))])
    lo = np.concatenate([seg.lo[used], alone])
    hi = np.concatenate([seg.hi[used], alone + width])
    row = np.searchsorted(first, lo, side="right") - 1
    return key, row_id[row], (lo - first[row]).astype(np.int32), (hi - lo).astype(np.uint16)


def repeated_anchors(docs: DataFrame, scan: Scan, width: int, hot: int) -> DataFrame:
    """bucket, blob: packed (row, lo, width) of the anchors whose name occurs at least twice.

    Rows without ``bucket`` name the keys that occur in more than ``hot`` records: key, size.
    """
    n = partitions(docs.sparkSession)
    buckets = n * SPREAD

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches):
            first, seg, spans = scan(table)
            key, row, lo, w = _anchor_records(first, seg, spans, width, table["_row"].to_numpy())
            order = np.argsort(key, kind="stable")
            key, row, lo, w = key[order], row[order], lo[order], w[order]
            new = np.append(True, key[1:] != key[:-1])[: len(key)]
            again = np.append(~new[1:], False)[: len(key)]
            # 0: one in this chunk; 1: first of several, known to repeat; 2: known, not compared.
            flag = np.where(new, again.astype(np.uint8), 2).astype(np.uint8)
            where = np.where(flag == 2, mix(row.view(np.uint64)), key) % np.uint64(buckets)
            out = list(bucketed(where.astype(np.int64), key, row, lo, w, flag))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["bucket", "blob"]
            )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [x for b in batches for x in b.column("blob").to_pylist()]
        key, row, lo, w, flag = unpack(blobs, _ANCHOR)
        del blobs
        compared = np.flatnonzero(flag < 2)
        order = compared[np.argsort(key[compared], kind="stable")]
        new = np.append(True, key[order][1:] != key[order][:-1])[: len(order)]
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(order)))
        twice = flag > 0
        twice[order] |= np.repeat(size > 1, size)
        out = pair_blobs(row[twice], lo[twice], w[twice], buckets)
        none = pa.nulls(out.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays([*out.columns, none, none], ["bucket", "blob", "key", "size"])
        many = start[size > hot]
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(len(many), pa.int32()),
                pa.nulls(len(many), pa.binary()),
                pa.array(key[order][many].view(np.int64)),
                pa.array(size[size > hot].astype(np.int64)),
            ],
            ["bucket", "blob", "key", "size"],
        )

    met = docs.select("_row", "text").mapInArrow(tidy(emit), "bucket int, blob binary").repartition(n, "bucket")
    return store(met.mapInArrow(tidy(find), "bucket int, blob binary, key long, size long"), "anchors")


def pair_blobs(row: np.ndarray, a: np.ndarray, b: np.ndarray, buckets: int) -> pa.RecordBatch:
    """bucket, blob: pairs of numbers that belong to rows, packed by a bucket of the row key."""
    where = (mix(row.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    out = list(bucketed(where, row.astype("<i8"), a.astype("<i4"), b.astype("<i4")))
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["bucket", "blob"]
    )


def pairs_by_row(found: DataFrame, name: str) -> DataFrame:
    """_row and its packed pairs, one row each, from ``bucket, blob``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, a, b = unpack([x for batch in batches for x in batch.column("blob").to_pylist()], ("<i8", "<i4", "<i4"))
        order = np.lexsort((a, row))
        row, pairs = row[order], np.column_stack([a[order], b[order]])
        cuts = np.flatnonzero(np.append(True, row[1:] != row[:-1])[: len(row)])
        for k in range(0, len(cuts), 10_000):
            ends = np.append(cuts, len(row))[k : k + 10_001]
            offsets = ((ends - ends[0]) * 8).astype(np.int32)
            data = np.ascontiguousarray(pairs[ends[0] : ends[-1]])
            held = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([pa.array(row[ends[:-1]]), held], ["_row", name])

    met = found.where("bucket IS NOT NULL").select("bucket", "blob").repartition(partitions(found.sparkSession), "bucket")
    return met.mapInArrow(tidy(run), f"_row long, `{name}` binary")


def hot_keys(found: DataFrame, most: int = 100_000) -> np.ndarray:
    """The most frequent anchor names above the limit, at most ``most``: a list of bounded size."""
    rows = found.where("key IS NOT NULL").select("key", "size").orderBy(F.desc("size"), "key").limit(most).toArrow()
    return np.sort(rows["key"].to_numpy().view(np.uint64)) if rows.num_rows else np.zeros(0, np.uint64)


def windows_around(table: pa.Table, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranges [start, stop) of window starts of a chunk that hold a repeated anchor, merged."""
    a, b = [], []
    for k, blob in enumerate(table["spans"].to_pylist()):
        if not blob:
            continue
        pairs = np.frombuffer(blob, "<i4").reshape(-1, 2).astype(np.int64)
        lo, hi = pairs[:, 0] + first[k], pairs[:, 0] + pairs[:, 1] + first[k]
        start = np.maximum(hi - width, first[k])
        stop = np.minimum(lo, first[k + 1] - width) + 1
        order = np.argsort(start, kind="stable")
        a.append(start[order])
        b.append(stop[order])
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return merge_ranges(np.concatenate(a), np.concatenate(b))


def merge_ranges(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges sorted by start."""
    some = stop > start
    start, stop = start[some], stop[some]
    if not len(start):
        return start, stop
    reach = np.maximum.accumulate(stop)
    new = np.append(True, start[1:] > reach[:-1])
    ends = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)
    return start[new], reach[ends]


# ---- step 2: windows ------------------------------------------------------------------------

_WINDOW = ("<u8", "<u4", "<i8", "<i8", "<i4", "u1")
#: Second base of a window's name: 96 bits stand for its symbols.
CHECK_BASE = 0x2545F4914F6CDD1D


def check_names(names: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """32 more bits of the names of spans, from another running sum."""
    return (SpanHash(mix(names), CHECK_BASE)(lo, hi) >> np.uint64(32)).astype(np.uint32)


def fresh(*columns: np.ndarray) -> np.ndarray:
    """True where a row of sorted columns differs from the row before it."""
    n = len(columns[0])
    out = np.ones(n, bool)
    if n:
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def window_blobs(
    name: np.ndarray, check: np.ndarray, row: np.ndarray, rank: np.ndarray, start: np.ndarray, buckets: int
) -> list[tuple[int, bytes]]:
    """Records of windows by name. Flag 0: alone in the chunk; 1: the first of several; 2: known to
    repeat (a later row of the chunk's least rank) and not compared again."""
    order = np.lexsort((rank, check, name))
    name, check, row, rank, start = name[order], check[order], row[order], rank[order], start[order]
    new = fresh(name, check)
    group = np.cumsum(new) - 1
    least = rank[new][group] if len(name) else rank
    several = np.bincount(group, minlength=1)[group] > 1 if len(name) else new
    flag = np.where(rank > least, 2, several).astype(np.uint8)
    where = np.where(flag == 2, mix(row.view(np.uint64)), name) % np.uint64(buckets)
    return list(bucketed(where.astype(np.int64), name, check, row, rank, start.astype(np.int32), flag))


def resolve_windows(blobs: list[bytes], smaller: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows and starts of the windows whose name also has a smaller rank, or occurs again at all."""
    name, check, row, rank, start, flag = unpack(blobs, _WINDOW)
    compared = np.flatnonzero(flag < 2)
    order = compared[np.lexsort((rank[compared], check[compared], name[compared]))]
    new = fresh(name[order], check[order])
    group = np.cumsum(new) - 1
    hit = flag == 2
    if len(order):
        hit[order] = rank[order] > rank[order][new][group] if smaller else np.bincount(group)[group] > 1
    return row[hit], start[hit]


def runs(row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive starts of a row as ranges: row, start, stop."""
    order = np.lexsort((start, row))
    row, start = row[order], start[order].astype(np.int64)
    keep = np.append(True, (row[1:] != row[:-1]) | (start[1:] != start[:-1]))[: len(row)]
    row, start = row[keep], start[keep]
    new = np.append(True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1))[: len(row)]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(row))[: len(at)] - 1
    return row[at], start[at], start[last] + 1


def covered(blob: bytes | None, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbol ranges covered by the windows of packed start ranges, merged."""
    if not blob:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.frombuffer(blob, "<i4").reshape(-1, 2).astype(np.int64)
    order = np.argsort(pairs[:, 0], kind="stable")
    return merge_ranges(pairs[order, 0], pairs[order, 1] + width - 1)


def with_row(docs: DataFrame) -> DataFrame:
    """doc_id, text and a row key from both: repeated rows share it and get equal results."""
    return docs.select(
        F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))).alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
    )
