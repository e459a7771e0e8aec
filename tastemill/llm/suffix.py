"""Suffix-array dedup: bytes of passages that occur again are removed, over data of any size.

Induced sorting, spread over Spark. The recursion names leftmost-S substrings round by round; its
last round leaves few suffixes, one in some tens of bytes, and a passage shares them with each of
its copies. Suffixes whose start repeats are carried as tuples (name, suffix, bytes to the left)
to the partition of their name, where Spark's external sorter, spilled runs merged by a priority
queue, puts them in order. Neighbours give the common-prefix values. The suffixes between are
then induced: one byte to the left at a time, in the order of (preceding bytes, rank), with the
common prefix grown by one and the least value between two ranks taken from a range-minimum table.

Rule: texts are UTF-8 bytes; a byte is removed if a string of ``width`` bytes that covers it also
starts anywhere else, in the same document or another. Strings are judged on the input and never
cross documents, so every copy of a passage goes, the first too.

A name in more than ``HOT`` distinct contexts would fill one task: the windows around the most
frequent such names are compared by hash instead, which spreads them.

Defined cases: a null text is empty; shorter texts than ``width`` keep all; repeated rows are
copies of each other; a null doc_id is kept; the text column of the result drops a character cut
in half, the byte column doesn't; extra columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tastemill.llm import repeats as R
from tastemill.llm.common import BYTE_NAMES, SpanHash, as_bytes, chunks, mix, partitions, ranges, tidy

WIDTH = 200
ROUNDS = 3
HOT = 20_000
#: Suffix tuples that are induced together; a name's tuples always are.
BLOCK = 16_000

_TUPLE = "kind int, part long, suffix binary, prefix binary, row long, at int, last int"


def _scan(width: int, rounds: int) -> R.Scan:
    def scan(table: pa.Table):
        data, offsets = as_bytes(table["text"])
        spans = SpanHash(BYTE_NAMES[data])
        parse = R.leftmost_minima(R.positions(offsets), data)
        for _ in range(rounds - 1):
            parse = R.leftmost_minima(parse, spans(parse.at[:-1], parse.at[1:]))
        return offsets, R.anchors(parse, spans, offsets, width), spans

    return scan


def _binary(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    at, _ = ranges(lo, hi)
    offsets = np.concatenate([[0], np.cumsum(hi - lo)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lo), [None, pa.py_buffer(offsets), pa.py_buffer(data[at].tobytes())])


def _tuples(part, suffix, prefix, row, at, last, kind: int) -> pa.RecordBatch:
    n = len(part)
    columns = [
        pa.array(np.full(n, kind, np.int32)), pa.array(part, pa.int64()), suffix,
        prefix if prefix is not None else pa.array([b""] * n, pa.binary()),
        pa.array(row, pa.int64()), pa.array(at, pa.int32()), pa.array(last, pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["kind", "part", "suffix", "prefix", "row", "at", "last"])


def induce(part, suffix: pa.Array, prefix: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(tuple, x) of all windows that start x bytes left of a tuple's suffix and occur elsewhere.

    Tuples come in the order of (part, suffix).
    """
    n = len(part)
    text, cut = as_bytes_binary(suffix)
    left, lcut = as_bytes_binary(prefix)
    length, reach = np.diff(cut), np.diff(lcut)
    grid = np.zeros((n, width), np.uint8)
    grid[np.arange(width) < length[:, None]] = text
    same = grid[1:] == grid[:-1]
    common = np.where(same.all(1), width, same.argmin(1)) if n > 1 else np.zeros(0, np.int64)
    common = np.where(part[1:] == part[:-1], common, 0)
    table = [np.append(0, common).astype(np.int16)]  # table[0][i]: common prefix of ranks i-1 and i
    k = 1
    while 2 * k <= n:
        table.append(np.minimum(table[-1][:-k], table[-1][k:]))
        k *= 2
    group = np.cumsum(np.append(True, part[1:] != part[:-1])[:n]) - 1
    alive = np.arange(n)
    found_t, found_x = [], []
    for x in range(width):
        if x:
            long = reach[alive] >= x
            alive, group = alive[long], group[long]
            code = group * 256 + left[lcut[alive + 1] - x]
            order = np.argsort(code, kind="stable")
            alive, code = alive[order], code[order]
            group = np.cumsum(np.append(True, code[1:] != code[:-1])[: len(code)]) - 1
        if len(alive) < 2:
            break
        pair = np.flatnonzero(group[1:] == group[:-1])
        i, j = alive[pair], alive[pair + 1]
        level = np.log2(j - i).astype(np.int64)
        least = np.empty(len(pair), np.int64)
        for k in np.unique(level):
            sel = level == k
            least[sel] = np.minimum(table[k][i[sel] + 1], table[k][j[sel] + 1 - (1 << k)])
        good = np.minimum(least, np.minimum(length[i], length[j])) >= width - x
        hit = np.unique(np.concatenate([i[good], j[good]]))
        found_t.append(hit)
        found_x.append(np.full(len(hit), x))
        # A suffix without a companion at this depth has none further left.
        some = np.zeros(len(alive), bool)
        some[pair] = some[pair + 1] = True
        alive, group = alive[some], group[some]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_t]), np.concatenate([none, *found_x])


def as_bytes_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary())
    bufs = column.buffers()
    offsets = np.frombuffer(bufs[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def repeated_bytes(docs: DataFrame, width: int = WIDTH, rounds: int = ROUNDS, hot_limit: int = HOT) -> DataFrame:
    """_row, ranges: packed [start, stop) pairs of window starts that occur elsewhere too."""
    spark = docs.sparkSession
    n = partitions(spark)
    scan = _scan(width, rounds)
    found = R.repeated_anchors(docs, scan, width, hot_limit)
    hot = R.hot_keys(found)
    joined = docs.repartition(n, "_row").join(R.pairs_by_row(found, "spans"), "_row", "left")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = (b.filter(b.column("spans").is_valid()) for b in batches)
        for table in chunks(some):
            first, seg, spans = scan(table)
            data, _ = as_bytes(table["text"])
            row_id = table["_row"].to_numpy()
            marks = []
            for k, blob in enumerate(table["spans"].to_pylist()):
                pairs = np.frombuffer(blob, "<i4").reshape(-1, 2).astype(np.int64)
                marks.append(((pairs[:, 0] + first[k]) << 16) | pairs[:, 1])
            marks = np.unique(np.concatenate(marks))
            held = seg.anchor >= 0
            twice = np.isin((seg.lo << 16) | (seg.hi - seg.lo), marks)
            hot_anchor = np.isin(seg.key, hot)
            # Windows by hash: no anchor inside, or an anchor whose name is too frequent.
            by_hash = ~held
            by_hash[held] = (twice & hot_anchor)[seg.anchor[held]]
            w, _ = ranges(seg.start[by_hash], seg.stop[by_hash])
            row = np.searchsorted(first, w, side="right") - 1
            check = R.check_names(BYTE_NAMES[data], w, w + width) if len(w) else np.zeros(0, np.uint32)
            yield _window_tuples(spans(w, w + width), check, row_id[row], w - first[row], n * R.SPREAD)
            # All others: one tuple per occurrence of an anchor, with the bytes its windows need.
            use = held.copy()
            use[held] = (twice & ~hot_anchor)[seg.anchor[held]]
            a, start, stop = seg.anchor[use], seg.start[use], seg.stop[use]
            order = np.argsort(a, kind="stable")
            a, start, stop = a[order], start[order], stop[order]
            new = np.flatnonzero(np.append(True, a[1:] != a[:-1])[: len(a)])
            if not len(new):
                continue
            a = a[new]
            start, stop = np.minimum.reduceat(start, new), np.maximum.reduceat(stop, new)
            at = seg.lo[a]
            row = np.searchsorted(first, at, side="right") - 1
            end = np.minimum(at + width, first[row + 1])
            whole = mix(spans(start, end) + seg.key[a] + (at - start).astype(np.uint64))
            _, lead, group, size = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
            known = np.flatnonzero(size[group] > 1)
            yield _tuples(
                seg.key[a[lead]].view(np.int64), _binary(data, at[lead], end[lead]), _binary(data, start[lead], at[lead]),
                row_id[row[lead]], at[lead] - first[row[lead]], stop[lead] - 1 - first[row[lead]], 0,
            )
            if len(known):
                at_row = first[row[known]]
                out = R.pair_blobs(row_id[row[known]], start[known] - at_row, stop[known] - at_row, n * R.SPREAD)
                zero = np.zeros(out.num_rows, np.int32)
                yield _tuples(out["bucket"].cast(pa.int64()), out["blob"], None, zero.astype(np.int64), zero, zero, 2)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        blobs: list[bytes] = []

        def ranked(table: pa.Table) -> pa.RecordBatch:
            t, x = induce(table["part"].to_numpy(), table["suffix"], table["prefix"], width)
            start = table["at"].to_numpy()[t] - x
            inside = start <= table["last"].to_numpy()[t]
            return R.pair_blobs(*R.runs(table["row"].to_numpy()[t][inside], start[inside]), n * R.SPREAD)

        for batch in batches:
            kind = batch.column("kind").to_numpy()
            blobs += batch.filter(pa.array(kind == 1)).column("suffix").to_pylist()
            known = batch.filter(pa.array(kind == 2))
            if known.num_rows:
                part = known.column("part").cast(pa.int32())
                yield pa.RecordBatch.from_arrays([part, known.column("suffix")], ["bucket", "blob"])
            batch = batch.filter(pa.array(kind == 0))
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK:
                table = pa.Table.from_batches(held).combine_chunks()
                part = table["part"].to_numpy()
                cut = int(np.flatnonzero(part != part[-1])[-1]) + 1 if part[0] != part[-1] else 0
                if cut:
                    yield ranked(table.slice(0, cut).combine_chunks())
                held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield ranked(pa.Table.from_batches(held).combine_chunks())
        row, start = R.resolve_windows(blobs, False)
        yield R.pair_blobs(*R.runs(row, start), n * R.SPREAD)

    met = joined.mapInArrow(tidy(emit), _TUPLE).repartition(n, "part").sortWithinPartitions("kind", "part", "suffix")
    return R.pairs_by_row(met.mapInArrow(tidy(resolve), "bucket int, blob binary"), "ranges")


def _window_tuples(name, check, row, start, buckets: int) -> pa.RecordBatch:
    """Windows compared by hash, as blobs in the place of suffixes."""
    order = np.lexsort((check, name))
    name, check, row, start = name[order], check[order], row[order], start[order]
    new = R.fresh(name, check)
    several = np.bincount(np.cumsum(new) - 1, minlength=1)[np.cumsum(new) - 1] > 1 if len(name) else new
    # A name that repeats in the chunk is known for all its rows; its first also goes to the others.
    keep = np.concatenate([np.flatnonzero(several), np.flatnonzero(new)])
    flag = np.concatenate([np.full(several.sum(), 2), np.full(new.sum(), 0)]).astype(np.uint8)
    name, check, row, start = name[keep], check[keep], row[keep], start[keep]
    where = np.where(flag == 2, mix(row.view(np.uint64)), name) % np.uint64(buckets)
    none = np.zeros(len(row), np.int64)
    out = list(R.bucketed(where.astype(np.int64), name, check, row, none, start.astype(np.int32), flag))
    part = np.array([b for b, _ in out], np.int64)
    zero = np.zeros(len(out), np.int32)
    return _tuples(part, pa.array([x for _, x in out], pa.binary()), None, np.zeros(len(out), np.int64), zero, zero, 1)


def remove_repeats(docs: DataFrame, width: int = WIDTH, rounds: int = ROUNDS, hot_limit: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, removed (byte spans), kept (bytes), kept_text, kept_sha256."""
    rows = R.with_row(docs)
    n = partitions(docs.sparkSession)
    joined = rows.repartition(n, "_row").join(repeated_bytes(rows, width, rounds, hot_limit), "_row", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, blob in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
                data = (text or "").encode()
                a, b = R.covered(blob, width)
                parts, last = [], 0
                for x, y in zip(a.tolist(), b.tolist()):
                    parts.append(data[last:x])
                    last = y
                kept = b"".join([*parts, data[last:]])
                spans = [{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist())]
                out.append(
                    (len(data), len(data) - len(kept), len(spans), spans, kept, kept.decode("utf-8", "ignore"), hashlib.sha256(kept).hexdigest())
                )
            kinds = [
                pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                pa.binary(), pa.string(), pa.string(),
            ]
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], [f.split(" ")[0] for f in _RESULT.split(", ")])

    return joined.mapInArrow(tidy(run), _RESULT)


_RESULT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, removed array<struct<start:long,end:long>>, "
    "kept binary, kept_text string, kept_sha256 string"
)
