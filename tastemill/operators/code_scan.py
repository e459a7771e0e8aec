"""Candidates of an inverted index from its codes, and their exact scores.

A tile of queries meets a tile of the index's codes in one task. Items of one cell with equal codes are decoded and multiplied
once; a query is multiplied with the cells it probes alone, the block's nearest cells first, and what is below its
worst candidate so far is left out. Candidates travel as one list of item numbers for each query, never as pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.operators import tiles
from tastemill.operators.tiles import tile_of

if TYPE_CHECKING:
    from tastemill.operators.vector_index import Quantizer

HELD, ASKED = 0, 1
#: Queries that are scanned together; their places take ROW_BITS of a packed entry.
ROW_BITS, VALUE_BITS, PLACE_BITS = 9, 24, 31
ROWS = 1 << ROW_BITS
#: Products are told apart down to 1 / SCALE; they lie between -2 and 2.
SCALE = float(1 << (VALUE_BITS - 2))
LISTS = "query_id string, v array<double>, near array<struct<near:double,num:long>>"


def _packed(row: np.ndarray, value: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Entries that sort by row, then from the greatest value, then by place."""
    head = row.astype(np.uint64) << np.uint64(VALUE_BITS + PLACE_BITS)
    return head | (value.astype(np.uint64) << np.uint64(PLACE_BITS)) | place.astype(np.uint64)


def _stepped(near: np.ndarray) -> np.ndarray:
    """A product as a whole number, smaller for greater ones."""
    return np.clip((2.0 - near.astype(np.float64)) * SCALE, 0, (1 << VALUE_BITS) - 1)


def _row(entries: np.ndarray) -> np.ndarray:
    return (entries >> np.uint64(VALUE_BITS + PLACE_BITS)).astype(np.int64)


def _value(entries: np.ndarray) -> np.ndarray:
    return ((entries >> np.uint64(PLACE_BITS)) & np.uint64((1 << VALUE_BITS) - 1)).astype(np.int64)


def _place(entries: np.ndarray) -> np.ndarray:
    return (entries & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)


def _first(entries: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``most`` of the sorted entries of each of ``n`` rows, and the number of each row before that."""
    row = _row(entries)
    counts = np.bincount(row, minlength=n)
    return entries[np.arange(len(row)) - (np.cumsum(counts) - counts)[row] < most], counts


class Codes:
    """Codes of one tile: distinct (cell, code) in the order of cells, with the numbers of their items."""

    def __init__(self, quantizer: Quantizer, cell: np.ndarray, nums: np.ndarray, codes: np.ndarray) -> None:
        self.quantizer = quantizer
        wide = np.zeros((len(codes), math.ceil(codes.shape[1] / 8) * 8), np.uint8)
        wide[:, : codes.shape[1]] = codes
        words = wide.view(np.uint64)
        order = np.lexsort((nums, *words.T, cell))
        cell, words, self.nums = cell[order], words[order], nums[order]
        new = np.r_[True, (cell[1:] != cell[:-1]) | (words[1:] != words[:-1]).any(axis=1)]
        self.start = np.flatnonzero(new)
        self.size = np.diff(np.append(self.start, len(cell)))
        self.codes = codes[order][self.start]
        cell = cell[self.start]
        ends = np.flatnonzero(np.r_[cell[1:] != cell[:-1], True]) + 1
        self.spans = {int(cell[a]): (int(a), int(b)) for a, b in zip(np.append(0, ends[:-1]), ends)}
        # Place of each item among all of the tile by number.
        self.by_num = np.sort(self.nums)
        self.place = np.searchsorted(self.by_num, self.nums)
        self.books, self.centers = quantizer.books.astype(np.float32), quantizer.centers.astype(np.float32)
        small = len(self.codes) * self.centers.shape[1] * 4 <= tiles.TILE_BYTES
        self.kept = {c: self._decoded(c) for c in self.spans} if small else None

    def _decoded(self, cell: int) -> np.ndarray:
        a, b = self.spans[cell]
        rest = np.concatenate([book[self.codes[a:b, p]] for p, book in enumerate(self.books)], axis=1)
        return rest[:, : self.centers.shape[1]] + self.centers[cell]

    def decoded(self, cell: int) -> np.ndarray:
        return self._decoded(cell) if self.kept is None else self.kept[cell]

    def nearest(self, q: np.ndarray, n_probe: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, product and item number of the ``most`` best items of each of at most ``ROWS`` unit vectors."""
        n, small = len(q), q.astype(np.float32)
        probed = np.zeros((len(self.centers), n), bool)
        np.put_along_axis(probed, self.quantizer.cell_order(q)[:, :n_probe].T, True, axis=0)
        visits = [c for c in self.quantizer.cell_order(q.mean(axis=0, keepdims=True))[0].tolist() if c in self.spans]
        least = np.full(n, -np.inf, np.float32)
        held, fresh, n_fresh = np.zeros(0, np.uint64), [], 0

        def settle() -> None:
            nonlocal held, fresh, n_fresh
            held, counts = _first(np.sort(np.concatenate([held, *fresh])), n, most)
            fresh, n_fresh = [], 0
            full = np.flatnonzero(counts >= most)
            last = (np.cumsum(np.minimum(counts, most)) - 1)[full]
            least[full] = 2.0 - (_value(held[last]) + 2) / SCALE  # a step below, so that rounding loses nothing

        for cell in visits:
            rows = np.flatnonzero(probed[cell])
            if not len(rows):
                continue
            whole = len(rows) == n
            m, first = self.decoded(cell), self.spans[cell][0]
            near = (small if whole else small[rows]) @ m.T
            at = np.flatnonzero(near >= (least if whole else least[rows])[:, None])
            if len(at):
                fresh.append(_packed(rows[at // len(m)], _stepped(near.ravel()[at]), first + at % len(m)))
                n_fresh += len(at)
                if n_fresh > 2 * n * most:
                    settle()
        settle()
        if len(self.start) < len(self.nums):
            # Items of equal codes follow each other by number, so the first of them are enough.
            place, copies = _place(held), np.minimum(self.size, most)
            owner = np.repeat(np.arange(len(held)), copies[place])
            beside = np.arange(len(owner)) - np.repeat(np.cumsum(copies[place]) - copies[place], copies[place])
            item = self.start[place[owner]] + beside
            held, _ = _first(np.sort(_packed(_row(held)[owner], _value(held)[owner], self.place[item])), n, most)
            nums = self.by_num[_place(held)]
        else:
            nums = self.nums[_place(held)]
        return _row(held), 2.0 - _value(held) / SCALE, nums


def _ends(row: np.ndarray, n: int) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=n))), pa.int32())


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), tiles.EPS)


def _scan(quantizer: Quantizer, n_probe: int, most: int):
    """Arrow function over one cell of the grid, codes first, queries by their nearest cell."""
    parts = len(quantizer.books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, codes = [], None
        for batch in batches:
            first = int(np.searchsorted(batch.column("kind").to_numpy(), ASKED))
            if first:
                rows = batch.slice(0, first)
                sizes = rows.column("nums").value_lengths().to_numpy()
                raw = np.frombuffer(b"".join(rows.column("codes").flatten().to_pylist()), np.uint8).reshape(-1, parts)
                held.append((np.repeat(rows.column("cell").to_numpy(), sizes), rows.column("nums").flatten().to_numpy(), raw))
            asked = batch.slice(first)
            if not held or not asked.num_rows:
                continue
            codes = codes or Codes(quantizer, *(np.concatenate(x) for x in zip(*held)))
            for a in range(0, asked.num_rows, ROWS):
                part = asked.slice(a, ROWS)
                row, near, nums = codes.nearest(_unit(_matrix(part.column("v"))), n_probe, most)
                entries = pa.StructArray.from_arrays([pa.array(near, pa.float64()), pa.array(nums, pa.int64())], ["near", "num"])
                lists = pa.ListArray.from_arrays(_ends(row, part.num_rows), entries)
                yield pa.RecordBatch.from_arrays([part.column("query_id"), part.column("v"), lists], ["query_id", "v", "near"])

    return run


def near_lists(queries: DataFrame, n_queries: int, codes: DataFrame, n_items: int, quantizer: Quantizer, n_probe: int, most: int, cells: int) -> DataFrame:
    """``(query_id, v, near)`` of ``(query_id, v, cell)``: the first ``most`` (product, item number) of each query in each tile of codes.

    ``codes`` is (cell, block, nums, codes). One tile holds some millions of items, so mostly a query has one list.
    """
    down = tiles_of_codes(n_items, quantizer)
    across = math.ceil(cells / down)
    none = lambda kind: F.lit(None).cast(kind)
    if down > 1:
        # Equal codes stay together, so that they tie.
        one = codes.select("cell", F.explode(F.arrays_zip("nums", "codes")).alias("r")).withColumn("tile", tile_of(F.col("r.codes"), down))
        codes = one.groupBy("cell", "tile", F.pmod(F.col("r.nums"), F.lit(64)).alias("block")).agg(F.collect_list("r").alias("r"))
        codes = codes.select("cell", "tile", F.col("r.nums").alias("nums"), F.col("r.codes").alias("codes"))
    else:
        codes = codes.withColumn("tile", F.lit(0))
    held = codes.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(across - 1)))).select(
        (F.col("_c") * down + F.col("tile")).alias("part"), F.lit(HELD).alias("kind"), "cell", "nums", "codes",
        none("string").alias("query_id"), none("array<double>").alias("v"),
    )
    asked = queries.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(down - 1)))).select(
        (tile_of(F.col("query_id"), across) * down + F.col("_c")).alias("part"), F.lit(ASKED).alias("kind"), "cell",
        none("array<long>").alias("nums"), none("array<binary>").alias("codes"), "query_id", F.col("v").cast("array<double>").alias("v"),
    )
    laid = held.unionByName(asked).repartitionById(across * down, "part").sortWithinPartitions("kind", "cell", "query_id")
    return laid.drop("part").mapInArrow(_scan(quantizer, n_probe, most), LISTS)


def tiles_of_codes(n_items: int, quantizer: Quantizer) -> int:
    return max(1, math.ceil(n_items * (len(quantizer.books) + 16) / tiles.TILE_BYTES))


def merged(lists: DataFrame, most: int) -> DataFrame:
    """``(query_id, near)``: the first ``most`` of all lists of one query."""
    entries = F.flatten(F.collect_list(F.transform("near", lambda x: F.struct((-x["near"]).alias("near"), x["num"].alias("num")))))
    best = F.slice(F.array_sort("e"), 1, most)
    grouped = lists.groupBy("query_id").agg(entries.alias("e"))
    return grouped.select("query_id", F.transform(best, lambda x: F.struct((-x["near"]).alias("near"), x["num"].alias("num"))).alias("near"))


def _score(k: int):
    """Arrow function over one cell: the ``k`` best exact cosines among each query's numbered items, items first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, names, m, nums = [], None, None, None
        for batch in batches:
            first = int(np.searchsorted(batch.column("kind").to_numpy(), ASKED))
            if first:
                rows = batch.slice(0, first)
                parts.append((rows.column("item_id"), rows.column("num").to_numpy(), _matrix(rows.column("m"))))
            asked = batch.slice(first)
            if not parts or not asked.num_rows:
                continue
            if m is None:
                nums = np.concatenate([x[1] for x in parts])
                order = np.argsort(nums, kind="stable")
                names, nums = pa.concat_arrays([x[0] for x in parts]).take(pa.array(order)), nums[order]
                m = np.concatenate([x[2] for x in parts])[order]
                m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), tiles.EPS)
                parts = [()]
            for a in range(0, asked.num_rows, 64):
                part = asked.slice(a, 64)
                q, wanted = _unit(_matrix(part.column("v"))), part.column("nums").flatten().to_numpy()
                row = np.repeat(np.arange(part.num_rows), part.column("nums").value_lengths().to_numpy())
                lo, hi = np.searchsorted(nums, wanted), np.searchsorted(nums, wanted, side="right")
                n = hi - lo  # an id that comes twice is met twice
                row, at = np.repeat(row, n), np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                # Rounded, so that equal vectors tie and the id decides.
                score = np.round(np.einsum("ij,ij->i", q[row], m[at]), 9)
                order = np.lexsort((at, -score, row))
                row, at, score = row[order], at[order], score[order]
                best = np.arange(len(row)) - np.searchsorted(row, np.arange(part.num_rows))[row] < k
                yield pa.RecordBatch.from_arrays(
                    [part.column("query_id").take(pa.array(row[best])), names.take(pa.array(at[best])), pa.array(score[best], pa.float64())],
                    ["query_id", "item_id", "score"],
                )

    return run


def score_lists(lists: DataFrame, vectors: DataFrame, grid: tiles.Grid, k: int) -> DataFrame:
    """``(query_id, item_id, score)`` of ``(query_id, v, nums)``: the ``k`` best of each query in each tile of ``(num, item_id, v)``."""
    none = lambda kind: F.lit(None).cast(kind)
    held = vectors.where("item_id IS NOT NULL").withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(grid.across - 1)))).select(
        (F.col("_c") * grid.down + F.pmod(F.col("num"), F.lit(grid.down))).cast("int").alias("part"), F.lit(HELD).alias("kind"),
        none("string").alias("query_id"), "item_id", "num", F.col("v").alias("m"), none("array<double>").alias("v"), none("array<long>").alias("nums"),
    )
    of_tile = lambda t: F.filter("nums", lambda x: F.pmod(x, F.lit(grid.down)) == t)
    cut = F.explode(F.array(*[F.struct(F.lit(t).alias("tile"), of_tile(t).alias("nums")) for t in range(grid.down)]))
    asked = lists.select("query_id", "v", cut.alias("c")).where(F.size("c.nums") > 0).select(
        (tile_of(F.col("query_id"), grid.across) * grid.down + F.col("c.tile")).alias("part"), F.lit(ASKED).alias("kind"),
        "query_id", none("string").alias("item_id"), none("long").alias("num"), none("array<float>").alias("m"), "v", "c.nums",
    )
    laid = held.unionByName(asked).repartitionById(grid.across * grid.down, "part").sortWithinPartitions("kind")
    return laid.drop("part").mapInArrow(_score(k), tiles.HITS)
