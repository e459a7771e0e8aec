"""Every query meets every item once, on a grid of query tiles and item tiles.

A tile of queries and a tile of items meet in one task, which multiplies them block by block and keeps the first ``k``
of each query. Both sides are sent out once for each tile of the other; the number of cells depends on the
machines, not on the rows, until a tile would pass ``TILE_BYTES``, so what is shuffled follows the rows. Products of
32 bits tell which pairs can reach a list, and products of 64 bits decide.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-12
#: Vectors of one side that a task holds, as doubles.
TILE_BYTES = 64 << 20
#: Products of one cell that are worth a task of their own.
CELL_WORK = 1 << 31
#: Queries, with their lists and pairs, that are worth a task of their own, however few the items are.
CELL_QUERIES = 4096
ROWS, COLUMNS = 256, 4096
QUERY, ITEM, PAIR = 0, 1, 2
HITS = "query_id string, item_id string, score double"


@dataclass(frozen=True)
class Grid:
    across: int  # tiles of queries
    down: int  # tiles of items


def grid_of(n_queries: int, n_items: int, dim: int, k: int, cells: int) -> Grid:
    """The grid of at least ``cells`` cells that moves the fewest bytes; small work needs fewer."""
    least_q = max(1, math.ceil(n_queries * dim * 8 / TILE_BYTES))
    least_i = max(1, math.ceil(n_items * dim * 8 / TILE_BYTES))
    cells = max(cells, least_q * least_i)

    def moved(down: int) -> int:
        across = max(least_q, math.ceil(cells / down))
        return across * n_items * (dim * 8 + 32) + down * n_queries * (dim * 8 + 32 + 40 * k)

    down = min(range(least_i, max(least_i, cells) + 1), key=moved)
    return Grid(max(least_q, math.ceil(cells / down)), down)


def cells_for(n_queries: int, n_items: int, dim: int, most: int) -> int:
    return max(1, min(most, max(math.ceil(n_queries * n_items * dim / CELL_WORK), math.ceil(n_queries / CELL_QUERIES))))


def tile_of(name: Column, tiles: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(tiles)).cast("int")


def lay(grid: Grid, queries: DataFrame, items: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Rows of each cell in one partition: queries, items, then pairs, each by id.

    ``queries`` and ``items`` are (id, tile, block, v), ``pairs`` (id, other, q_tile, i_tile).
    """
    down, across = F.lit(grid.down), F.lit(grid.across)
    copies = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    no_v = lambda df: F.lit(None).cast(df.schema["v"].dataType)
    none = F.lit(None).cast("string")
    asked = queries.select("id", "tile", "block", "v", copies(down).alias("_c")).select(
        (F.col("tile") * down + F.col("_c")).alias("part"), F.lit(QUERY).alias("kind"), "id", none.alias("other"), "block",
        F.col("v").alias("q"), no_v(items).alias("m"),
    )
    held = items.select("id", "tile", "block", "v", copies(across).alias("_c")).select(
        (F.col("_c") * down + F.col("tile")).alias("part"), F.lit(ITEM).alias("kind"), "id", none.alias("other"), "block",
        no_v(queries).alias("q"), F.col("v").alias("m"),
    )
    rows = asked.unionByName(held)
    if pairs is not None:
        rows = rows.unionByName(
            pairs.select(
                (F.col("q_tile") * down + F.col("i_tile")).alias("part"), F.lit(PAIR).alias("kind"), "id", "other",
                F.lit(None).cast("long").alias("block"), no_v(queries).alias("q"), no_v(items).alias("m"),
            )
        )
    return rows.repartitionById(grid.across * grid.down, "part").sortWithinPartitions("kind", "id")


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


@dataclass
class Side:
    """Vectors of one side of a cell in the order of their blocks; ``rank`` is the place by id."""

    ids: pa.Array
    raw: np.ndarray
    block: np.ndarray
    rank: np.ndarray = field(init=False)
    starts: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.rank = np.argsort(self.block, kind="stable")
        self.block, self.raw = self.block[self.rank], self.raw[self.rank]
        new = np.r_[True, self.block[1:] != self.block[:-1]] if len(self.block) else np.zeros(0, bool)
        self.starts = np.flatnonzero(new)

    def __len__(self) -> int:
        return len(self.raw)

    def spans(self) -> list[tuple[int, int]]:
        return list(zip(self.starts, [*self.starts[1:], len(self)]))

    def exact(self, at: np.ndarray | slice) -> np.ndarray:
        return self.raw[at].astype(np.float64)

    def names(self, at: np.ndarray) -> pa.Array:
        return self.ids.take(pa.array(self.rank[at]))


def read_cell(batches: Iterator[pa.RecordBatch], of_query: Callable, of_item: Callable) -> tuple[Side, Side, pa.Table] | None:
    """Both sides and the pairs (id, other) of one cell; ``of_query`` and ``of_item`` turn columns into matrices."""
    parts: dict[int, list] = {QUERY: [], ITEM: [], PAIR: []}
    for batch in batches:
        for kind in parts:
            rows = batch.filter(pc.equal(batch.column("kind"), kind))
            if not rows.num_rows:
                continue
            if kind == PAIR:
                parts[kind].append(rows.select(["id", "other"]))
                continue
            m = of_query(rows.column("q")) if kind == QUERY else of_item(rows.column("m"))
            parts[kind].append((rows.column("id"), m, rows.column("block").to_numpy(zero_copy_only=False)))
    if not parts[QUERY] or not parts[ITEM]:
        return None
    sides = [Side(pa.concat_arrays(ids), np.concatenate(m), np.concatenate(block)) for ids, m, block in (zip(*parts[s]) for s in (QUERY, ITEM))]
    pairs = pa.schema([("id", pa.string()), ("other", pa.string())])
    return sides[0], sides[1], pa.Table.from_batches(parts[PAIR], pairs)


class Best:
    """The first ``k`` items of each of ``n`` queries so far: by score, then by the order of ids."""

    def __init__(self, n: int, k: int, rank: np.ndarray) -> None:
        self.n, self.k, self.rank = n, k, rank
        self.held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        self.fresh: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_fresh = 0
        self.kth = np.full(n, -np.inf)
        self.last = np.full(n, len(rank))

    def add(self, row: np.ndarray, at: np.ndarray, score: np.ndarray) -> None:
        enters = (score > self.kth[row]) | ((score == self.kth[row]) & (self.rank[at] < self.last[row]))
        self.fresh.append((row[enters], at[enters], score[enters]))
        self.n_fresh += int(enters.sum())
        if self.n_fresh >= self.n * self.k:
            self.settle()

    def settle(self) -> None:
        if not self.n_fresh:
            return
        row, at, score = (np.concatenate(x) for x in zip(self.held, *self.fresh))
        order = np.lexsort((self.rank[at], -score, row))
        row, at, score = row[order], at[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, np.arange(self.n))[row]
        kept = place < self.k
        self.held = (row[kept], at[kept], score[kept])
        full = place == self.k - 1
        self.kth[row[full]], self.last[row[full]] = score[full], self.rank[at[full]]
        self.fresh, self.n_fresh = [], 0


class Scorer:
    """Scores of query rows against item rows of one cell.

    Cosine, rounded inner product or, with ``digits`` None, the plain one. ``gone`` are (query row, item row) that are
    not to be scored.
    """

    def __init__(self, q: Side, m: Side, k: int, cosine: bool, digits: int | None, gone: tuple[np.ndarray, np.ndarray]) -> None:
        self.q, self.m, self.k, self.cosine, self.digits = q, m, k, cosine, digits
        self.m_norm = self._norms(m)
        self.longest = 1.0 if cosine else max(float(self.m_norm.max(initial=0.0)), EPS)
        self.small = np.empty(m.raw.shape, np.float32)
        for a in range(0, len(m), COLUMNS):
            over = self.m_norm[a : a + COLUMNS, None] if cosine else self.longest
            self.small[a : a + COLUMNS] = m.raw[a : a + COLUMNS] / over
        self.slack = (m.raw.shape[1] + 8) * 1.2e-7
        order = np.argsort(gone[0], kind="stable")
        self.gone = (gone[0][order], gone[1][order])
        self.column = np.full(len(m), -1)

    @staticmethod
    def _norms(side: Side) -> np.ndarray:
        cuts = range(0, len(side), COLUMNS)
        return np.maximum(np.concatenate([np.linalg.norm(side.exact(slice(a, a + COLUMNS)), axis=1) for a in cuts]), EPS)

    def open(self, a: int, b: int) -> None:
        """Begin with the query rows ``a`` to ``b``."""
        x = self.q.exact(slice(a, b))
        norm = np.maximum(np.linalg.norm(x, axis=1), EPS)
        self.exact_q = x / norm[:, None] if self.cosine else x
        self.small_q = (x / norm[:, None]).astype(np.float32)
        self.scale = np.ones(b - a) if self.cosine else norm * self.longest
        lo, hi = np.searchsorted(self.gone[0], (a, b))
        self.gone_row, self.gone_at = self.gone[0][lo:hi] - a, self.gone[1][lo:hi]
        self.best = Best(b - a, self.k, self.m.rank)

    def _exact_items(self, at: np.ndarray) -> np.ndarray:
        x = self.m.exact(at)
        return x / self.m_norm[at][:, None] if self.cosine else x

    def _rounded(self, scores: np.ndarray) -> np.ndarray:
        # Rounded, so that equal vectors tie and the id decides.
        return scores if self.digits is None else np.round(scores, self.digits)

    def scan(self, at: np.ndarray, allowed: np.ndarray | None = None) -> None:
        """Score the open queries against the item rows ``at``; ``allowed`` (queries, len(at)) leaves pairs out."""
        for a in range(0, len(at), COLUMNS):
            self._scan(at[a : a + COLUMNS], None if allowed is None else allowed[:, a : a + COLUMNS])

    def _scan(self, at: np.ndarray, allowed: np.ndarray | None) -> None:
        best = self.best
        near = self.small_q @ self.small[at].T
        if allowed is not None:
            near[~allowed] = -np.inf
        if len(self.gone_at):
            self.column[at] = np.arange(len(at))
            column = self.column[self.gone_at]
            near[self.gone_row[column >= 0], column[column >= 0]] = -np.inf
            self.column[at] = -1
        least = (best.kth - 1e-9) / self.scale - self.slack
        new = best.kth == -np.inf
        if new.any() and len(at) >= self.k:
            first = np.partition(near[new], len(at) - self.k, axis=1)[:, len(at) - self.k]
            least[new] = first - 2 * self.slack - 1e-9 / self.scale[new]
        reach = (near >= least[:, None].astype(np.float32)) & (near > -np.inf)
        # Most pairs are far below; where many tie, one exact product of the block costs less than pair by pair.
        found = np.flatnonzero(reach)
        row, column = found // len(at), found % len(at)
        if len(found) * 16 > near.size:
            score = self._rounded((self.exact_q @ self._exact_items(at).T))[row, column]
            best.add(row, at[column], score)
            return
        for c in range(0, len(found), 1 << 16):
            r, i = row[c : c + (1 << 16)], at[column[c : c + (1 << 16)]]
            best.add(r, i, self._rounded(np.einsum("ij,ij->i", self.exact_q[r], self._exact_items(i))))

    def close(self, a: int) -> pa.RecordBatch:
        self.best.settle()
        row, at, score = self.best.held
        return pa.RecordBatch.from_arrays(
            [self.q.names(row + a), self.m.names(at), pa.array(score, pa.float64())], ["query_id", "item_id", "score"]
        )


def places(side: Side, names: pa.ChunkedArray) -> np.ndarray:
    """Row of each name, the last one that has it; -1 where none has."""
    where = {name: i for i, name in enumerate(side.ids.to_pylist())}
    back = np.empty(len(side), np.int64)
    back[side.rank] = np.arange(len(side))
    found = np.array([where.get(n, -1) for n in names.to_pylist()], np.int64)
    return np.where(found >= 0, back[found], -1)


def score_pairs(dim: int):
    """Arrow function over one cell: the exact cosines of its pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        double = lambda column: matrix(column, dim).astype(np.float64)
        cell = read_cell(batches, double, double)
        if cell is None:
            return
        q, m, pairs = cell
        named = [pd.DataFrame({name: s.ids.to_pandas().iloc[s.rank].to_numpy(), at: np.arange(len(s))}) for s, name, at in ((q, "id", "a"), (m, "other", "b"))]
        for s in (q, m):
            s.raw /= np.maximum(np.linalg.norm(s.raw, axis=1, keepdims=True), EPS)
        for batch in pairs.to_batches(max_chunksize=1 << 16):
            met = batch.to_pandas().dropna().merge(named[0].dropna(), on="id").merge(named[1].dropna(), on="other")
            scores = np.round(np.einsum("ij,ij->i", q.raw[met["a"].to_numpy()], m.raw[met["b"].to_numpy()]), 9)
            yield pa.RecordBatch.from_arrays(
                [pa.array(met["id"], pa.string()), pa.array(met["other"], pa.string()), pa.array(scores, pa.float64())], ["query_id", "item_id", "score"]
            )

    return run
