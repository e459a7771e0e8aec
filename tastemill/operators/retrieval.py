"""Exact nearest-item search over blocks of vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.functions.vectors import EPS
from tastemill.operators import tiles as T
from tastemill.operators.ordering import top_k_per_group
from tastemill.session import materialize

QUERY_BLOCK = 256
ITEM_BLOCK = 2048
# Below this many bytes of items, small work takes few cells of the grid.
BROADCAST_BYTES = 64 << 20
# Beyond it, at least this many cells exist.
MIN_JOIN_KEYS = 64
# From this many item blocks on, blocks are formed around pivots and skipped by bounds; pivots are held by all tasks.
PRUNE_FROM = 8
MAX_PIVOTS = 1024
# The rounding that a bound allows for.
SLACK = 1e-6


def _unit_rows(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), EPS)


def _bucket(id_col: Column, n) -> Column:
    return F.pmod(F.xxhash64(id_col), n if isinstance(n, Column) else F.lit(n)).cast("int")


def _directions(m: np.ndarray, cosine: bool, longest: float | None) -> np.ndarray:
    """Rows as unit vectors whose angles order the scores.

    Cosine: the rows over their lengths (a zero row stays zero). Inner product: items get one more number that
    fills them up to the length of the longest one, queries get a zero; then ``q . x = |q| longest cos``.
    """
    if cosine:
        return _unit_rows(m)
    if longest is None:
        return _unit_rows(np.column_stack([m, np.zeros(len(m))]))
    rest = np.sqrt(np.maximum(longest**2 - (m * m).sum(axis=1), 0.0))
    return np.column_stack([m, rest]) / max(longest, EPS)


@dataclass(frozen=True)
class Geometry:
    """How vectors become directions, and the pivots whose nearest one is a vector's cell."""

    dim: int
    cosine: bool
    longest: float
    pivots: np.ndarray  # at most MAX_PIVOTS rows

    def items(self, m: np.ndarray) -> np.ndarray:
        return _directions(m, self.cosine, self.longest)

    def queries(self, m: np.ndarray) -> np.ndarray:
        return _directions(m, self.cosine, None)


def _geometry(items: DataFrame, n_items: int, dim: int, cosine: bool, item_block: int) -> Geometry:
    longest = 0.0
    if not cosine:
        squares = F.aggregate(F.col("vector").cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x)
        longest = float(items.agg(F.sqrt(F.max(squares))).first()[0] or 0.0)
    wanted = min(math.ceil(n_items / item_block), MAX_PIVOTS)
    pivots = np.zeros((0, dim))
    if wanted >= PRUNE_FROM:
        some = items.orderBy(F.xxhash64("item_id"), "item_id").limit(wanted).collect()
        pivots = np.array([r["vector"] for r in some], np.float64).reshape(len(some), dim)
    found = Geometry(dim, cosine, longest, pivots)
    return replace(found, pivots=found.items(pivots)) if len(pivots) else found


def _in_blocks(df: DataFrame, id_col: str, geometry: Geometry, size: int, is_item: bool, n: int, tiles: int) -> DataFrame:
    """``(id, tile, block, v)``: vectors in blocks of about ``size`` near each other, whole blocks in tiles."""
    placed = df.select(F.col(id_col).cast("string").alias("id"), F.col("vector").alias("v"))
    if not len(geometry.pivots):
        block = _bucket(F.col("id"), math.ceil(n / size)).cast("long")
        return placed.select("id", T.tile_of(F.col("id"), tiles).alias("tile"), block.alias("block"), "v")

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = T.matrix(batch.column("v"), geometry.dim).astype(np.float64)
            unit = geometry.items(m) if is_item else geometry.queries(m)
            cell = np.argmax(unit @ geometry.pivots.T, axis=1) if len(m) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], ["id", "v", "cell"])

    kind = df.schema["vector"].dataType.simpleString()
    placed = materialize(placed.mapInArrow(nearest, f"id string, v {kind}, cell int"), "placed")
    # One row per cell. A crowded cell is cut into more blocks, which are dealt to the tiles in turn.
    cells = placed.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(size)).alias("_n"))
    bucket = _bucket(F.col("id"), F.col("_n"))
    block = F.col("cell").cast("long") * (1 << 32) + bucket
    tile = F.pmod(F.col("cell") + bucket, F.lit(tiles)).cast("int")
    return placed.join(F.broadcast(cells), "cell").select("id", tile.alias("tile"), block.alias("block"), "v")


@dataclass(frozen=True)
class _Described:
    """Center of each item block of a cell, and cosine and sine of the largest angle to it."""

    centers: np.ndarray
    cos: np.ndarray
    sin: np.ndarray

    @staticmethod
    def of(m: T.Side, geometry: Geometry) -> _Described:
        centers, cos = [], []
        for a, b in m.spans():
            unit = geometry.items(m.exact(slice(a, b)))
            center = _unit_rows(unit.mean(axis=0, keepdims=True))[0]
            # A zero vector has no direction: it scores 0 with every query, so it is no nearer than a right angle.
            centers.append(center)
            cos.append(float(np.clip(unit @ center, -1.0, 1.0).min()))
        held = np.array(cos)
        return _Described(np.array(centers), held, np.sqrt(1 - held * held))

    def ceilings(self, q: np.ndarray, geometry: Geometry) -> np.ndarray:
        """Upper bound of the score of each query with any item of each block."""
        near = np.clip(geometry.queries(q) @ self.centers.T, -1.0, 1.0)
        best = np.where(near >= self.cos, 1.0, near * self.cos + np.sqrt(1 - near * near) * self.sin)
        if not geometry.cosine:
            best = best * (np.linalg.norm(q, axis=1) * geometry.longest)[:, None]
        return np.where(np.isfinite(best), best, np.inf)


def _cell_search(k: int, drop_seen: bool, geometry: Geometry):
    """Arrow function over one cell: the first k of each query, and a row of the block pairs met and scored."""
    pruned = len(geometry.pivots) > 0

    def one_block(scorer: T.Scorer, a: int, b: int, described: _Described, spans: list[tuple[int, int]]) -> int:
        sizes = np.array([y - x for x, y in spans])
        rows_of = lambda blocks: np.concatenate([np.arange(*spans[c]) for c in blocks])
        q = scorer.q.exact(slice(a, b))
        middle = _unit_rows(geometry.queries(q).mean(axis=0, keepdims=True))[0]
        near = np.argsort(-(described.centers @ middle), kind="stable")
        first = near[: np.searchsorted(np.cumsum(sizes[near]), k) + 1]
        scorer.scan(rows_of(first))
        scorer.best.settle()
        # The k-th score so far is a floor: blocks that can't pass it for any query are skipped.
        top = described.ceilings(q, geometry)
        keep = (top + SLACK * np.maximum(1.0, np.abs(top)) >= scorer.best.kth[:, None]).any(axis=0)
        keep[first] = False
        rest = near[keep[near]]
        if len(rest):
            scorer.scan(rows_of(rest))
        return len(first) + len(rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = lambda column: T.matrix(column, geometry.dim)
        cell = T.read_cell(batches, of, of)
        if cell is None:
            return
        q, m, pairs = cell
        seen = (T.places(q, pairs.column("id")), T.places(m, pairs.column("other"))) if len(pairs) else (np.zeros(0, np.int64),) * 2
        both = (seen[0] >= 0) & (seen[1] >= 0)
        seen = (seen[0][both], seen[1][both])
        scorer = T.Scorer(q, m, k, geometry.cosine, 9, seen)
        spans = m.spans() if pruned else []
        described = _Described.of(m, geometry) if pruned else None
        every = np.arange(len(m))
        scored = 0
        for a, b in q.spans() if pruned else [(a, min(a + T.ROWS, len(q))) for a in range(0, len(q), T.ROWS)]:
            scorer.open(a, b)
            if not drop_seen and len(scorer.gone_at):
                scorer.best.add(scorer.gone_row, scorer.gone_at, np.full(len(scorer.gone_at), -1.0))
            if pruned:
                scored += one_block(scorer, a, b, described, spans)
            else:
                scorer.scan(every)
            hits = scorer.close(a)
            none = pa.nulls(hits.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*hits.columns, none, none], [*hits.schema.names, "pairs", "scored"])
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), pa.nulls(1, pa.float64()), pa.array([len(q.spans()) * len(spans)]), pa.array([scored])],
            ["query_id", "item_id", "score", "pairs", "scored"],
        )

    return run


def block_search(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    seen: DataFrame | None = None,
    drop_seen: bool = False,
    cosine: bool = True,
    item_block: int | None = None,
    query_block: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Exact top k by blocks: hits, and a row (pairs, scored) of block pairs there are and that were scored.

    Queries and items meet on a grid of tiles (``tiles``). Blocks hold vectors near each other. In a cell each query
    block is scored against the nearest item blocks first; the k-th score found is a floor, and blocks whose center
    and radius rule out a better score for all its queries are skipped, which changes no result. Few blocks are all scored.
    """
    item_block, query_block = item_block or ITEM_BLOCK, query_block or QUERY_BLOCK
    spark = queries.sparkSession
    # Both sides are counted and then scored: written once, not computed twice.
    queries = materialize(queries.select("query_id", "vector"), "queries")
    items = materialize(items.select("item_id", "vector"), "items")
    size = items.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dim")).first()
    n_items, dim = size["n"], size["dim"]
    if not n_items:
        none = "query_id string, item_id string, score double, rank int"
        return spark.createDataFrame([], none), spark.createDataFrame([(0, 0)], "pairs long, scored long")
    n_queries = max(1, queries.count())
    geometry = _geometry(items, n_items, dim, cosine, item_block)
    small = n_items * (dim * 8 + 64) <= BROADCAST_BYTES
    cells = T.cells_for(n_queries, n_items, dim, MIN_JOIN_KEYS) if small else MIN_JOIN_KEYS
    grid = T.grid_of(n_queries, n_items, dim, k, cells)
    of_item = _in_blocks(items, "item_id", geometry, item_block, True, n_items, grid.down)
    of_query = _in_blocks(queries, "query_id", geometry, query_block, False, n_queries, grid.across)
    pairs = None
    if seen is not None:
        pairs = seen.select(F.col("query_id").cast("string").alias("id"), F.col("item_id").cast("string").alias("other")).distinct()
        if len(geometry.pivots):
            met, where = of_query.select("id", F.col("tile").alias("q_tile")), of_item.select(F.col("id").alias("other"), F.col("tile").alias("i_tile"))
            pairs = pairs.join(met, "id").join(where, "other").distinct()
        else:
            pairs = pairs.withColumns({"q_tile": T.tile_of(F.col("id"), grid.across), "i_tile": T.tile_of(F.col("other"), grid.down)})
    laid = T.lay(grid, of_query, of_item, pairs)
    found = laid.mapInArrow(_cell_search(k, drop_seen, geometry), f"{T.HITS}, pairs long, scored long")
    hits = found.where(F.col("scored").isNull()).select("query_id", "item_id", "score")
    best = top_k_per_group(hits, ["query_id"], [F.desc("score"), F.asc("item_id")], k)
    if not len(geometry.pivots):
        # A handful of blocks: all of them.
        n_blocks = math.ceil(n_items / item_block)
        share = of_query.agg((F.count_distinct("block") * n_blocks).alias("pairs")).withColumn("scored", F.col("pairs"))
    else:
        share = found.where(F.col("scored").isNotNull()).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pairs", "scored")])
    return best, share


def retrieve_top_k(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    seen: DataFrame | None = None,
    seen_mode: str = "sentinel",
    metric: str = "cosine",
) -> DataFrame:
    """The ``k`` best items per query vector: rows ``(query_id, item_id, score, rank)``.

    ``queries`` is (query_id, vector), ``items`` (item_id, vector). Pairs in ``seen``
    (query_id, item_id) score -1 ("sentinel") or leave the result ("drop").
    """
    if metric not in ("cosine", "dot"):
        raise ValueError(f"unsupported metric {metric!r}; use 'cosine' or 'dot'")
    if seen_mode not in ("sentinel", "drop"):
        raise ValueError(f"unsupported seen mode {seen_mode!r}; use 'sentinel' or 'drop'")
    return block_search(queries, items, k, seen, seen_mode == "drop", metric == "cosine")[0]


def vector_search(queries: DataFrame, items: DataFrame, limit: int = 10) -> DataFrame:
    return retrieve_top_k(queries, items, limit)


def seen_items(interactions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Distinct (user, item) pairs whose item is in the catalog."""
    return (
        interactions.select("user_id", "item_id")
        .distinct()
        .join(catalog.select("item_id"), "item_id", "left_semi")
        .select("user_id", "item_id")
    )


def enrich_with_catalog(recs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add title and category; ids missing from the catalog are dropped."""
    return recs.join(catalog.select("item_id", "title", "category"), "item_id")


def batch_recommend(
    requests: DataFrame, user_vectors: DataFrame, item_vectors: DataFrame, top_n: int = 10
) -> DataFrame:
    """Ranked items per requested user, seen items included; unknown users come back flagged."""
    asked = requests.select("user_id").distinct()
    known = user_vectors.join(asked, "user_id", "left_semi")
    hits = retrieve_top_k(known.withColumnRenamed("user_id", "query_id"), item_vectors, top_n)
    known_ids = known.select("user_id", F.lit(True).alias("_k"))
    return (
        asked.join(known_ids, "user_id", "left")
        .join(hits.withColumnRenamed("query_id", "user_id"), "user_id", "left")
        .select(
            "user_id", F.coalesce("_k", F.lit(False)).alias("known_user"), "rank", "item_id", "score"
        )
    )


def upsert_vectors(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Last version per point id; both sides are (point_id, item_id, vector, version).

    Only the newest row per id is carried through the aggregation, so replaying a change set, or
    one point with very many versions, costs nothing extra.
    """
    both = current.unionByName(changes)
    newest = F.max_by(F.struct("item_id", "vector", "version"), F.col("version"))
    return both.groupBy("point_id").agg(newest.alias("r")).select("point_id", "r.*")
