"""Approximate nearest items from a stored inverted index with product-quantised residuals.

``build_index`` fits centers and codebooks once on a bounded sample, then files every item: its nearest center
(cell) and one byte for each few numbers of what is left (code). A search reads the codes of the cells nearest to a
query, takes the best candidates by the decoded vectors, and decides by the exact cosine of those candidates
alone. How many cells and candidates that takes is measured when the index is built: a sample of items is
searched exactly, and the smallest numbers that find the wanted share of the true neighbours are stored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.functions.vectors import l2_normalize
from tastemill.operators import retrieval, tiles
from tastemill.operators.code_scan import merged, near_lists, score_lists, tiles_of_codes
from tastemill.operators.ordering import top_k_per_group, with_global_index
from tastemill.session import materialize, scratch_path, shuffled

#: Centers are held by all tasks: at most this many, whatever the number of items.
MAX_CELLS = 4096
BLOCK = 4096
#: Candidates per wanted item that the audit may choose from.
GRID = (1.5, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64)


@dataclass(frozen=True)
class IndexSettings:
    """``sample_rows`` items fit the centers and codebooks; ``audit_rows`` items measure the recall of ``k``."""

    sample_rows: int = 20_000
    audit_rows: int = 200
    cells: int | None = None
    width: int = 4
    codes: int = 256
    k: int = 10
    target: float = 0.97
    seed: int = 42
    n: int = 0
    dim: int = 0
    n_probe: int = 0
    candidates: int = 0
    recall: float = 0.0


def _lloyd(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """k centers of the rows of ``x`` (a part of the sample); empty ones take the row that fits worst."""
    rng = np.random.default_rng(seed)
    centers = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        d = (centers * centers).sum(axis=1)[None, :] - 2 * x @ centers.T
        own = d.argmin(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, x)
        counts = np.bincount(own, minlength=len(centers))
        filled = counts > 0
        centers[filled] = sums[filled] / counts[filled, None]
        worst = np.argsort(-d[np.arange(len(x)), own], kind="stable")[: (~filled).sum()]
        centers[~filled] = x[worst]
    return centers


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers * centers).sum(axis=1)[None, :] - 2 * x @ centers.T).argmin(axis=1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


@dataclass(frozen=True)
class Quantizer:
    """Centers (cells, dim) and codebooks (parts, codes, width) of the residuals; the last part may be padded."""

    centers: np.ndarray
    books: np.ndarray

    def residual_parts(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        parts, _, width = self.books.shape
        rest = np.zeros((len(x), parts * width))
        rest[:, : x.shape[1]] = x - self.centers[cell]
        return rest.reshape(len(x), parts, width)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = _nearest(x, self.centers)
        rest = self.residual_parts(x, cell)
        codes = np.stack([_nearest(rest[:, p], self.books[p]) for p in range(rest.shape[1])], axis=1)
        return cell, codes.astype(np.uint8)

    def decode(self, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        rest = np.stack([self.books[p][codes[:, p]] for p in range(len(self.books))], axis=1)
        return self.centers[cell] + rest.reshape(len(codes), -1)[:, : self.centers.shape[1]]

    def cell_order(self, q: np.ndarray) -> np.ndarray:
        """Cells of each query from the nearest to the farthest."""
        return np.argsort((self.centers * self.centers).sum(axis=1)[None, :] - 2 * q @ self.centers.T, axis=1, kind="stable")


def _fit(sample: DataFrame, cells: int, dim: int, s: IndexSettings) -> Quantizer:
    model = KMeans(k=cells, seed=s.seed, maxIter=10, featuresCol="_f").fit(sample.withColumn("_f", array_to_vector("v")))
    centers = np.array(model.clusterCenters())
    parts = math.ceil(dim / s.width)
    blank = Quantizer(centers, np.zeros((parts, 1, s.width)))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            rest = blank.residual_parts(x, _nearest(x, centers))
            for p in range(parts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), p), pa.int32()), pa.array(rest[:, p].tolist(), pa.list_(pa.float64()))], ["part", "x"]
                )

    def book(pdf: pd.DataFrame) -> pd.DataFrame:
        found = _lloyd(np.stack(pdf["x"].to_list()), s.codes, s.seed)
        return pd.DataFrame({"part": int(pdf["part"].iloc[0]), "book": [found.tolist()]})

    split_rows = sample.select("v").mapInArrow(split, "part int, x array<double>")
    books = split_rows.groupBy("part").applyInPandas(book, "part int, book array<array<double>>").collect()
    out = np.zeros((parts, s.codes, s.width))
    for r in books:
        found = np.array(r["book"])
        out[r["part"], : len(found)] = found
        out[r["part"], len(found) :] = found[0]  # fewer rows than codes: never chosen before the first
    return Quantizer(centers, out)


class VectorIndex:
    """A stored index: ``codes`` (cell, block, nums, codes), ``vectors`` (num, item_id, v) and the quantizer.

    Items are numbered in the order of their ids; rows of one id share its number.
    """

    def __init__(self, spark: SparkSession, path: str, quantizer: Quantizer, settings: IndexSettings) -> None:
        self.spark, self.path, self.quantizer, self.settings = spark, path, quantizer, settings
        self.codes = spark.read.schema("cell int, block int, nums array<long>, codes array<binary>").parquet(f"{path}/codes")
        self.vectors = spark.read.schema("num long, item_id string, v array<float>").parquet(f"{path}/vectors")

    def share_read(self, k: int | None = None) -> float:
        """Share of the stored vectors that one query reads."""
        return min(1.0, self._candidates(k or self.settings.k) / max(1, self.settings.n))

    def _candidates(self, k: int) -> int:
        return max(k, self.settings.candidates * math.ceil(k / self.settings.k))

    def _laid(self, queries: DataFrame, items: DataFrame, k: int) -> DataFrame:
        """``(id, block, v)`` of both sides on a grid of tiles."""
        n_queries, n, dim = max(1, queries.count()), self.settings.n, self.settings.dim
        grid = tiles.grid_of(n_queries, n, dim, k, tiles.cells_for(n_queries, n, dim, retrieval.MIN_JOIN_KEYS))
        asked = queries.withColumn("tile", tiles.tile_of(F.col("id"), grid.across))
        return tiles.lay(grid, asked, items.withColumn("tile", tiles.tile_of(F.col("id"), grid.down)))

    def _probed(self, k: int, n_probe: int) -> Callable:
        """Arrow function over one cell of the grid: each query's best ``k`` items among its ``n_probe`` cells."""
        quantizer, dim = self.quantizer, self.settings.dim
        n_cells = len(quantizer.centers)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tile = tiles.read_cell(batches, lambda column: _matrix(column, dim), lambda column: _matrix(column, dim))
            if tile is None:
                return
            q, m, _ = tile
            none = np.zeros(0, np.int64)
            scorer = tiles.Scorer(q, m, k, True, 9, (none, none))
            spans = {int(m.block[x]): np.arange(x, y) for x, y in m.spans()}
            # Queries near each other stand together, so that what none of them probes is left out.
            for a in range(0, len(q), tiles.ROWS):
                b = min(a + tiles.ROWS, len(q))
                scorer.open(a, b)
                order = quantizer.cell_order(scorer.exact_q)[:, :n_probe]
                allowed = np.zeros((b - a, n_cells), bool)
                np.put_along_axis(allowed, order, True, axis=1)
                met = [spans[c] for c in np.flatnonzero(allowed.any(axis=0)) if c in spans]
                if met:
                    at = np.concatenate(met)
                    if n_probe == n_cells:
                        scorer.scan(at)
                    else:
                        for c in range(0, len(at), tiles.COLUMNS):
                            part = at[c : c + tiles.COLUMNS]
                            scorer.scan(part, allowed[:, m.block[part]])
                yield scorer.close(a)

        return run

    def _lists(self, queries: DataFrame, n_probe: int, most: int) -> tuple[DataFrame, int]:
        """``(query_id, v, nums, near)`` of ``(query_id, v)``, the best ``most`` items by decoded vectors of ``n_probe`` cells; and the number of queries."""
        n_probe = min(n_probe, len(self.quantizer.centers))
        size = queries.agg(F.count("*").alias("n"), F.count_distinct("query_id").alias("ids"), F.count("query_id").alias("named")).first()
        n = max(1, size["n"])
        cells = tiles.cells_for(n, self.settings.n, self.settings.dim, retrieval.MIN_JOIN_KEYS)
        asked = self._asked(queries).select(F.col("id").alias("query_id"), F.col("block").cast("int").alias("cell"), "v")
        lists = near_lists(asked, n, self.codes, self.settings.n, self.quantizer, n_probe, most, cells)
        if tiles_of_codes(self.settings.n, self.quantizer) > 1 or size["ids"] < size["named"]:
            best = merged(lists, most)
            lists = shuffled(queries.select("query_id", F.col("v").cast("array<double>").alias("v"))).join(best, "query_id")
        return lists.withColumn("nums", F.col("near.num")), n

    def candidates(self, queries: DataFrame, n_probe: int, most: int) -> DataFrame:
        """(query_id, item_id, near, rank): best ``most`` items per query by decoded vectors of ``n_probe`` cells.

        ``queries`` is (query_id, v) with distinct ids.
        """
        names = self.vectors.select("num", "item_id").distinct()
        lists = self._lists(queries, n_probe, most)[0].select("query_id", F.posexplode("near").alias("p", "x"))
        found = lists.select("query_id", F.col("x.num").alias("num"), F.col("x.near").alias("near"), (F.col("p") + 1).alias("rank"))
        return shuffled(found).join(names, "num").select("query_id", "item_id", "near", "rank")

    def _asked(self, queries: DataFrame) -> DataFrame:
        """``(id, block, v)`` of ``(query_id, v)`` with unit vectors; the block is the nearest cell."""
        quantizer, dim = self.quantizer, self.settings.dim

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell = _nearest(_matrix(batch.column("v"), dim), quantizer.centers)
                yield pa.RecordBatch.from_arrays([batch.column("query_id"), pa.array(cell, pa.int64()), batch.column("v")], ["id", "block", "v"])

        kind = queries.schema["v"].dataType.simpleString()
        return queries.select("query_id", "v").mapInArrow(nearest, f"id string, block long, v {kind}")

    def search(self, queries: DataFrame, k: int = 10, n_probe: int | None = None, candidates: int | None = None) -> DataFrame:
        """``(query_id, item_id, score, rank)`` for ``(query_id, vector)``; the measured settings by default.

        Where every stored item may be a candidate the decoded vectors decide nothing: the probed cells are scored exactly at once.
        """
        n_probe = min(n_probe or self.settings.n_probe, len(self.quantizer.centers))
        most = candidates or self._candidates(k)
        exact = queries.select(F.col("query_id").cast("string").alias("query_id"), F.col("vector").cast("array<double>").alias("v"))
        if most >= self.settings.n:
            rows = self.codes.select(F.explode("nums").alias("num"), F.col("cell").cast("long").alias("block"))
            held = self.vectors.where("item_id IS NOT NULL").join(rows, "num").select(F.col("item_id").alias("id"), "block", "v")
            run = self._probed(k, n_probe)
            exact = exact.join(exact.select("query_id"), "query_id")  # an id that comes twice is asked twice for each
            scored = self._laid(self._asked(exact), held, k).mapInArrow(run, tiles.HITS)
        else:
            lists, n_queries = self._lists(materialize(exact.where("query_id IS NOT NULL"), "index-queries"), n_probe, most)
            lists = materialize(lists.select("query_id", "v", "nums"), "candidates")
            n, dim = self.settings.n, self.settings.dim
            grid = tiles.grid_of(n_queries, n, dim, k, tiles.cells_for(n_queries, most, dim, retrieval.MIN_JOIN_KEYS))
            scored = score_lists(lists, self.vectors, grid, k)
        return top_k_per_group(scored, ["query_id"], [F.desc("score"), F.asc("item_id")], k)

    def _save(self) -> None:
        held = json.dumps({"settings": asdict(self.settings), "centers": self.quantizer.centers.tolist(), "books": self.quantizer.books.tolist()})
        self.spark.createDataFrame([(held,)], "held string").write.parquet(f"{self.path}/quantizer")


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    held = json.loads(spark.read.parquet(f"{path}/quantizer").first()["held"])
    return VectorIndex(spark, path, Quantizer(np.array(held["centers"]), np.array(held["books"])), IndexSettings(**held["settings"]))


def build_index(items: DataFrame, path: str | None = None, settings: IndexSettings = IndexSettings()) -> VectorIndex:
    """File ``(item_id, vector)`` under ``path`` (by default in the shared scratch folder)."""
    spark = items.sparkSession
    path = path or scratch_path(spark, "vector-index")
    s = settings
    named = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("vector").cast("array<float>").alias("v"))
    named = materialize(named, "items")
    numbers = with_global_index(named.select("item_id").distinct(), ["item_id"], "num").select(F.col("item_id").alias("_id"), "num")
    numbered = shuffled(named).join(numbers, F.col("item_id").eqNullSafe(F.col("_id"))).select("num", "item_id", "v")
    numbered.write.parquet(f"{path}/vectors")
    vectors = spark.read.schema("num long, item_id string, v array<float>").parquet(f"{path}/vectors")
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    if not size["n"]:
        raise ValueError("an index needs at least one vector")
    s = replace(s, n=size["n"], dim=size["dim"])
    unit = vectors.select("num", "item_id", l2_normalize(F.col("v")).cast("array<float>").alias("v"))
    sample = materialize(unit.orderBy(F.xxhash64("item_id"), "item_id").limit(s.sample_rows), "index-sample")
    cells = max(1, min(s.cells or math.ceil(math.sqrt(s.n)), MAX_CELLS, s.n, s.sample_rows))
    quantizer = _fit(sample, cells, s.dim, s)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, codes = quantizer.encode(_matrix(batch.column("v"), s.dim))
            yield pa.RecordBatch.from_arrays(
                [batch.column("num"), batch.column("item_id"), pa.array(cell, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary())],
                ["num", "item_id", "cell", "code"],
            )

    filed = materialize(unit.mapInArrow(file, "num long, item_id string, cell int, code binary"), "filed")
    blocks = filed.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("n_blocks"))  # a row per cell
    placed = filed.join(F.broadcast(blocks), "cell").withColumn("block", F.pmod(F.xxhash64("item_id"), F.col("n_blocks")).cast("int"))
    rows = placed.groupBy("cell", "block").agg(F.array_sort(F.collect_list(F.struct("num", "code"))).alias("rows"))
    rows.select("cell", "block", F.col("rows.num").alias("nums"), F.col("rows.code").alias("codes")).write.parquet(f"{path}/codes")
    index = VectorIndex(spark, path, quantizer, s)
    index.settings = _audited(index, vectors, unit, filed)
    index._save()
    return index


def _audited(index: VectorIndex, vectors: DataFrame, unit: DataFrame, filed: DataFrame) -> IndexSettings:
    """The fewest cells and candidates that find ``target`` of the true neighbours of ``audit_rows`` items."""
    s, quantizer = index.settings, index.quantizer
    asked = unit.select("item_id", "v").orderBy(F.xxhash64(F.lit(s.seed), "item_id"), "item_id").limit(s.audit_rows)
    asked = materialize(asked.withColumnRenamed("item_id", "query_id"), "audit")
    items = vectors.select("item_id", F.col("v").alias("vector"))
    exact = retrieval.retrieve_top_k(asked.withColumnRenamed("v", "vector"), items, s.k + 1)
    truth = exact.where("query_id != item_id").where(F.col("rank") <= s.k + 1)
    truth = F.broadcast(truth).join(filed.select("item_id", "cell"), "item_id").select("query_id", "item_id", "cell")
    most = math.ceil(GRID[-1] * s.k)
    near = index.candidates(asked, len(quantizer.centers), most).select("query_id", "item_id", F.col("rank").alias("place"))
    found = truth.join(shuffled(near), ["query_id", "item_id"], "left").collect()  # audit_rows * k rows at most
    places = {r["query_id"]: np.array(r["v"]) for r in asked.collect()}
    names = list(places)
    order = quantizer.cell_order(np.stack([places[n] for n in names])).argsort(axis=1)
    at = {n: i for i, n in enumerate(names)}
    cell_at = np.array([order[at[r["query_id"]], r["cell"]] for r in found], np.int64)
    place = np.array([r["place"] or most + 1 for r in found], np.int64)
    if not len(found):
        return replace(s, n_probe=len(quantizer.centers), candidates=most, recall=1.0)
    # Half of what may be lost is given to the cells, the rest to the candidates.
    share = (1 + s.target) / 2
    n_probe = int(np.sort(cell_at)[min(len(found) - 1, math.ceil(share * len(found)) - 1)]) + 1
    inside = cell_at < n_probe
    candidates = next((c for g in GRID if (inside & (place <= (c := math.ceil(g * s.k)))).mean() >= s.target), most)
    return replace(s, n_probe=n_probe, candidates=candidates, recall=float((inside & (place <= candidates)).mean()))


def approx_vector_search(
    queries: DataFrame, items: DataFrame, limit: int = 10, n_cells: int | None = None, n_probe: int | None = None,
    candidates: int | None = None, index: VectorIndex | None = None, seed: int = 42,
) -> DataFrame:
    """Approximate search with a stored ``index``, or one that is built for this call.

    With all cells probed and all items as candidates it is the exact search.
    """
    index = index or build_index(items, settings=IndexSettings(cells=n_cells, seed=seed))
    return index.search(queries, limit, n_probe, candidates)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: n_queries, recall of the exact (query_id, item_id) pairs."""
    hit = found.select("query_id", "item_id", F.lit(1).alias("hit"))
    both = exact.select("query_id", "item_id").join(hit, ["query_id", "item_id"], "left")
    return both.agg(F.countDistinct("query_id").alias("n_queries"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
