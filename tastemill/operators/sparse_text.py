"""Sparse TF-IDF vectors over an exact numbered vocabulary, and their exact search on a grid of tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.functions.text import ITEM_TEXT_FIELDS, item_text, strip_accents
from tastemill.operators.ordering import top_k_per_group, with_global_index
from tastemill.operators.tiles import cells_for, grid_of, tile_of
from tastemill.session import materialize, scratch_path, spread

_VOCABULARY = "word string, df long, idf double, word_idx long"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(strip_accents(text), F.lit("[a-z0-9]+"), F.lit(0))


class SparseText:
    """A stored vocabulary: each word of the fitted texts has a number and a weight of its own.

    Vectors are long tables ``(id, word_idx, weight)`` of unit length. Words outside the vocabulary, and words that all
    texts have, weigh nothing; a text without any other word has no vector.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.vocabulary = spark.read.schema(_VOCABULARY).parquet(path)

    @classmethod
    def fit(cls, texts: DataFrame, path: str | None = None) -> SparseText:
        """Number the words of ``(id, text)``; a word's weight is ``ln((texts + 1) / (texts with it + 1))``."""
        spark = texts.sparkSession
        path = path or scratch_path(spark, "vocabulary")
        texts = materialize(spread(texts.select("id", "text")), "texts")
        n = texts.count()
        words = texts.select("id", F.explode(F.array_distinct(words_of(F.col("text")))).alias("word"))
        counted = words.groupBy("word").agg(F.count("*").alias("df"))
        numbered = with_global_index(counted, ["word"], "word_idx")
        idf = F.log((F.lit(n) + 1) / (F.col("df") + 1))
        numbered.select("word", "df", idf.alias("idf"), "word_idx").write.parquet(path)
        return cls(spark, path)

    def encode(self, texts: DataFrame) -> DataFrame:
        """``(id, word_idx, weight)`` of ``(id, text)``; rows of one id count as one text."""
        counted = texts.select("id", F.explode(words_of(F.col("text"))).alias("word")).groupBy("id", "word").agg(F.count("*").alias("n"))
        weighed = counted.join(self.vocabulary.where("idf > 0"), "word")
        # A text holds no more distinct words than it has characters.
        entries = F.array_sort(F.collect_list(F.struct("word_idx", (F.col("n") * F.col("idf")).alias("w"))))
        rows = weighed.groupBy("id").agg(entries.alias("e"))
        length = F.sqrt(F.aggregate("e", F.lit(0.0), lambda s, x: s + x["w"] * x["w"]))
        rows = rows.select("id", length.alias("length"), F.explode("e").alias("x"))
        return rows.select("id", "x.word_idx", (F.col("x.w") / F.col("length")).alias("weight"))

    def search(self, queries: DataFrame, items: DataFrame, k: int) -> DataFrame:
        """``(query_id, item_id, score, rank)``: the ``k`` items of greatest positive cosine.

        ``queries`` and ``items`` are vectors by ``query_id`` and ``item_id``. A tile of queries and a tile of items meet in one
        task, which adds up products word by word and keeps the first ``k`` of each query, so pairs are not shuffled.
        """
        asked = materialize(_by_id(queries, "query_id"), "queries")
        held = materialize(_by_id(items, "item_id"), "items")
        (n_q, _), (n_i, entries) = (df.agg(F.count("*"), F.coalesce(F.sum(F.size("words")), F.lit(0))).first() for df in (asked, held))
        dim = 2 * max(1, round(entries / max(1, n_i)))  # a word's number and its weight
        grid = grid_of(n_q, n_i, dim, k, cells_for(n_q, n_i, dim, 3 * self.spark.sparkContext.defaultParallelism))
        down, across = F.lit(grid.down), F.lit(grid.across)

        def sent(df: DataFrame, kind: int, part: Column, copies: Column) -> DataFrame:
            rows = df.withColumn("_c", F.explode(F.sequence(F.lit(0), copies - 1)))
            ids = [F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in types.items()]
            return rows.select(part.alias("part"), F.lit(kind).alias("kind"), *ids, "words", "weights")

        types = {"query_id": asked.schema["query_id"].dataType, "item_id": held.schema["item_id"].dataType}
        rows = sent(held, 0, F.col("_c") * down + tile_of(F.col("item_id"), grid.down), across).unionByName(
            sent(asked, 1, tile_of(F.col("query_id"), grid.across) * down + F.col("_c"), down)
        )
        cells = rows.repartitionById(grid.across * grid.down, "part").sortWithinPartitions("kind", "item_id")
        near = cells.drop("part").mapInArrow(_nearest(k), ", ".join(f"{c} {t.simpleString()}" for c, t in types.items()) + ", score double")
        # Rounded, so that equal vectors tie and the id decides.
        found = near.withColumn("score", F.round("score", 9)).where("score > 0")
        return top_k_per_group(found, ["query_id"], [F.desc("score"), F.asc("item_id")], k)


def _by_id(vectors: DataFrame, name: str) -> DataFrame:
    """``(id, words, weights)``, one row for each id: as long as its text at most."""
    entries = F.array_sort(F.collect_list(F.struct("word_idx", "weight")))
    rows = vectors.where("word_idx IS NOT NULL AND weight IS NOT NULL").groupBy(name).agg(entries.alias("e"))
    return rows.select(name, F.col("e.word_idx").alias("words"), F.col("e.weight").alias("weights"))


class _Postings:
    """Items of one cell by word, in the order of their ids."""

    def __init__(self, parts: list[pa.RecordBatch]) -> None:
        self.ids = pa.concat_arrays([p.column("item_id") for p in parts])
        sizes = np.concatenate([np.diff(p.column("words").offsets.to_numpy()) for p in parts])
        words, weights = (np.concatenate([p.column(c).flatten().to_numpy() for p in parts]) for c in ("words", "weights"))
        order = np.argsort(words, kind="stable")
        self.item, self.weight = np.repeat(np.arange(len(self.ids)), sizes)[order], weights[order]
        words = words[order]
        self.word, self.start = np.unique(words, return_index=True)
        self.end = np.r_[self.start[1:], len(words)]

    def best(self, words: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of a query's first ``k`` items, by rounded score and then by place."""
        at = np.minimum(np.searchsorted(self.word, words), len(self.word) - 1)
        known = self.word[at] == words
        spans = [(slice(self.start[x], self.end[x]), w) for x, w in zip(at[known], weights[known])]
        if not spans:
            return np.zeros(0, np.int64), np.zeros(0)
        item = np.concatenate([self.item[x] for x, _ in spans])
        product = np.concatenate([self.weight[x] * w for x, w in spans])
        if len(item) * 8 > len(self.ids):
            score = np.bincount(item, product, len(self.ids))
            item = np.flatnonzero(score)
            score = score[item]
        else:
            item, where = np.unique(item, return_inverse=True)
            score = np.bincount(where, product)
        key = np.rint(score * 1e9)
        if len(key) > k:
            least = max(np.partition(key, len(key) - k)[len(key) - k], 1)
            above = np.flatnonzero(key > least)
            picked = np.r_[above, np.flatnonzero(key == least)[: k - len(above)]]
        else:
            picked = np.flatnonzero(key > 0)
        return item[picked], score[picked]


def _nearest(k: int):
    """Arrow function over one cell, items first: the ``k`` best items of each query, a batch of queries at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], None
        for batch in batches:
            first = int(np.searchsorted(batch.column("kind").to_numpy(), 1))
            if first:
                parts.append(batch.slice(0, first))
            asked = batch.slice(first)
            if not parts or not asked.num_rows:
                continue
            held = held or _Postings(parts)
            ends = asked.column("words").offsets.to_numpy()
            words, weights = (asked.column(c).flatten().to_numpy() for c in ("words", "weights"))
            ends = ends - ends[0]
            found = [held.best(words[a:b], weights[a:b], k) for a, b in zip(ends[:-1], ends[1:])]
            query = np.repeat(np.arange(len(found)), [len(at) for at, _ in found])
            item, score = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [asked.column("query_id").take(pa.array(query)), held.ids.take(pa.array(item)), pa.array(score, pa.float64())],
                ["query_id", "item_id", "score"],
            )

    return run


def catalog_texts(catalog: DataFrame) -> DataFrame:
    return catalog.select(F.col("item_id").alias("id"), item_text(ITEM_TEXT_FIELDS).alias("text"))


def embed_items_sparse(catalog: DataFrame, encoder: SparseText | None = None) -> DataFrame:
    """``(item_id, word_idx, weight)`` of every item's text; without an encoder one is fitted to the catalog."""
    texts = catalog_texts(catalog)
    encoder = encoder or SparseText.fit(texts)
    return encoder.encode(spread(texts)).withColumnRenamed("id", "item_id")
