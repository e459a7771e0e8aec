"""Corpus cleaning as stages over Parquet: each stage reads what the former one kept.

Quality ranking, n-gram Jaccard join, suffix-array dedup, benchmark decontamination, and
SentencePiece encoding. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm import decontaminate, ngram_join, quality, sentencepiece, suffix
from tastemill.llm.common import partitions, store, tidy
from tastemill.llm.queries_text import PIECES
from tastemill.llm.registry import table
from tastemill.llm.repeats import covered
from tastemill.session import configure

#: Least quality score of a document that stays.
LEAST_SCORE = 0.3
#: Word n-grams and similarity (num / den) of near duplicates.
NEAR = ngram_join.Rule(n=5, num=80, den=100)


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _row(docs: DataFrame):
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")))


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that the documents don't have."""
    while name in docs.columns:
        name += "_"
    return name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches LEAST_SCORE; empty texts are not worth keeping either."""
    configure(spark)
    ranker = quality.train_ranker(docs, table(spark, sf_dir, "labels"), F.lit(True))
    score = _fresh(docs, "_score")
    scored = quality.score_quality(docs, ranker, score)
    return scored.where((F.col(score) >= LEAST_SCORE) & (F.length("text") > 0)).select(*_columns(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    configure(spark)
    found = ngram_join.join_classes(docs, NEAR)
    drop = store(found.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct(), "near-drop")
    kept = docs.join(drop, "doc_id", "left_anti")
    # Rows that repeat a doc_id with the same text are copies as well.
    again = kept.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 AND doc_id IS NOT NULL").select("doc_id")
    again = store(again, "near-again")
    twice = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, "doc_id", "left_anti").unionAll(twice).select(*_columns(docs))


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur elsewhere; documents of which nothing is left go."""
    configure(spark)
    key, spans = _fresh(docs, "_row"), _fresh(docs, "_ranges")
    rows = docs.withColumn(key, _row(docs))
    found = suffix.repeated_bytes(rows.select(F.col(key).alias("_row"), "doc_id", "text"))
    per_row = found.select(F.col("_row").alias(key), F.col("ranges").alias(spans))
    n = partitions(spark)
    joined = rows.repartition(n, key).join(per_row, key, "left").drop(key)
    schema = docs.schema
    index = docs.columns.index("text")
    count = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for k, blob in enumerate(batch.column(spans).to_pylist()):
                if blob and texts[k]:
                    data, parts, last = texts[k].encode(), [], 0
                    for a, b in zip(*(x.tolist() for x in covered(blob, suffix.WIDTH))):
                        parts.append(data[last:a])
                        last = b
                    texts[k] = b"".join([*parts, data[last:]]).decode("utf-8", "ignore")
            columns = batch.drop_columns([spans]).columns
            columns[index] = pa.array(texts, pa.string())
            if count is not None:
                columns[count] = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, batch.drop_columns([spans]).schema.names)

    cut = joined.select(*_columns(docs), spans).mapInArrow(tidy(run), schema)
    return cut.where(F.length(F.btrim("text", F.lit(" \t\r\n\f\v"))) > 0)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    configure(spark)
    found = store(decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct(), "leaked")
    return docs.join(found, "doc_id", "left_anti").select(*_columns(docs))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document that is left: their number, the crc32 of the ids, and the round trip."""
    configure(spark)
    model = public_tokenizers.path(PIECES)
    return sentencepiece.encode_documents(docs, model)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("suffix_dedup", suffix_stage),
    ("decontamination", benchmark_stage),
    ("sentencepiece", encode_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
