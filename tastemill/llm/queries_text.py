"""Queries of decontamination, SentencePiece encoding and embedding near-duplicates."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tastemill.llm import decontaminate, nndescent, sentencepiece
from tastemill.llm.registry import query, table

PIECES = "piece_bpe_32k.model"


@query("op1_benchmark_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_sentencepiece_lattice")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sentencepiece.encode_documents(docs, public_tokenizers.path(PIECES), with_ids=False)


@query("op7_embedding_near_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.near_duplicates(table(spark, sf_dir, "embeddings"))
