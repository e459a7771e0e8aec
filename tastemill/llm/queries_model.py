"""Queries of the learned and tokenizing operators: token files, counts, language, quality."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm import counts as C
from tastemill.llm import langid, quality, tokenbin
from tastemill.llm.common import store
from tastemill.llm.registry import id_crc, query, table

BYTE_BPE = "byte_bpe_50k.json"


@query("op5_token_id_files")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tokens = tokenbin.write_tokens(docs, public_tokenizers.path(BYTE_BPE))
    return tokenbin.read_all(tokens).select("doc_id", "start", F.col("n").alias("n_tokens"), "ids_crc32")


@query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches: all documents with an estimate of four bytes a token, exact counts instead
    of the estimates, and every copy of a text but the first taken out. The second is sent twice."""
    versions = {"byte_bpe_50k/1": public_tokenizers.path(BYTE_BPE), "words/1": None}
    names = list(versions)
    counted = store(C.count_tokens(table(spark, sf_dir, "documents"), versions), "token-counts")
    guess = F.ceil(F.col("n_bytes") / 4)
    exact = C.signed(counted, names, -1, guess).unionAll(C.signed(counted, names, 1))
    rollup = C.Rollup(spark)
    rollup.commit("0001-load", C.signed(counted, names, 1, guess))
    rollup.commit("0002-exact", exact)
    rollup.commit("0002-exact", exact)
    first = C.first_copies(counted, names)
    rollup.commit("0003-copies", C.signed(counted, names, -1).unionAll(C.signed(first, names, 1)))
    return rollup.totals()


@query("op9_language_spans")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(id_crc(), F.lit(4)) == 2
    model = langid.fit_language_model(docs, ~held_out)
    found = langid.label_languages(docs, model)
    held = F.coalesce(held_out, F.lit(False)).alias("held_out")
    return found.select("doc_id", held, "lang_pred", "score", F.size("spans").alias("n_spans"))


@query("op10_quality_rank")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.pmod(id_crc(), F.lit(5)) == 0
    ranker = quality.train_ranker(docs, labels, ~held_out)
    scored = quality.score_quality(docs.select("doc_id", "text"), ranker)
    held = F.coalesce(held_out, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
