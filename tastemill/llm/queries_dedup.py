"""Queries of the operators that find repeats inside and between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm import ngram_join, substring, suffix
from tastemill.llm.registry import query, table

_SUBSTRING_SQL = r"""
WITH w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(list_slice(ws, i, i + 12), ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
m AS (SELECT k, min(doc_id) AS low FROM g GROUP BY k),
r AS MATERIALIZED (
  SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS p FROM g JOIN m USING (k) WHERE low < doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM r GROUP BY doc_id),
x AS (SELECT doc_id, p, ws[p] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM x ANTI JOIN r USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query("op2_substring_dedup", _SUBSTRING_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


@query("op3_suffix_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op8_ngram_jaccard_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.join_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n_names").alias("n_shingles"), "component_id")
