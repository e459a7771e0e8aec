"""Integrity checks, manifests and the model registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.operators import integrity as K
from tastemill.plans import bindings as B
from tastemill.plans.queries_models import user_vectors
from tastemill.plans.registry import query
from tastemill.session import materialize, scratch_path
from tastemill.sources.file_tree import chunk_hashes, compare_trees
from tastemill.sources.tables import file_checksums, write_vectors


@query(
    "check_embeddings",
    """WITH e AS (SELECT CAST(vec_id AS VARCHAR) AS id, embedding AS v FROM embeddings), p AS (SELECT CAST(p_partkey AS VARCHAR) AS id FROM part),
 t AS (SELECT (SELECT count(*) FROM p) AS wanted, (SELECT count(*) FROM e) AS rows, (SELECT count(DISTINCT id) FROM e) AS ids,
 (SELECT count(*) FROM p WHERE id NOT IN (SELECT id FROM e)) AS missing, (SELECT count(*) FROM e WHERE id NOT IN (SELECT id FROM p)) AS extra,
 (SELECT min(len(v)) FROM e) AS lo, (SELECT max(len(v)) FROM e) AS hi)
 SELECT 'rows_match_dataset' AS "check", wanted AS expected, rows AS actual, wanted = rows AS ok FROM t
 UNION ALL SELECT 'unique_ids', rows, ids, rows = ids FROM t UNION ALL SELECT 'missing_ids', 0, missing, missing = 0 FROM t
 UNION ALL SELECT 'extra_ids', 0, extra, extra = 0 FROM t UNION ALL SELECT 'positive_dim', 1, lo, lo > 0 FROM t
 UNION ALL SELECT 'equal_dims', lo, hi, lo = hi FROM t UNION ALL SELECT 'finite_values', 0, 0, true FROM t
 UNION ALL SELECT 'dims_match_other_side', 64, hi, hi = 64 FROM t""",
)
def _(spark, d):
    """Item vectors against the whole catalog, which is larger: some checks fail."""
    return K.check_embeddings(
        B.vectors(spark, d).withColumnRenamed("item_id", "id"),
        B.items(spark, d).select(F.col("item_id").alias("id")),
        other_dim=B.DIM,
    )


@query(
    "id_set_hash",
    "SELECT count(*) AS n, sha256(string_agg(id, chr(10) ORDER BY id)) AS sha256 FROM (SELECT DISTINCT CAST(vec_id AS VARCHAR) AS id FROM embeddings)",
)
def _(spark, d):
    return K.id_set_hash(B.vectors(spark, d), "item_id")


def _digest_sql(ids: str) -> str:
    """Digest of a query of distinct ids: SHA-256 of its count, sum and xors of md5 parts."""
    return f"""SELECT n, sha256(concat_ws('-', n, s, x, y)) AS sha256 FROM (
 SELECT count(*) AS n, CAST(coalesce(sum(a), 0) AS BIGINT) AS s, coalesce(bit_xor(a), 0) AS x, coalesce(bit_xor(b), 0) AS y FROM (
 SELECT CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) AS a, CAST('0x' || substr(md5(id), 9, 8) AS BIGINT) AS b FROM ({ids})))"""


@query("id_set_digest", _digest_sql("SELECT DISTINCT CAST(vec_id AS VARCHAR) AS id FROM embeddings"))
def _(spark, d):
    return K.id_set_digest(B.vectors(spark, d), "item_id")


@query(
    "id_set_fingerprint",
    f"""SELECT count(*) AS n, CAST(sum(a) AS BIGINT) AS sum32, bit_xor(a) AS xor32, bit_xor(b) AS xor32b FROM (
 SELECT CAST('0x' || substr(md5(user_id), 1, 8) AS BIGINT) AS a, CAST('0x' || substr(md5(user_id), 9, 8) AS BIGINT) AS b
 FROM (SELECT DISTINCT user_id FROM ({B.PURCHASES})))""",
)
def _(spark, d):
    return K.id_set_fingerprint(B.purchases(spark, d), "user_id")


def _manifest(spark, d):
    out = scratch_path(spark, "vectors")
    write_vectors(B.vectors(spark, d).withColumnRenamed("item_id", "id"), out, "v1")
    users = user_vectors(spark, d).withColumnRenamed("user_id", "id")
    items = B.vectors(spark, d).withColumnRenamed("item_id", "id")
    files = file_checksums(spark, out).where(F.col("name").endswith(".parquet"))
    return K.artifact_manifest(users, items, files), users, items


@query(
    "artifact_manifest",
    f"""SELECT 1 AS schema_version, 'local' AS release_version, u.n AS user_count, 64 AS user_dim, u.sha256 AS user_ids_sha256,
 i.n AS item_count, 64 AS item_dim, i.sha256 AS item_ids_sha256 FROM ({_digest_sql(f"SELECT DISTINCT user_id AS id FROM ({B.TRAIN})")}) u,
 ({_digest_sql("SELECT DISTINCT CAST(vec_id AS VARCHAR) AS id FROM embeddings")}) i""",
)
def _(spark, d):
    return _manifest(spark, d)[0].drop("artifacts")


def _line_files(spark, d, changed: bool) -> str:
    """One file of document lines per language; with ``changed`` the last line of the French one differs."""
    docs = B.table(spark, d, "documents")
    last = docs.where("lang = 'fr'").agg(F.max("doc_id")).scalar()
    n = F.when(F.lit(changed) & (F.col("doc_id") == last), F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    lines = docs.select("lang", "doc_id", F.concat_ws("|", "doc_id", "source", n).alias("line"))
    out = scratch_path(spark, "lines")
    held = lines.repartition("lang").sortWithinPartitions("lang", "doc_id").select("line", "lang")
    held.write.partitionBy("lang").text(out)
    return out


def _leaves(spark, d, changed: bool = False):
    leaves = chunk_hashes(spark, _line_files(spark, d, changed), 1024)
    return materialize(leaves.withColumn("name", F.substring_index("name", "/", 1)), "leaves")


@query(
    "chunk_hashes",
    """WITH l AS (SELECT lang, doc_id, concat_ws('|', doc_id, source, n_chars) AS line FROM documents),
 o AS (SELECT *, coalesce(sum(strlen(line) + 1) OVER (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
 sum(strlen(line) + 1) OVER (PARTITION BY lang) AS size FROM l)
 SELECT 'lang=' || lang AS name, CAST(start // 1024 AS BIGINT) AS chunk, sha256(string_agg(sha256(line), '' ORDER BY start)) AS sha256,
 CAST(size AS BIGINT) AS size_bytes FROM o GROUP BY lang, start // 1024, size""",
)
def _(spark, d):
    """Leaves of every kilobyte of the files of document lines."""
    return _leaves(spark, d)


@query(
    "compare_trees",
    """SELECT 'lang=' || lang AS name, CAST(lang = 'fr' AS BIGINT) AS n_changed, lang <> 'fr' AS ok FROM (SELECT DISTINCT lang FROM documents)""",
)
def _(spark, d):
    """One changed line in one of the files."""
    return compare_trees(_leaves(spark, d), _leaves(spark, d, True)).select("name", "n_changed", "ok")


@query(
    "verify_manifest",
    f"""WITH i AS (SELECT n, sha256 FROM ({_digest_sql("SELECT DISTINCT CAST(vec_id AS VARCHAR) AS id FROM embeddings")})),
 k AS (SELECT n, sha256 FROM ({_digest_sql("SELECT DISTINCT CAST(vec_id AS VARCHAR) AS id FROM embeddings WHERE label <> 0")})),
 u AS (SELECT CAST(n AS VARCHAR) AS n, sha256 FROM ({_digest_sql(f"SELECT DISTINCT user_id AS id FROM ({B.TRAIN})")}))
 SELECT 'schema_version' AS "check", '1' AS expected, true AS ok UNION ALL SELECT 'user_count', n, true FROM u
 UNION ALL SELECT 'user_ids_sha256', sha256, true FROM u
 UNION ALL SELECT 'item_count', CAST(i.n AS VARCHAR), i.n = k.n FROM i, k UNION ALL SELECT 'item_ids_sha256', i.sha256, i.sha256 = k.sha256 FROM i, k
 UNION ALL SELECT 'file:lang=' || lang, NULL, lang <> 'fr' FROM (SELECT DISTINCT lang FROM documents)""",
)
def _(spark, d):
    """A stored manifest against vectors that have since lost the items of label 0, and files of which one has changed."""
    stored, users, items = _manifest(spark, d)
    path = scratch_path(spark, "manifest")
    stored.write.json(path)
    kept = B.table(spark, d, "embeddings").where("label <> 0").select(
        F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("vector")
    )
    files = stored.select(F.explode("artifacts").alias("name", "meta")).select("name", "meta.*")
    now = K.artifact_manifest(users, kept, files)
    back = spark.read.schema(stored.schema).json(path)
    checks = K.verify_manifest(back, now, _leaves(spark, d), _leaves(spark, d, True))
    # Names of Spark's own part files differ from run to run.
    checks = checks.where(~F.col("check").startswith("file:part-"))
    return checks.select("check", F.when(~F.col("check").startswith("file:"), F.col("expected")).alias("expected"), "ok")


@query(
    "model_registry",
    """SELECT event_type AS model_name, 'v' || user_id AS model_version, 'events' AS dataset_version,
 arg_min(props, (ts, event_id)) AS metrics, '{}' AS hyperparameters, arg_max(CASE WHEN value > 50 THEN 'production' ELSE 'candidate' END, (ts, event_id)) AS status
 FROM events GROUP BY event_type, user_id""",
)
def _(spark, d):
    """Registry log written as JSON: the first event registers a model, later ones set its status."""
    from pyspark.sql import Window

    w = Window.partitionBy("event_type", "user_id").orderBy("ts", "event_id")
    first = F.row_number().over(w) == 1
    log = B.table(spark, d, "events").select(
        F.col("event_type").alias("model_name"),
        F.concat(F.lit("v"), "user_id").alias("model_version"),
        F.when(first, "events").alias("dataset_version"),
        F.when(first, F.col("props")).alias("metrics"),
        F.when(first, "{}").alias("hyperparameters"),
        F.when(F.col("value") > 50, "production").otherwise("candidate").alias("status"),
        # Two events of one model never share a microsecond.
        F.col("ts").cast("timestamp").alias("logged_at"),
    )
    path = scratch_path(spark, "registry")
    log.write.json(path)
    return K.model_registry(K.read_registry(spark, path))
