"""Artifact checks: id sets, vectors, file hashes, manifests and the model registry."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.sources.file_tree import compare_trees

SCHEMA_VERSION = 1
# A sorted id list is hashed as one string only while it stays below this size.
MAX_HASHED_BYTES = 256 << 20


def check_embeddings(
    embeddings: DataFrame, dataset: DataFrame, id_column: str = "id", other_dim: int | None = None
) -> DataFrame:
    """Consistency report ``(check, expected, actual, ok)`` of vectors against a dataset's ids.

    Row counts, duplicate ids, missing and extra ids, positive equal dimensions, finite values.
    One full outer join of the per-id counts feeds the id checks.
    """
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    per_id = embeddings.groupBy(F.col(id_column).cast("string").alias("id")).agg(
        F.count("*").alias("n"),
        F.min(F.size("vector")).alias("lo"),
        F.max(F.size("vector")).alias("hi"),
        F.count_if(F.coalesce(bad, F.lit(True))).alias("bad"),
    )
    wanted = dataset.select(F.col(id_column).cast("string").alias("id")).distinct().withColumn(
        "in_set", F.lit(True)
    )
    total = per_id.join(wanted, "id", "full").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("n").alias("ids"),
        F.count_if("in_set").alias("wanted"),
        F.count_if(F.col("in_set") & F.col("n").isNull()).alias("missing"),
        F.count_if(F.col("in_set").isNull()).alias("extra"),
        F.coalesce(F.min("lo"), F.lit(0)).alias("lo"),
        F.coalesce(F.max("hi"), F.lit(0)).alias("hi"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
    )
    zero = F.lit(0)

    def row(name: str, expected: Column, actual: Column, ok: Column | None = None) -> Column:
        return F.struct(
            F.lit(name).alias("check"),
            expected.cast("bigint").alias("expected"),
            actual.cast("bigint").alias("actual"),
            (expected == actual if ok is None else ok).alias("ok"),
        )

    checks = [
        row("rows_match_dataset", F.col("wanted"), F.col("rows")),
        row("unique_ids", F.col("rows"), F.col("ids")),
        row("missing_ids", zero, F.col("missing")),
        row("extra_ids", zero, F.col("extra")),
        row("positive_dim", F.lit(1), F.col("lo"), F.col("lo") > 0),
        row("equal_dims", F.col("lo"), F.col("hi")),
        row("finite_values", zero, F.col("bad")),
    ]
    if other_dim is not None:
        checks.append(row("dims_match_other_side", F.lit(other_dim), F.col("hi")))
    return total.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


def require_ok(report: DataFrame) -> None:
    """Fail fast on the first broken check."""
    broken = report.where(~F.col("ok")).orderBy("check").first()
    if broken is not None:
        raise ValueError(
            f"integrity check failed: {broken['check']} expected={broken['expected']} "
            f"actual={broken['actual']}"
        )


def _distinct_ids(ids: DataFrame, column: str) -> DataFrame:
    return ids.select(F.col(column).cast("string").alias("id")).distinct()


def _hash_size(distinct: DataFrame) -> int:
    return distinct.agg(F.sum(F.octet_length("id") + 17)).first()[0] or 0


def id_set_hash(ids: DataFrame, column: str) -> DataFrame:
    """SHA-256 of the sorted distinct ids joined by newlines, one row ``(n, sha256)``.

    The hash is defined over one string, so it suits id sets that fit in one; larger sets are
    refused here and get their digest from ``id_set_digest``.
    """
    distinct = _distinct_ids(ids, column)
    size = _hash_size(distinct)
    if size > MAX_HASHED_BYTES:
        raise ValueError(f"id set of {size} bytes is too large to hash as one string")
    listed = F.array_sort(F.collect_list("id"))
    return distinct.agg(
        F.count("*").alias("n"), F.sha2(F.concat_ws("\n", listed), 256).alias("sha256")
    )


def id_set_digest(ids: DataFrame, column: str) -> DataFrame:
    """``(n, sha256)`` of an id set: SHA-256 of its order-free fingerprint.

    Every task adds to the fingerprint in parallel, and the definition is the same at every size,
    so a set that grows still verifies.
    """
    parts = id_set_fingerprint(ids, column)
    text = F.concat_ws("-", *[F.col(c).cast("string") for c in parts.columns])
    return parts.select("n", F.sha2(text, 256).alias("sha256"))


def id_set_fingerprint(ids: DataFrame, column: str) -> DataFrame:
    """Order-free fingerprint of an id set of any size: count, sum and xor of 32-bit md5 parts."""
    part = F.conv(F.substring(F.md5(F.col("id")), 1, 8), 16, 10).cast("bigint")
    rest = F.conv(F.substring(F.md5(F.col("id")), 9, 8), 16, 10).cast("bigint")
    return (
        _distinct_ids(ids, column)
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(part), F.lit(0)).alias("sum32"),
            F.coalesce(F.bit_xor(part), F.lit(0)).alias("xor32"),
            F.coalesce(F.bit_xor(rest), F.lit(0)).alias("xor32b"),
        )
    )


def artifact_manifest(
    user_vectors: DataFrame,
    item_vectors: DataFrame,
    files: DataFrame,
    release: str = "local",
) -> DataFrame:
    """One-row manifest: counts, dimensions, id hashes and per-file hashes.

    ``files`` is ``(name, sha256, size_bytes)``: one row per artifact file.
    """

    def side(df: DataFrame, tag: str) -> DataFrame:
        info = df.agg(
            F.count("*").alias(f"{tag}_count"), F.max(F.size("vector")).alias(f"{tag}_dim")
        )
        h = id_set_digest(df, "id").select(F.col("sha256").alias(f"{tag}_ids_sha256"))
        return info.withColumn(f"{tag}_ids_sha256", h.scalar())

    u, i = side(user_vectors, "user"), side(item_vectors, "item")
    arts = files.agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(F.struct("name", F.struct("sha256", "size_bytes").alias("meta")))
            )
        ).alias("artifacts")
    )
    keep = ["user_count", "user_dim", "user_ids_sha256"]
    return (
        u.select(
            F.lit(SCHEMA_VERSION).alias("schema_version"),
            F.lit(release).alias("release_version"),
            *keep,
        )
        .withColumn("item_count", i.select("item_count").scalar())
        .withColumn("item_dim", i.select("item_dim").scalar())
        .withColumn("item_ids_sha256", i.select("item_ids_sha256").scalar())
        .withColumn("artifacts", arts.scalar())
    )


def verify_manifest(
    stored: DataFrame | None,
    current: DataFrame,
    stored_files: DataFrame | None = None,
    current_files: DataFrame | None = None,
) -> DataFrame:
    """Compare a stored manifest with the current one: rows ``(check, expected, actual, ok)``.

    Files of any number and size are checked by their leaves (``file_tree.chunk_hashes``) if both sides give them: a
    stored file that has changed or is gone is not ok.

    An absent manifest is reported as skipped. Id hashes and file entries the stored manifest
    does not name are not checked; its schema version must be 1.
    """
    spark = current.sparkSession
    schema = "check string, expected string, actual string, ok boolean"
    if stored is None:
        return spark.createDataFrame([("manifest", "present", "skipped", True)], schema)
    old = stored.first()
    new = current.first()
    rows = [("schema_version", str(SCHEMA_VERSION), str(old["schema_version"]))]
    rows += [
        (name, str(old[name]), str(new[name]))
        for name in ("user_count", "item_count", "user_ids_sha256", "item_ids_sha256")
        if old[name] is not None
    ]
    known = new["artifacts"] or {}
    rows += [
        (f"file:{name}", meta["sha256"], known[name]["sha256"])
        for name, meta in sorted((old["artifacts"] or {}).items())
        if name in known
    ]
    checks = spark.createDataFrame([(c, e, a, e == a) for c, e, a in rows], schema)
    if stored_files is None or current_files is None:
        return checks
    files = compare_trees(stored_files, current_files).where(F.col("expected").isNotNull())
    return checks.unionByName(files.select(F.concat(F.lit("file:"), "name").alias("check"), "expected", "actual", "ok"))


def register_model(
    spark: SparkSession,
    path: str,
    name: str,
    version: str,
    metrics: dict,
    hyperparameters: dict | None = None,
    dataset_version: str = "unknown",
    status: str = "candidate",
) -> None:
    """Append a model to the registry log."""
    _append(
        spark,
        path,
        {
            "model_name": name,
            "model_version": version,
            "dataset_version": dataset_version,
            "metrics": json.dumps(metrics),
            "hyperparameters": json.dumps(hyperparameters or {}),
            "status": status,
        },
    )


def set_model_status(spark: SparkSession, path: str, name: str, version: str, status: str) -> None:
    """Promote or demote a registered model by appending its new status."""
    _append(
        spark, path, {"model_name": name, "model_version": version, "status": status}
    )


REGISTRY_COLUMNS: Sequence[str] = (
    "model_name",
    "model_version",
    "dataset_version",
    "metrics",
    "hyperparameters",
    "status",
)
REGISTRY_SCHEMA = ", ".join(f"{c} STRING" for c in REGISTRY_COLUMNS) + ", logged_at TIMESTAMP"


def _append(spark: SparkSession, path: str, values: dict) -> None:
    row = spark.range(1).select(
        *[F.lit(values.get(c)).cast("string").alias(c) for c in REGISTRY_COLUMNS],
        F.current_timestamp().alias("logged_at"),
    )
    row.write.mode("append").json(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).json(path)


def model_registry(log: DataFrame, order_by: str = "logged_at") -> DataFrame:
    """Latest known value of every field per model version."""
    latest = [
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order_by))).alias(c)
        for c in log.columns
        if c not in ("model_name", "model_version", order_by)
    ]
    return log.groupBy("model_name", "model_version").agg(*latest)
