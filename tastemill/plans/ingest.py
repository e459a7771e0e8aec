"""The ingest job: read, validate, cap, filter, split, write, describe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.operators.integrity import id_set_digest
from tastemill.operators.split import split_per_user, split_summary, split_time_global
from tastemill.operators.validate import (
    filter_low_activity_users,
    trim_to_max_rows,
    validate_interactions,
    validate_items,
    validate_users,
)
from tastemill.schemas import DEFAULTS, Settings
from tastemill.session import materialize
from tastemill.sources.file_tree import chunk_hashes, tree_roots
from tastemill.sources.tables import (
    Dataset,
    dataset_manifest,
    map_columns_by_hint,
    read_ratings,
    read_retail,
    write_splits,
)


def prepare(
    data: Dataset,
    settings: Settings = DEFAULTS,
    split_mode: str = "global",
    min_interactions: int | None = None,
    max_rows: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Validated interactions with a ``split`` column, items and users.

    The deduplicated interactions are written once, by the pass that checks them; counting, capping and splitting read that table.
    """
    if split_mode not in ("global", "per_user"):
        raise ValueError(f"unsupported split mode {split_mode!r}; use 'global' or 'per_user'")
    least = settings.min_interactions_per_user if min_interactions is None else min_interactions
    rows = validate_interactions(data.interactions)
    rows = trim_to_max_rows(rows, max_rows if max_rows is not None else settings.max_rows)
    rows = materialize(filter_low_activity_users(rows, least), "active")
    if split_mode == "global":
        split = split_time_global(rows, settings.split_ratios)
    else:
        split = split_per_user(rows, least, settings.split_ratios)
    order = [c for c in data.users.columns]
    return split, validate_items(data.items), validate_users(data.users, order)


def ingest(
    spark: SparkSession,
    dataset: str,
    source: str,
    target: str,
    version: str = "local",
    settings: Settings = DEFAULTS,
    split_mode: str = "global",
    min_interactions: int | None = None,
    max_rows: int | None = None,
    mode: str = "errorifexists",
) -> DataFrame:
    """Run the whole job for a named dataset kind and return its split summary.

    The source of the interactions is scanned once, to land it; other files are scanned where their table is made.
    """
    if dataset == "movielens":
        data = read_ratings(spark, source, settings=settings, land=True)
    elif dataset == "kaggle":
        data = read_retail(spark, source, land=True)
    elif dataset == "huggingface":
        data = map_columns_by_hint(materialize(spark.read.parquet(source), "source"), settings=settings)
    else:
        raise ValueError(f"unknown dataset {dataset!r}; use movielens, kaggle or huggingface")
    split, items, users = prepare(data, settings, split_mode, min_interactions, max_rows)
    write_splits(split, items, users, target, mode)
    written = spark.read.parquet(f"{target}/interactions")
    checksum = None
    if dataset != "huggingface":
        # One checksum for the folder: the digest of the set of its files' names and hash trees.
        files = tree_roots(chunk_hashes(spark, source))
        named = files.select(F.concat_ws("-", "name", "sha256").alias("file"))
        checksum = id_set_digest(named, "file").first()["sha256"]
    manifest = dataset_manifest(
        written, items, users, dataset, version, data.meta.get("source", dataset), checksum
    )
    manifest.write.mode(mode).json(f"{target}/manifest")
    return split_summary(written)
