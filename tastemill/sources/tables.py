"""Readers and writers of datasets, vectors, logs and file hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from urllib.parse import urlparse
from urllib.request import url2pathname

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.functions.events import (
    namespaced_id,
    normalize_timestamp,
    rating_to_event,
    text_to_event,
)
from tastemill.operators.items import (
    assemble_rated_items,
    assemble_retail_items,
    distinct_entities,
    first_attributes_per_item,
    pack_metadata_json,
    top_tags_per_item,
)
from tastemill.operators.ordering import head_by_order
from tastemill.operators.split import SPLITS
from tastemill.schemas import DEFAULTS, MOVIES_CSV, RATINGS_CSV, TAGS_CSV, Settings
from tastemill.session import materialize

# Column-name hints of unknown datasets, in matching order.
COLUMN_HINTS = {
    "user_id": ("user", "usr", "customer", "client"),
    "item_id": ("item", "movie", "product", "article", "content"),
    "event": ("event", "interaction", "behaviour", "behavior", "engagement"),
    "rating": ("rating", "score", "stars"),
    "timestamp": ("timestamp", "datetime", "time", "date", "ts"),
    "title": ("title", "name", "product_name", "prod_name"),
    "category": ("category", "genre", "product_type", "department", "type", "context"),
    "tags": ("tag", "topic", "keyword"),
    "description": ("text", "desc", "abstract", "review"),
}
# Upper end of the like range for unbounded numeric events.
NUMERIC_EVENT_MAX = 1e18
_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


@dataclass(frozen=True)
class Dataset:
    """Three base tables of one source, and what is known about it."""

    interactions: DataFrame
    items: DataFrame
    users: DataFrame
    meta: dict = field(default_factory=dict)


def cap_rows(df: DataFrame, max_rows: int | None, keys: Sequence[str]) -> DataFrame:
    """The first rows in an explicit order."""
    return df if max_rows is None else head_by_order(df, keys, max_rows)


def _csv(
    spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header; only dimension files may hold line breaks, as those cannot be split."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).csv(path)


def ratings_interactions(ratings: DataFrame, threshold: float = DEFAULTS.like_threshold) -> DataFrame:
    """Interactions of a ``(userId, movieId, rating, timestamp)`` table."""
    return ratings.select(
        namespaced_id("ml_user_", "userId").alias("user_id"),
        namespaced_id("ml_item_", "movieId").alias("item_id"),
        rating_to_event("rating", threshold).alias("event_type"),
        F.timestamp_seconds(F.col("timestamp")).alias("timestamp"),
    )


def rated_dataset(
    ratings: DataFrame, movies: DataFrame, tags: DataFrame, settings: Settings = DEFAULTS
) -> Dataset:
    interactions = ratings_interactions(ratings, settings.like_threshold)
    tagged = tags.dropna().select(namespaced_id("ml_item_", "movieId").alias("item_id"), "tag")
    films = movies.withColumn("item_id", namespaced_id("ml_item_", "movieId"))
    items = assemble_rated_items(films, top_tags_per_item(tagged))
    return Dataset(
        interactions, items, distinct_entities(interactions, "user_id"), {"source": "movielens"}
    )


def read_ratings(
    spark: SparkSession, path: str, max_rows: int | None = None, settings: Settings = DEFAULTS, land: bool = False
) -> Dataset:
    """Ratings, movies and tags CSV files of one folder; with ``land`` the ratings are parsed once and written."""
    ratings = _csv(spark, f"{path}/ratings.csv", RATINGS_CSV)
    ratings = materialize(ratings, "ratings") if land else ratings
    ratings = cap_rows(ratings, max_rows, ["userId", "movieId", "timestamp", "rating"])
    movies = _csv(spark, f"{path}/movies.csv", MOVIES_CSV)
    tags = _csv(spark, f"{path}/tags.csv", TAGS_CSV).select("movieId", "tag")
    return rated_dataset(ratings, movies, tags, settings)


def retail_dataset(transactions: DataFrame, articles: DataFrame, customers: DataFrame) -> Dataset:
    interactions = transactions.select(
        namespaced_id("hm_user_", "customer_id", numeric=False).alias("user_id"),
        namespaced_id("hm_item_", "article_id").alias("item_id"),
        F.lit("purchase").alias("event_type"),
        F.col("t_dat").cast("timestamp").alias("timestamp"),
    )
    items = assemble_retail_items(
        articles.withColumn("item_id", namespaced_id("hm_item_", "article_id"))
    )
    rest = [c for c in customers.columns if c != "customer_id"]
    users = pack_metadata_json(
        customers.select(namespaced_id("hm_user_", "customer_id", numeric=False).alias("user_id"), *rest)
    )
    return Dataset(interactions, items, users, {"source": "kaggle"})


def read_retail(spark: SparkSession, path: str, max_rows: int | None = None, land: bool = False) -> Dataset:
    """Transactions, articles and customers CSV files; ids are read as text. ``land`` parses the transactions once."""
    transactions = _csv(spark, f"{path}/transactions_train.csv")
    transactions = materialize(transactions, "transactions") if land else transactions
    transactions = cap_rows(transactions, max_rows, ["t_dat", "customer_id", "article_id"])
    articles = _csv(spark, f"{path}/articles.csv", multi_line=True)
    return retail_dataset(transactions, articles, _csv(spark, f"{path}/customers.csv"))


def pick_column(columns: Sequence[str], hints: Sequence[str]) -> str | None:
    """First column containing the earliest hint."""
    return next((c for h in hints for c in columns if h in c.lower()), None)


def map_columns(columns: Sequence[str]) -> dict[str, str | None]:
    found = {role: pick_column(columns, hints) for role, hints in COLUMN_HINTS.items()}
    if not found["user_id"] or not found["item_id"]:
        raise ValueError("could not detect user and item columns")
    return found


def map_columns_by_hint(
    df: DataFrame, order_by: Sequence[str] | None = None, settings: Settings = DEFAULTS
) -> Dataset:
    """Dataset of an unknown table, its columns chosen by name.

    ``order_by`` decides which row is an item's first; by default all columns in table order.
    """
    found = map_columns(df.columns)
    types = dict(df.dtypes)
    event = found["event"] or found["rating"]
    if event and types[event].startswith(_NUMERIC):
        kind = rating_to_event(F.col(event), settings.like_threshold, NUMERIC_EVENT_MAX)
    elif event:
        kind = text_to_event(F.col(event).cast("string"))
    else:
        kind = F.lit("view")
    ts = found["timestamp"]
    interactions = df.select(
        F.col(found["user_id"]).cast("string").alias("user_id"),
        F.col(found["item_id"]).cast("string").alias("item_id"),
        kind.alias("event_type"),
        (normalize_timestamp(ts, types[ts]) if ts else F.current_timestamp()).alias("timestamp"),
    )
    text = {
        "title": found["title"],
        "category": found["category"],
        "tags": found["tags"],
        "text_description": found["description"],
    }
    named = {out: src for out, src in text.items() if src}
    if named:
        items = first_attributes_per_item(df, found["item_id"], named, order_by or df.columns)
    else:
        items = df.select(F.col(found["item_id"]).cast("string").alias("item_id")).distinct()
    for out, src in text.items():
        if not src:
            items = items.withColumn(out, F.lit(None).cast("string"))
    users = df.select(F.col(found["user_id"]).cast("string").alias("user_id")).distinct()
    return Dataset(
        interactions,
        items.select("item_id", *text),
        users,
        {"source": "huggingface", "raw_cols": df.columns},
    )


def write_splits(
    split: DataFrame, items: DataFrame, users: DataFrame, path: str, mode: str = "errorifexists"
) -> None:
    """Interactions partitioned by split, next to the items and users tables."""
    split.write.mode(mode).partitionBy("split").parquet(f"{path}/interactions")
    items.write.mode(mode).parquet(f"{path}/items")
    users.write.mode(mode).parquet(f"{path}/users")


def load_processed(spark: SparkSession, path: str, splits: Sequence[str] = SPLITS) -> dict[str, DataFrame]:
    """Read a written dataset back; a missing split is an error. Only asked-for splits are read."""
    rows = spark.read.parquet(f"{path}/interactions")
    present = {r["split"] for r in rows.select("split").distinct().collect()}  # a few names
    missing = [s for s in splits if s not in present]
    if missing:
        raise FileNotFoundError(f"missing processed splits {missing}; run the ingest job first")
    out = {s: rows.where(F.col("split") == s).drop("split") for s in splits}
    out["items"] = spark.read.parquet(f"{path}/items")
    out["users"] = spark.read.parquet(f"{path}/users")
    return out


def _hash_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of files on a mounted path, read in chunks."""
    for files in batches:
        digests = []
        for path in files["path"]:
            digest = hashlib.sha256()
            with open(url2pathname(urlparse(path).path), "rb") as f:
                while chunk := f.read(1 << 20):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield files.assign(sha256=digests)


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of each file below a path: rows ``(name, sha256, size_bytes)``.

    Files spread over the tasks. Those on a mounted file system are hashed in chunks whatever
    their size, and Spark only lists them; object stores hand a file over whole, so there a file must fit in a task.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # Decided once: a filter on the path comes too late, since the reader has then loaded the whole file.
    if system.getUri().getScheme() == "file":
        hashed = files.select("path", "length").mapInPandas(_hash_files, "path string, length long, sha256 string")
    else:
        hashed = files.select("path", "length", F.sha2("content", 256).alias("sha256"))
    return hashed.select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "sha256",
        F.col("length").alias("size_bytes"),
    )


def dataset_manifest(
    split: DataFrame,
    items: DataFrame,
    users: DataFrame,
    name: str,
    version: str,
    source: str,
    checksum: str | None = None,
) -> DataFrame:
    """One row describing a dataset: row count, schema fields, split sizes, checksum."""
    sizes = [F.count_if(F.col("split") == s).alias(s) for s in SPLITS]
    fields = {
        "interactions": [c for c in split.columns if c != "split"],
        "items": items.columns,
        "users": users.columns,
    }
    schema = F.struct(
        *[F.array(*[F.lit(c) for c in cols]).alias(t) for t, cols in fields.items()]
    )
    return split.agg(F.count("*").alias("row_count"), F.struct(*sizes).alias("splits")).select(
        F.struct(
            F.lit(name).alias("name"),
            F.lit(source).alias("source"),
            F.lit(version).alias("version"),
            F.lit(f"{name}-{version}").alias("dataset_version"),
            "row_count",
            F.lit(checksum).cast("string").alias("checksum"),
        ).alias("dataset"),
        schema.alias("schema_fields"),
        "splits",
        F.lit("ingest-v1").alias("pipeline_version"),
    )


def write_vectors(df: DataFrame, path: str, version: str, mode: str = "errorifexists") -> None:
    """Vectors as ``(id, vector ARRAY<FLOAT>, version)``."""
    df.select(
        F.col("id").cast("string").alias("id"),
        F.col("vector").cast("array<float>").alias("vector"),
        F.lit(version).alias("version"),
    ).write.mode(mode).parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


EXPERIMENT_SCHEMA = (
    "model STRING, version STRING, dataset STRING, metrics MAP<STRING, DOUBLE>, "
    "timestamp TIMESTAMP, notes STRING"
)


def record_experiment(
    spark: SparkSession,
    path: str,
    model: str,
    version: str,
    dataset: str,
    metrics: dict[str, float],
    notes: str | None = None,
) -> None:
    """Append one run to the experiment log."""
    pairs = [F.lit(x) for k, v in metrics.items() for x in (k, float(v))]
    row = spark.range(1).select(
        F.lit(model).alias("model"),
        F.lit(version).alias("version"),
        F.lit(dataset).alias("dataset"),
        (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")).alias("metrics"),
        F.current_timestamp().alias("timestamp"),
        F.lit(notes).cast("string").alias("notes"),
    )
    row.write.mode("append").json(path)


def read_experiments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EXPERIMENT_SCHEMA).json(path)


# Metric columns of the ablation table.
ABLATION_METRICS = ("recall@20", "ndcg@20", "hit@20", "coverage", "diversity")


def ablation_table(
    runs: DataFrame, latest_per_model: bool = True, require_metrics: bool = True
) -> DataFrame:
    """Latest run per model with its headline metrics, 0 where a metric is absent.

    Runs without metrics are passed over unless ``require_metrics`` is off.
    """
    rows = runs.where(F.size("metrics") > 0) if require_metrics else runs
    if latest_per_model:
        newest = F.max_by(F.struct("version", "dataset", "metrics"), F.col("timestamp"))
        rows = rows.groupBy("model").agg(newest.alias("r")).select("model", "r.*")
    return rows.select(
        "model",
        "version",
        "dataset",
        *[
            F.coalesce(F.try_element_at("metrics", F.lit(m)), F.lit(0.0)).alias(m.replace("@", "_"))
            for m in ABLATION_METRICS
        ],
    )


