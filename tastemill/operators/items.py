"""Assembly of item and user dimension tables from raw sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.functions.hashing import seeded_order
from tastemill.operators.ordering import head_by_order, top_k_per_group


def top_tags_per_item(tags: DataFrame, n: int = 8) -> DataFrame:
    """The ``n`` most used tags per item, joined by spaces; equal counts go by tag."""
    counted = (
        tags.where(F.col("item_id").isNotNull() & F.col("tag").isNotNull())
        .groupBy("item_id", "tag")
        .agg(F.count("*").alias("cnt"))
    )
    best = top_k_per_group(counted, ["item_id"], [F.desc("cnt"), F.asc("tag")], n)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "tag")))
    return best.groupBy("item_id").agg(
        F.array_join(F.transform(ordered, lambda r: r["tag"]), " ").alias("user_tags")
    )


def assemble_rated_items(movies: DataFrame, user_tags: DataFrame) -> DataFrame:
    """Items with pipe-separated genres: first genre as category, comma list as tags, full text."""
    genres = F.col("genres")
    return movies.join(user_tags, "item_id", "left").select(
        "item_id",
        "title",
        F.split(genres, r"\|")[0].alias("category"),
        F.nullif(F.replace(genres, F.lit("|"), F.lit(", ")), F.lit("")).alias("tags"),
        "user_tags",
        F.concat_ws(
            " ",
            F.nullif("title", F.lit("")),
            F.nullif(F.replace(genres, F.lit("|"), F.lit(" ")), F.lit("")),
            F.nullif("user_tags", F.lit("")),
        ).alias("text_description"),
    )


RETAIL_TEXT = (
    "prod_name",
    "product_type_name",
    "index_group_name",
    "section_name",
    "graphical_appearance_name",
    "colour_group_name",
    "detail_desc",
)


def assemble_retail_items(articles: DataFrame) -> DataFrame:
    return articles.select(
        "item_id",
        F.col("prod_name").cast("string").alias("title"),
        F.col("product_type_name").cast("string").alias("category"),
        F.concat(F.col("product_group_name"), F.lit(", "), F.col("graphical_appearance_name")).alias(
            "tags"
        ),
        F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("")) for c in RETAIL_TEXT]).alias(
            "text_description"
        ),
    )


def pack_metadata_json(users: DataFrame, key: str = "user_id") -> DataFrame:
    """All columns but the key as one JSON string, nulls included."""
    rest = [c for c in users.columns if c != key]
    return users.select(
        key, F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias("metadata")
    )


def distinct_entities(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def first_attributes_per_item(
    df: DataFrame, item: str, columns: dict[str, str], order_by: Sequence[str]
) -> DataFrame:
    """First non-null value of each text column per item, in ``order_by`` order.

    ``columns`` maps output names to source columns. Only a running minimum per item is kept, so
    an item with very many rows costs no more than any other.
    """
    order = F.struct(*[F.col(c) for c in order_by])
    firsts = [
        F.min_by(F.col(src).cast("string"), F.when(F.col(src).isNotNull(), order)).alias(out)
        for out, src in columns.items()
    ]
    return df.groupBy(F.col(item).cast("string").alias("item_id")).agg(*firsts)


def profile_dataset(interactions: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """Event counts by type, item count and user count as rows ``(metric, value)``."""
    by_type = interactions.groupBy(
        F.concat(F.lit("events:"), F.coalesce("event_type", F.lit("unknown"))).alias("metric")
    ).agg(F.count("*").alias("value"))
    n_items = items.agg(F.count("*").alias("value")).select(F.lit("n_items").alias("metric"), "value")
    n_users = users.agg(F.count("*").alias("value")).select(F.lit("n_users").alias("metric"), "value")
    return by_type.unionByName(n_items).unionByName(n_users)


def sample_rows(df: DataFrame, keys: Sequence[str], n: int = 5, seed: int = 42) -> DataFrame:
    """Seeded sample: the ``n`` rows with the smallest key hash."""
    hashed = df.withColumn("_h", seeded_order(df, keys, seed))
    return head_by_order(hashed, ["_h", *keys], n).drop("_h")
