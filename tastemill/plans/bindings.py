"""Logical tables over the star-schema files, with the matching SQL for checks.

``events`` are interactions over 100 items, ``lineitem`` with ``orders`` the large purchase
history, ``part`` the catalog, ``customer`` the users, ``embeddings`` the item vectors and
``conversations`` the messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.functions.text import CATEGORY_ALIASES, PHRASES
from tastemill.session import configure

DIM = 64
GENRES = sorted(set(CATEGORY_ALIASES.values()))
OPENERS = list(PHRASES)
CUT = "2024-01-22"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def raw_interactions(spark, d) -> DataFrame:
    """All events as interactions, event types outside the vocabulary included."""
    return table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("item_id"),
        "event_type",
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


RAW = """SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS item_id,
 event_type, ts AS "timestamp" FROM events"""


def interactions(spark, d) -> DataFrame:
    """Valid events. ``(user_id, ts)`` is unique in the source, so no row repeats."""
    from tastemill.schemas import BATCH_EVENTS

    return raw_interactions(spark, d).where(F.col("event_type").isin(*BATCH_EVENTS))


VALID = f"SELECT * FROM ({RAW}) WHERE event_type IN ('view', 'click', 'like', 'purchase')"
WEIGHT = "CASE event_type WHEN 'click' THEN 2.0::DOUBLE WHEN 'like' THEN 3.0::DOUBLE WHEN 'purchase' THEN 5.0::DOUBLE ELSE 1.0::DOUBLE END"


def interactions_with_value(spark, d) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("item_id"),
        "value",
    )


def train(spark, d) -> DataFrame:
    return interactions(spark, d).where(F.col("timestamp") < F.lit(CUT).cast("timestamp"))


def test(spark, d) -> DataFrame:
    return interactions(spark, d).where(F.col("timestamp") >= F.lit(CUT).cast("timestamp"))


TRAIN = f"SELECT * FROM ({VALID}) WHERE \"timestamp\" < TIMESTAMP '{CUT}'"
TEST = f"SELECT * FROM ({VALID}) WHERE \"timestamp\" >= TIMESTAMP '{CUT}'"


def purchases(spark, d) -> DataFrame:
    """The large history: one row per line item, typed by its return flag."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_shipdate")
    kind = F.when(F.col("l_returnflag") == "A", "view").when(
        F.col("l_returnflag") == "R", "like"
    ).otherwise("purchase")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("item_id"),
        kind.alias("event_type"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
    )


PURCHASES = """SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item_id,
 CASE l_returnflag WHEN 'A' THEN 'view' WHEN 'R' THEN 'like' ELSE 'purchase' END AS event_type,
 l_shipdate AS "timestamp" FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def ratings(spark, d) -> DataFrame:
    """Line items as ratings: a tenth of the quantity, from 0.1 to 5.0."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        (F.col("l_quantity") / 10).alias("rating"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
    )


RATINGS = """SELECT o_custkey AS userId, l_partkey AS movieId, l_quantity / 10 AS rating,
 CAST(epoch(l_shipdate) AS BIGINT) AS ts FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def items(spark, d) -> DataFrame:
    """The catalog; every second item lacks a text of its own."""
    return table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("item_id"),
        F.col("p_name").alias("title"),
        F.element_at(
            F.array(*[F.lit(g) for g in GENRES]), F.pmod(F.col("p_size"), F.lit(len(GENRES))) + 1
        ).alias("category"),
        F.col("p_brand").alias("tags"),
        F.when(
            F.col("p_size") % 2 == 0, F.concat_ws(" ", F.lower("p_type"), F.col("p_name"))
        ).alias("text_description"),
    )


_GENRE_LIST = ", ".join(f"'{g}'" for g in GENRES)
ITEMS = f"""SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS title,
 ([{_GENRE_LIST}])[CAST(p_size % {len(GENRES)} AS INTEGER) + 1] AS category, p_brand AS tags,
 CASE WHEN p_size % 2 = 0 THEN lower(p_type) || ' ' || p_name END AS text_description FROM part"""


def vectors(spark, d) -> DataFrame:
    return table(spark, d, "embeddings").select(
        F.col("vec_id").cast("string").alias("item_id"), F.col("embedding").alias("vector")
    )


VECTORS = "SELECT CAST(vec_id AS VARCHAR) AS item_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings"


def users(spark, d) -> DataFrame:
    return table(spark, d, "customer").withColumn("user_id", F.col("c_custkey").cast("string"))


def messages(spark, d) -> DataFrame:
    """What users wrote, whole texts."""
    return (
        table(spark, d, "conversations")
        .where(F.col("role") == "user")
        .select(
            F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias(
                "request_id"
            ),
            F.col("text").alias("message"),
        )
    )


MESSAGES = """SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS request_id, text AS message
 FROM conversations WHERE role = 'user'"""


def requests(spark, d) -> DataFrame:
    """Search requests: each event asks for its item's name behind one of the opening phrases."""
    e = table(spark, d, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
    p = table(spark, d, "part").select("p_partkey", "p_name")
    opener = F.element_at(
        F.array(*[F.lit(o) for o in OPENERS]),
        (F.pmod(F.col("k"), F.lit(len(OPENERS))) + 1).cast("int"),
    )
    return e.join(p, F.col("k") == F.col("p_partkey")).select(
        F.col("event_id").cast("string").alias("request_id"),
        "user_id",
        F.concat_ws(" ", opener, F.when(F.col("k") % 3 > 0, F.col("p_name"))).alias("q"),
    )


_OPENER_LIST = ", ".join(f"'{o}'" for o in OPENERS)
REQUESTS = f"""SELECT CAST(event_id AS VARCHAR) AS request_id, CAST(user_id AS VARCHAR) AS user_id,
 concat_ws(' ', ([{_OPENER_LIST}])[CAST(k % {len(OPENERS)} AS INTEGER) + 1], CASE WHEN k % 3 > 0 THEN p_name END) AS q
 FROM (SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
 JOIN part ON k = p_partkey"""


def event_stream(spark, d) -> DataFrame:
    """The events table as a stream of rows."""
    schema = table(spark, d, "events").schema
    raw = spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]")
    return raw.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("item_id"),
        "event_type",
        F.col("ts").cast("timestamp").alias("timestamp"),
        "value",
    )
