"""Sources, validation and splits over the bound tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.functions.events import (
    epoch_to_timestamp,
    event_weight,
    namespaced_id,
    rating_to_event,
    text_to_event,
)
from tastemill.functions.text import ITEM_TEXT_FIELDS, item_text
from tastemill.operators import items as I
from tastemill.operators import split as S
from tastemill.operators import validate as V
from tastemill.plans import bindings as B
from tastemill.plans.ingest import ingest, prepare
from tastemill.plans.registry import query
from tastemill.session import materialize, scratch_path
from tastemill.sources import tables as T


def _us(name: str = "timestamp", alias: str = "ts_us"):
    return F.unix_micros(name).alias(alias)


_SQL_US = 'CAST(epoch_us("timestamp") AS BIGINT) AS ts_us'


def _summary(df):
    """Rows, users, items and time span per event type."""
    return df.groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("item_id").alias("items"),
        F.min(F.unix_micros("timestamp")).alias("first_us"),
        F.max(F.unix_micros("timestamp")).alias("last_us"),
    )


_SQL_SUMMARY = """event_type, count(*) AS n, count(DISTINCT user_id) AS users,
 count(DISTINCT item_id) AS items, CAST(min(epoch_us("timestamp")) AS BIGINT) AS first_us,
 CAST(max(epoch_us("timestamp")) AS BIGINT) AS last_us"""


def _rated(spark, d):
    """Ratings, movies with pipe-separated genres, and user tags."""
    movies = B.items(spark, d).select(
        F.col("item_id").cast("bigint").alias("movieId"),
        "title",
        F.concat_ws("|", "category", "tags").alias("genres"),
    )
    tags = B.raw_interactions(spark, d).select(
        F.col("user_id").cast("bigint").alias("userId"),
        F.col("item_id").cast("bigint").alias("movieId"),
        F.concat(F.col("event_type"), F.pmod(F.col("user_id").cast("int"), F.lit(4))).alias("tag"),
        F.unix_seconds("timestamp").alias("timestamp"),
    )
    return B.ratings(spark, d), movies, tags


_TAGS = f"SELECT item_id, event_type || CAST(CAST(user_id AS INTEGER) % 4 AS VARCHAR) AS tag FROM ({B.RAW})"
_LIKES = f"""SELECT 'ml_user_' || userId AS user_id, 'ml_item_' || movieId AS item_id,
 CASE WHEN rating > -1 AND rating <= 4.0 THEN 'view' WHEN rating > 4.0 AND rating <= 5.1 THEN 'like' END AS event_type,
 to_timestamp(ts) AS "timestamp" FROM ({B.RATINGS})"""


@query(
    "read_ratings",
    f"SELECT {_SQL_SUMMARY} FROM ({_LIKES}) GROUP BY event_type",
)
def _(spark, d):
    """Round trip through CSV files."""
    base = scratch_path(spark, "ratings")
    for name, df in zip(("ratings", "movies", "tags"), _rated(spark, d)):
        df.write.option("header", True).csv(f"{base}/{name}.csv")
    return _summary(T.read_ratings(spark, base).interactions)


def _retail(spark, d):
    o = B.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    li = B.table(spark, d, "lineitem")
    tx = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.to_date("l_shipdate").alias("t_dat"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.lpad(F.col("l_partkey").cast("string"), 10, "0").alias("article_id"),
        (F.col("l_extendedprice") / 1000).alias("price"),
        F.lit(1).alias("sales_channel_id"),
    )
    p = B.table(spark, d, "part")
    articles = p.select(
        F.lpad(F.col("p_partkey").cast("string"), 10, "0").alias("article_id"),
        F.col("p_name").alias("prod_name"),
        F.col("p_type").alias("product_type_name"),
        F.col("p_brand").alias("product_group_name"),
        F.concat(F.lit("size "), F.col("p_size")).alias("graphical_appearance_name"),
        F.element_at(F.split("p_name", " "), 1).alias("colour_group_name"),
        F.lit("Index").alias("index_group_name"),
        F.when(F.col("p_size") > 10, "Section").alias("section_name"),
        F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("a "), F.col("p_name"))).otherwise("").alias("detail_desc"),
    )
    c = B.table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.when(F.col("c_nationkey") > 4, F.col("c_nationkey").cast("string")).alias("postal_code"),
        F.col("c_mktsegment").alias("club_member_status"),
    )
    return tx, articles, c


_TX = """SELECT 'hm_user_' || o_custkey AS user_id, 'hm_item_' || l_partkey AS item_id,
 'purchase' AS event_type, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS "timestamp"
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@query("read_retail", f"SELECT {_SQL_SUMMARY} FROM ({_TX}) GROUP BY event_type")
def _(spark, d):
    base = scratch_path(spark, "retail")
    for name, df in zip(("transactions_train", "articles", "customers"), _retail(spark, d)):
        df.write.option("header", True).csv(f"{base}/{name}.csv")
    return _summary(T.read_retail(spark, base).interactions)


def _foreign(spark, d):
    return B.raw_interactions(spark, d).select(
        F.col("user_id").alias("client_no"),
        F.col("item_id").alias("article_no"),
        F.col("event_type").alias("behaviour"),
        F.col("timestamp").alias("datetime"),
        F.when(F.col("user_id").cast("int") % 3 > 0, F.concat(F.lit("t"), F.col("event_type"))).alias("topic"),
    )


_KNOWN_WORDS = "CASE WHEN lower(event_type) IN ('click', 'like', 'purchase') THEN lower(event_type) WHEN lower(event_type) = 'buy' THEN 'purchase' ELSE 'view' END"


@query(
    "map_columns_by_hint",
    f"""SELECT {_SQL_SUMMARY} FROM (SELECT user_id, item_id, {_KNOWN_WORDS} AS event_type, "timestamp" FROM ({B.RAW}))
 GROUP BY event_type""",
)
def _(spark, d):
    return _summary(T.map_columns_by_hint(_foreign(spark, d)).interactions)


@query(
    "map_columns_by_hint_items",
    f"""SELECT item_id, NULL::VARCHAR AS title, NULL::VARCHAR AS category,
 first(topic ORDER BY "timestamp", user_id, event_type) FILTER (WHERE topic IS NOT NULL) AS tags, NULL::VARCHAR AS text_description
 FROM (SELECT *, CASE WHEN CAST(user_id AS INTEGER) % 3 > 0 THEN 't' || event_type END AS topic FROM ({B.RAW})) GROUP BY item_id""",
)
def _(spark, d):
    return T.map_columns_by_hint(
        _foreign(spark, d), order_by=["datetime", "client_no", "behaviour"]
    ).items


@query(
    "cap_rows_at_read",
    f"""SELECT userId, movieId, round(rating, 6) AS rating, ts FROM ({B.RATINGS})
 ORDER BY ts, userId, movieId, rating LIMIT 5000""",
)
def _(spark, d):
    rows = B.ratings(spark, d).withColumnRenamed("timestamp", "ts")
    capped = T.cap_rows(rows, 5000, ["ts", "userId", "movieId", "rating"])
    return capped.withColumn("rating", F.round("rating", 6))


@query(
    "cap_rows_large_head",
    f"""SELECT user_id, item_id, event_type, {_SQL_US} FROM (
 SELECT * FROM ({B.PURCHASES}) ORDER BY "timestamp", user_id, item_id, event_type LIMIT 20000)""",
)
def _(spark, d):
    """A head too long for one task: ranked over range partitions."""
    rows = T.cap_rows(B.purchases(spark, d), 20000, ["timestamp", "user_id", "item_id", "event_type"])
    return rows.select("user_id", "item_id", "event_type", _us())


@query(
    "rating_to_event",
    """SELECT l_orderkey, l_linenumber, CASE WHEN r > -1 AND r <= 4.0 THEN 'view'
 WHEN r > 4.0 AND r <= 5.1 THEN 'like' END AS event_type FROM (SELECT *, l_quantity / 9 AS r FROM lineitem)""",
)
def _(spark, d):
    return B.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", rating_to_event(F.col("l_quantity") / 9).alias("event_type")
    )


@query(
    "text_to_event",
    f"SELECT event_id, {_KNOWN_WORDS} AS kind FROM (SELECT event_id, upper(event_type) AS event_type FROM events)",
)
def _(spark, d):
    return B.table(spark, d, "events").select(
        "event_id", text_to_event(F.upper("event_type")).alias("kind")
    )


@query(
    "numeric_to_event",
    "SELECT event_id, CASE WHEN value > -1 AND value <= 4.0 THEN 'view' WHEN value > 4.0 AND value <= 1e18 THEN 'like' END AS kind FROM events",
)
def _(spark, d):
    return B.table(spark, d, "events").select(
        "event_id", rating_to_event("value", 4.0, T.NUMERIC_EVENT_MAX).alias("kind")
    )


@query(
    "namespace_ids",
    """SELECT 'ml_user_' || c_custkey AS ml_id, 'hm_item_' || c_custkey AS hm_id,
 'hm_user_' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS hm_user FROM customer""",
)
def _(spark, d):
    padded = F.lpad(F.col("c_custkey").cast("string"), 10, "0")
    return B.table(spark, d, "customer").select(
        namespaced_id("ml_user_", padded).alias("ml_id"),
        namespaced_id("hm_item_", padded).alias("hm_id"),
        namespaced_id("hm_user_", padded, numeric=False).alias("hm_user"),
    )


_TOP_TAGS = f"""SELECT item_id, string_agg(tag, ' ' ORDER BY cnt DESC, tag) AS user_tags FROM (
 SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY cnt DESC, tag) AS rn
 FROM (SELECT item_id, tag, count(*) AS cnt FROM ({_TAGS}) GROUP BY item_id, tag)) WHERE rn <= 8 GROUP BY item_id"""


def _item_tags(spark, d):
    tags = _rated(spark, d)[2]
    return tags.select(F.col("movieId").cast("string").alias("item_id"), "tag")


@query("top_tags_per_item", _TOP_TAGS)
def _(spark, d):
    return I.top_tags_per_item(_item_tags(spark, d))


@query(
    "assemble_rated_items",
    f"""SELECT item_id, title, category, genre_list AS tags, user_tags,
 concat_ws(' ', title, genre_text, user_tags) AS text_description FROM (
 SELECT item_id, title, category, category || ', ' || tags AS genre_list, category || ' ' || tags AS genre_text
 FROM ({B.ITEMS})) LEFT JOIN ({_TOP_TAGS}) USING (item_id)""",
)
def _(spark, d):
    movies = _rated(spark, d)[1].withColumn("item_id", F.col("movieId").cast("string"))
    return I.assemble_rated_items(movies, I.top_tags_per_item(_item_tags(spark, d)))


@query(
    "assemble_retail_items",
    """SELECT 'hm_item_' || p_partkey AS item_id, p_name AS title, p_type AS category,
 p_brand || ', size ' || p_size AS tags,
 concat_ws(' ', p_name, p_type, 'Index', CASE WHEN p_size > 10 THEN 'Section' END, 'size ' || p_size,
 split_part(p_name, ' ', 1), CASE WHEN p_size % 2 = 0 THEN 'a ' || p_name END) AS text_description FROM part""",
)
def _(spark, d):
    return T.retail_dataset(*_retail(spark, d)).items


@query(
    "pack_metadata_json",
    """SELECT 'hm_user_' || c_custkey AS user_id,
 '{"postal_code":' || CASE WHEN c_nationkey > 4 THEN '"' || c_nationkey || '"' ELSE 'null' END
 || ',"club_member_status":"' || c_mktsegment || '"}' AS metadata FROM customer""",
)
def _(spark, d):
    return T.retail_dataset(*_retail(spark, d)).users


@query("distinct_users", f"SELECT DISTINCT user_id FROM ({B.PURCHASES})")
def _(spark, d):
    return I.distinct_entities(B.purchases(spark, d), "user_id")


@query("distinct_items", f"SELECT DISTINCT item_id FROM ({B.PURCHASES})")
def _(spark, d):
    return I.distinct_entities(B.purchases(spark, d), "item_id")


@query(
    "first_attributes_per_item",
    """SELECT json_extract_string(props, '$.k') AS item_id,
 first(event_type ORDER BY ts, event_id) AS title,
 first(event_type ORDER BY ts, event_id) FILTER (WHERE value > 50) AS tags FROM events GROUP BY 1""",
)
def _(spark, d):
    e = B.table(spark, d, "events").select(
        F.get_json_object("props", "$.k").alias("k"),
        "ts",
        "event_id",
        "event_type",
        F.when(F.col("value") > 50, F.col("event_type")).alias("loud"),
    )
    return I.first_attributes_per_item(
        e, "k", {"title": "event_type", "tags": "loud"}, ["ts", "event_id"]
    )


@query(
    "profile_dataset",
    f"""SELECT 'events:' || event_type AS metric, count(*) AS value FROM ({B.PURCHASES}) GROUP BY event_type
 UNION ALL SELECT 'n_items', count(*) FROM part UNION ALL SELECT 'n_users', count(*) FROM customer""",
)
def _(spark, d):
    return I.profile_dataset(B.purchases(spark, d), B.items(spark, d), B.users(spark, d))


_GLOBAL = f"""SELECT *, CASE WHEN rn < CAST(floor(n * 0.7::DOUBLE) AS BIGINT) THEN 'train'
 WHEN rn < CAST(floor(n * 0.7::DOUBLE) AS BIGINT) + CAST(floor(n * 0.1::DOUBLE) AS BIGINT) THEN 'validation' ELSE 'test' END AS split
 FROM (SELECT *, row_number() OVER (ORDER BY "timestamp", user_id, item_id, event_type) - 1 AS rn, count(*) OVER () AS n FROM ({{src}}))"""
_DEDUPED = f"SELECT DISTINCT * FROM ({B.PURCHASES})"


@query(
    "write_splits",
    f"SELECT split, {_SQL_SUMMARY} FROM ({_GLOBAL.format(src=B.VALID)}) GROUP BY split, event_type",
)
def _(spark, d):
    """Write partitioned by split, read each split back."""
    out = scratch_path(spark, "processed")
    split = S.split_time_global(B.interactions(spark, d))
    T.write_splits(split, B.items(spark, d), B.users(spark, d).select("user_id"), out)
    back = T.load_processed(spark, out)
    parts = [
        _summary(back[s]).select(F.lit(s).alias("split"), "*") for s in S.SPLITS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "load_processed",
    f"SELECT user_id, item_id, event_type, {_SQL_US} FROM ({_GLOBAL.format(src=B.VALID)}) WHERE split = 'test'",
)
def _(spark, d):
    out = scratch_path(spark, "processed")
    split = S.split_time_global(B.interactions(spark, d))
    T.write_splits(split, B.items(spark, d), B.users(spark, d).select("user_id"), out)
    return T.load_processed(spark, out, ["test"])["test"].select(
        "user_id", "item_id", "event_type", _us()
    )


@query(
    "dataset_manifest",
    f"""SELECT 'events-1' AS dataset_version, count(*) AS row_count,
 count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'validation') AS validation,
 count(*) FILTER (WHERE split = 'test') AS test, 'user_id,item_id,event_type,timestamp' AS fields
 FROM ({_GLOBAL.format(src=B.VALID)})""",
)
def _(spark, d):
    split = S.split_time_global(B.interactions(spark, d))
    m = T.dataset_manifest(split, B.items(spark, d), B.users(spark, d), "events", "1", "local")
    return m.select(
        "dataset.dataset_version",
        "dataset.row_count",
        "splits.train",
        "splits.validation",
        "splits.test",
        F.array_join("schema_fields.interactions", ",").alias("fields"),
    )


@query("file_checksums")
def _(spark, d):
    """Hash of every data file of every table."""
    return T.file_checksums(spark, d)


@query(
    "split_summary",
    f"""SELECT split, count(*) AS rows, count(DISTINCT user_id) AS users,
 CAST(min(epoch_us("timestamp")) AS BIGINT) AS min_us, CAST(max(epoch_us("timestamp")) AS BIGINT) AS max_us
 FROM ({_GLOBAL.format(src=_DEDUPED)}) GROUP BY split""",
)
def _(spark, d):
    rows = materialize(V.dedupe_interactions(B.purchases(spark, d)))
    out = S.split_summary(S.split_time_global(rows))
    return out.select("split", "rows", "users", _us("min_time", "min_us"), _us("max_time", "max_us"))


@query(
    "sample_rows",
    f"""SELECT user_id, item_id, event_type, CAST(epoch_us("timestamp") AS BIGINT) AS ts_us FROM ({B.VALID})
 ORDER BY md5(concat_ws('|', '42', user_id, item_id, CAST(epoch_us("timestamp") AS VARCHAR))) LIMIT 100""",
)
def _(spark, d):
    out = I.sample_rows(B.interactions(spark, d), ["user_id", "item_id", "timestamp"], 100)
    return out.select("user_id", "item_id", "event_type", _us())


@query(
    "ingest",
    f"""SELECT split, count(*) AS rows, count(DISTINCT user_id) AS users,
 CAST(min(epoch_us("timestamp")) AS BIGINT) AS min_us, CAST(max(epoch_us("timestamp")) AS BIGINT) AS max_us FROM (
 {_GLOBAL.format(src=f'''SELECT * FROM (SELECT DISTINCT user_id, item_id, event_type, "timestamp" FROM ({_LIKES}) WHERE event_type IS NOT NULL)
 QUALIFY count(*) OVER (PARTITION BY user_id) >= 40''')}) GROUP BY split""",
)
def _(spark, d):
    """CSV files in, partitioned parquet and a manifest out."""
    base, out = scratch_path(spark, "ratings"), scratch_path(spark, "dataset")
    for name, df in zip(("ratings", "movies", "tags"), _rated(spark, d)):
        df.write.option("header", True).csv(f"{base}/{name}.csv")
    summary = ingest(spark, "movielens", base, out, min_interactions=40)
    return summary.select("split", "rows", "users", _us("min_time", "min_us"), _us("max_time", "max_us"))


@query(
    "prepare_per_user",
    f"""SELECT split, count(*) AS rows, count(DISTINCT user_id) AS users FROM (
 SELECT *, CASE WHEN rn < t_end THEN 'train' WHEN rn < t_end + greatest(1, CAST(floor(n * 0.1::DOUBLE) AS BIGINT)) THEN 'validation' ELSE 'test' END AS split
 FROM (SELECT *, greatest(1, CAST(floor(n * 0.7::DOUBLE) AS BIGINT)) AS t_end FROM (
 SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", item_id, event_type) - 1 AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM ({_DEDUPED}))
 WHERE n >= 2)) GROUP BY split""",
)
def _(spark, d):
    data = T.Dataset(B.purchases(spark, d), B.items(spark, d), B.users(spark, d))
    split, _items, _users = prepare(data, split_mode="per_user")
    return split.groupBy("split").agg(
        F.count("*").alias("rows"), F.count_distinct("user_id").alias("users")
    )


# Validation


@query(
    "validate_schema_nulls",
    f"""SELECT 'item_id' AS "column", count(*) - count(item_id) AS nulls FROM ({B.ITEMS})
 UNION ALL SELECT 'category', count(*) - count(category) FROM ({B.ITEMS})
 UNION ALL SELECT 'text_description', count(*) - count(text_description) FROM ({B.ITEMS})""",
)
def _(spark, d):
    return V.null_counts(B.items(spark, d), ["item_id", "category", "text_description"])


@query(
    "validate_interactions",
    f"SELECT DISTINCT user_id, item_id, event_type, {_SQL_US} FROM ({B.VALID})",
)
def _(spark, d):
    return V.validate_interactions(B.raw_interactions(spark, d)).select(
        "user_id", "item_id", "event_type", _us()
    )


@query(
    "normalize_timestamp",
    """SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) * 1000000 AS from_seconds,
 CAST(epoch_us(ts) AS BIGINT) // 1000 * 1000 AS from_mixed, CAST(epoch_us(ts) AS BIGINT) AS from_text FROM events""",
)
def _(spark, d):
    e = B.table(spark, d, "events").withColumn("t", F.col("ts").cast("timestamp"))
    # Even ids come as milliseconds, odd ones as seconds with the milliseconds added back.
    millis, secs = F.unix_millis("t"), F.unix_seconds("t")
    mixed = F.when(F.col("event_id") % 2 == 0, millis).otherwise(secs)
    lost = F.when(F.col("event_id") % 2 == 0, F.lit(0)).otherwise(millis - secs * 1000)
    return e.select(
        "event_id",
        F.unix_micros(epoch_to_timestamp(secs)).alias("from_seconds"),
        (F.unix_micros(epoch_to_timestamp(mixed)) + lost * 1000).alias("from_mixed"),
        F.unix_micros(F.col("ts").cast("string").cast("timestamp")).alias("from_text"),
    )


@query(
    "dedupe_interactions",
    f"SELECT user_id, item_id, event_type, {_SQL_US} FROM ({_DEDUPED})",
)
def _(spark, d):
    p = B.purchases(spark, d)
    return V.dedupe_interactions(p.unionByName(p)).select("user_id", "item_id", "event_type", _us())


_ITEM_TEXT = "concat_ws(' ', title, category, tags)"


@query(
    "validate_items",
    f"""SELECT item_id, title, category, tags, coalesce(text_description, {_ITEM_TEXT}) AS text_description
 FROM ({B.ITEMS})""",
)
def _(spark, d):
    return V.validate_items(B.items(spark, d))


@query(
    "item_text",
    f"""SELECT item_id, {_ITEM_TEXT} AS text3, concat_ws(' ', title, category, tags, text_description) AS text4
 FROM ({B.ITEMS})""",
)
def _(spark, d):
    padded = B.items(spark, d).withColumn("title", F.concat(F.lit("  "), "title", F.lit(" ")))
    return padded.select(
        "item_id", item_text().alias("text3"), item_text(ITEM_TEXT_FIELDS).alias("text4")
    )


@query(
    "validate_users",
    f"""SELECT user_id, first(event_type ORDER BY "timestamp", item_id, event_type) AS metadata
 FROM ({B.PURCHASES}) GROUP BY user_id""",
)
def _(spark, d):
    rows = B.purchases(spark, d).withColumn("metadata", F.col("event_type"))
    return V.validate_users(rows, ["timestamp", "item_id", "event_type"])


@query("event_weight", f"SELECT event_id, {B.WEIGHT} AS weight FROM events")
def _(spark, d):
    return B.table(spark, d, "events").select("event_id", event_weight("event_type").alias("weight"))


@query(
    "recency_weight",
    f"""SELECT user_id, item_id, event_type, {_SQL_US},
 round(exp(-0.035 * least(greatest(0, (epoch_us(ref) - epoch_us("timestamp")) / 1e6::DOUBLE / 86400.0), 365.0)), 9) AS w
 FROM ({B.VALID}), (SELECT max("timestamp") AS ref FROM ({B.VALID}))""",
)
def _(spark, d):
    return V.apply_recency(B.interactions(spark, d), name="w").select(
        "user_id", "item_id", "event_type", _us(), F.round("w", 9).alias("w")
    )


@query(
    "filter_low_activity_users",
    f"""SELECT user_id, item_id, event_type, {_SQL_US} FROM ({B.PURCHASES})
 QUALIFY count(*) OVER (PARTITION BY user_id) >= 40""",
)
def _(spark, d):
    return V.filter_low_activity_users(B.purchases(spark, d), 40).select(
        "user_id", "item_id", "event_type", _us()
    )


@query(
    "trim_head",
    f"""SELECT user_id, item_id, event_type, {_SQL_US} FROM (
 SELECT * FROM ({B.VALID}) ORDER BY "timestamp", user_id, item_id, event_type LIMIT 700)""",
)
def _(spark, d):
    return V.trim_to_max_rows(B.interactions(spark, d), 700, "head").select(
        "user_id", "item_id", "event_type", _us()
    )


@query(
    "trim_strided",
    f"""SELECT user_id, item_id, event_type, {_SQL_US} FROM (
 SELECT *, row_number() OVER (ORDER BY "timestamp", user_id, item_id, event_type) - 1 AS rn FROM ({_DEDUPED}))
 WHERE rn IN (SELECT CAST(round_even(j * ((n - 1)::DOUBLE / 1699), 0) AS BIGINT)
 FROM (SELECT count(*) AS n FROM ({_DEDUPED})), range(1700) r(j))""",
)
def _(spark, d):
    rows = materialize(V.dedupe_interactions(B.purchases(spark, d)))
    return V.trim_to_max_rows(rows, 1700).select("user_id", "item_id", "event_type", _us())


# Splits


@query(
    "split_time_global",
    f"SELECT user_id, item_id, event_type, {_SQL_US}, split FROM ({_GLOBAL.format(src=_DEDUPED)})",
)
def _(spark, d):
    rows = materialize(V.dedupe_interactions(B.purchases(spark, d)))
    return S.split_time_global(rows).select("user_id", "item_id", "event_type", _us(), "split")


@query(
    "split_thresholds",
    f"""SELECT split, CAST(max(epoch_us("timestamp")) AS BIGINT) AS max_us,
 CASE split WHEN 'train' THEN 0.7 WHEN 'validation' THEN 0.1 ELSE 0.2 END::DOUBLE AS ratio
 FROM ({_GLOBAL.format(src=B.VALID)}) GROUP BY split""",
)
def _(spark, d):
    out = S.split_thresholds(S.split_time_global(B.interactions(spark, d)))
    return out.select("split", _us("max_time", "max_us"), "ratio")


@query(
    "split_per_user",
    f"""SELECT user_id, item_id, event_type, {_SQL_US}, CASE WHEN n < 3 OR rn < t_end THEN 'train'
 WHEN rn < t_end + greatest(1, CAST(floor(n * 0.1::DOUBLE) AS BIGINT)) THEN 'validation' ELSE 'test' END AS split
 FROM (SELECT *, greatest(1, CAST(floor(n * 0.7::DOUBLE) AS BIGINT)) AS t_end FROM (
 SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", item_id, event_type) - 1 AS rn,
 count(*) OVER (PARTITION BY user_id) AS n FROM ({_DEDUPED})))""",
)
def _(spark, d):
    rows = V.dedupe_interactions(B.purchases(spark, d))
    return S.split_per_user(rows, 3).select("user_id", "item_id", "event_type", _us(), "split")
