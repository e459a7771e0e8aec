"""Models, retrieval and embeddings over the bound tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tastemill.functions.hashing import point_id
from tastemill.functions.vectors import l2_normalize
from tastemill.operators import models as M
from tastemill.operators import retrieval as R
from tastemill.operators import vector_index as V
from tastemill.plans import bindings as B
from tastemill.plans.registry import query
from tastemill.plans.serve import embed_items
from tastemill.plans.train import als_recommend
from tastemill.schemas import DEFAULTS
from tastemill.session import materialize, scratch_path
from tastemill.sources.tables import read_vectors, write_vectors
from tastemill.sources.vector_table import VectorTable, bucket_of

ALS_SETTINGS = DEFAULTS


def _norm(v: str) -> str:
    return f"sqrt(list_dot_product({v}, {v}))"


def _unit(v: str) -> str:
    """A vector over its length; ``v`` is a DOUBLE[] column."""
    return f"list_transform({v}, lambda x: x / greatest({_norm(v)}, 1e-12))"


@query(
    "index_ids",
    f"""SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx
 FROM (SELECT DISTINCT user_id FROM ({B.PURCHASES}))""",
)
def _(spark, d):
    return M.index_ids(B.purchases(spark, d), "user_id", "user_idx")


MATRIX = f"SELECT user_id, item_id, sum({B.WEIGHT}) AS r FROM ({{src}}) GROUP BY user_id, item_id"


@query("implicit_matrix", MATRIX.format(src=B.PURCHASES))
def _(spark, d):
    return M.implicit_matrix(B.purchases(spark, d))


@query(
    "confidence",
    f"SELECT user_id, item_id, r, 1 + 5.0::DOUBLE * r AS confidence FROM ({MATRIX.format(src=B.VALID)})",
)
def _(spark, d):
    return M.confidence(M.implicit_matrix(B.interactions(spark, d)), 5.0)


POP = f"SELECT item_id, sum({B.WEIGHT}) AS score FROM ({{src}}) GROUP BY item_id"


@query("popularity", POP.format(src=B.PURCHASES))
def _(spark, d):
    return M.popularity(B.purchases(spark, d))


@query(
    "popularity_recency",
    f"""SELECT item_id, round(sum({B.WEIGHT} * exp(-0.035 * least(greatest(0,
 (epoch_us(ref) - epoch_us("timestamp")) / 1e6::DOUBLE / 86400.0), 365.0))), 6) AS score
 FROM ({B.VALID}), (SELECT max("timestamp") AS ref FROM ({B.VALID})) GROUP BY item_id""",
)
def _(spark, d):
    out = M.popularity(B.interactions(spark, d), recency=True)
    return out.withColumn("score", F.round("score", 6))


@query(
    "popular_items",
    f"""SELECT item_id, score, title, category FROM (SELECT * FROM ({POP.format(src=B.VALID)})
 ORDER BY score DESC, item_id LIMIT 20) JOIN ({B.ITEMS}) USING (item_id)""",
)
def _(spark, d):
    return M.popular_items(M.popularity(B.interactions(spark, d)), B.items(spark, d), 20)


@query(
    "popular_purchases",
    f"""SELECT item_id, score, title, category FROM (SELECT * FROM ({POP.format(src=B.PURCHASES)})
 ORDER BY score DESC, item_id LIMIT 20) JOIN ({B.ITEMS}) USING (item_id)""",
)
def _(spark, d):
    return M.popular_items(M.popularity(B.purchases(spark, d)), B.items(spark, d), 20)


@query(
    "top_k_from_scores",
    f"SELECT * FROM ({POP.format(src=B.PURCHASES)}) ORDER BY score DESC, item_id LIMIT 50",
)
def _(spark, d):
    return M.top_from_scores(M.popularity(B.purchases(spark, d)), 50)


def _fitted(spark, d):
    matrix = materialize(M.implicit_matrix(B.train(spark, d)), "matrix")
    model, users, items = M.fit_als(matrix, ALS_SETTINGS)
    return M.als_factors(model, users, items)


@query("fit_als")
def _(spark, d):
    """User and item factors of the training events."""
    u, i = _fitted(spark, d)
    return u.select(F.lit("user").alias("side"), F.col("user_id").alias("id"), "vector").unionByName(
        i.select(F.lit("item").alias("side"), F.col("item_id").alias("id"), "vector")
    )


@query("als_recommend")
def _(spark, d):
    u, i = _fitted(spark, d)
    train = B.train(spark, d)
    return als_recommend(u, i, train.select("user_id").distinct(), R.seen_items(train, i), 10)


@query(
    "als_lists",
    f"""WITH seen AS (SELECT DISTINCT user_id, item_id FROM ({B.TRAIN})), n AS (SELECT count(DISTINCT item_id) AS n FROM seen)
 SELECT user_id, least(10, n - count(*)) AS n_items, 0::BIGINT AS n_seen, 0::BIGINT AS out_of_order FROM seen, n GROUP BY user_id, n
 HAVING n > count(*)""",
)
def _(spark, d):
    """What every list of the factor model keeps to: ten unseen items (or all there are), best first."""
    u, i = _fitted(spark, d)
    train = B.train(spark, d)
    seen = R.seen_items(train, i)
    recs = materialize(als_recommend(u, i, train.select("user_id").distinct(), seen, 10), "als-lists")
    before = F.lag("score").over(Window.partitionBy("user_id").orderBy("rank"))
    marked = recs.withColumn("late", (before < F.col("score")).cast("int")).join(seen.withColumn("gone", F.lit(1)), ["user_id", "item_id"], "left")
    return marked.groupBy("user_id").agg(
        F.countDistinct("item_id").alias("n_items"),
        F.coalesce(F.sum("gone"), F.lit(0)).alias("n_seen"),
        F.coalesce(F.sum("late"), F.lit(0)).alias("out_of_order"),
    )


def _negatives(spark, d):
    pos = B.train(spark, d).withColumn(
        "pos_id", F.xxhash64("user_id", "item_id", "event_type", "timestamp")
    ).select("pos_id", "user_id", "item_id")
    index = M.index_ids(B.vectors(spark, d), "item_id", "item_idx")
    return pos, M.sample_negatives(pos, index, 4)


@query("sample_negatives")
def _(spark, d):
    """Four unseen items per training event."""
    return _negatives(spark, d)[1]


@query(
    "sample_negatives_kept_rules",
    f"""SELECT user_id, count(*) AS positives, 4 * count(*) AS negatives, 0::BIGINT AS repeats, 0::BIGINT AS seen, 0::BIGINT AS unknown_items
 FROM ({B.TRAIN}) GROUP BY user_id""",
)
def _(spark, d):
    """Per user: draws there are, draws that repeat within a positive, seen ones, and items that don't exist."""
    pos, out = _negatives(spark, d)
    out = materialize(out, "negatives")
    per = out.groupBy("user_id", "pos_id").agg((F.count("*") - F.countDistinct("item_id")).alias("r"), F.count("*").alias("n"))
    per = per.groupBy("user_id").agg(F.sum("n").alias("negatives"), F.sum("r").alias("repeats"))
    bad = out.join(pos.select("user_id", "item_id").distinct(), ["user_id", "item_id"], "left_semi").groupBy("user_id").agg(F.count("*").alias("seen"))
    strange = out.join(B.vectors(spark, d), "item_id", "left_anti").groupBy("user_id").agg(F.count("*").alias("unknown_items"))
    all_of = pos.groupBy("user_id").agg(F.count("*").alias("positives"))
    return all_of.join(per, "user_id", "left").join(bad, "user_id", "left").join(strange, "user_id", "left").fillna(0)


USER_VECTORS = f"""SELECT user_id, list(x ORDER BY pos) AS vector FROM (
 SELECT user_id, pos, sum(w * x) / sum(w) AS x FROM (
 SELECT user_id, w, unnest(vector) AS x, generate_subscripts(vector, 1) AS pos
 FROM (SELECT user_id, item_id, {B.WEIGHT} AS w FROM ({{src}})) JOIN ({B.VECTORS}) USING (item_id))
 GROUP BY user_id, pos) GROUP BY user_id"""


def user_vectors(spark, d):
    return M.user_embedding(B.train(spark, d), B.vectors(spark, d), B.DIM)


def long_vectors(df, key: str):
    """One rounded row per vector element."""
    return df.select(key, F.posexplode("vector").alias("pos", "x")).select(
        key, "pos", F.round("x", 6).alias("x")
    )


def long_sql(src: str, key: str) -> str:
    return f"""SELECT {key}, CAST(generate_subscripts(vector, 1) - 1 AS INTEGER) AS pos,
 round(unnest(vector), 6) AS x FROM ({src})"""


@query("user_embedding", long_sql(USER_VECTORS.format(src=B.TRAIN), "user_id"))
def _(spark, d):
    return long_vectors(user_vectors(spark, d), "user_id")


@query("l2_normalize", long_sql(f"SELECT item_id, {_unit('vector')} AS vector FROM ({B.VECTORS})", "item_id"))
def _(spark, d):
    unit = B.vectors(spark, d).select("item_id", l2_normalize(F.col("vector")).alias("vector"))
    return long_vectors(unit, "item_id")


_NEG = "SELECT pos_id, user_id, ((CAST(item_id AS INTEGER) * 7 + 13 * j) % 100)::VARCHAR AS item_id FROM pos, (VALUES (1), (2), (3)) n(j)"


@query(
    "contrastive_loss",
    f"""WITH uv AS ({USER_VECTORS.format(src=B.TRAIN)}), pos AS (SELECT CAST(event_id AS BIGINT) AS pos_id,
 CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS item_id FROM events
 WHERE event_type IN ('view', 'click', 'like', 'purchase') AND ts < TIMESTAMP '{B.CUT}'),
 pairs AS (SELECT *, true AS p FROM pos UNION ALL SELECT *, false FROM ({_NEG})),
 s AS (SELECT pos_id, p, list_dot_product(uv.vector, iv.vector) AS s FROM pairs JOIN uv USING (user_id) JOIN ({B.VECTORS}) iv USING (item_id))
 SELECT round(avg(ln(e) - sp), 6) AS loss, count(*) AS n FROM (
 SELECT pos_id, sum(exp(s)) AS e, max(s) FILTER (WHERE p) AS sp FROM s GROUP BY pos_id)""",
)
def _(spark, d):
    """Loss of the training events against three fixed negatives each."""
    pos = (
        B.table(spark, d, "events")
        .where(F.col("event_type").isin("view", "click", "like", "purchase"))
        .where(F.col("ts").cast("timestamp") < F.lit(B.CUT).cast("timestamp"))
        .select(
            F.col("event_id").alias("pos_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.get_json_object("props", "$.k").alias("item_id"),
        )
    )
    step = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))
    neg = pos.withColumn("j", step).select(
        "pos_id",
        "user_id",
        ((F.col("item_id").cast("int") * 7 + F.col("j") * 13) % 100).cast("string").alias("item_id"),
    )
    out = M.contrastive_loss(pos, neg, user_vectors(spark, d), B.vectors(spark, d))
    return out.withColumn("loss", F.round("loss", 6))


def _cos(a: str, b: str) -> str:
    return f"list_dot_product({a}, {b})"


def top_k_sql(users: str, k: int, seen: str | None = None, mode: str = "sentinel") -> str:
    """Exact cosine top-k of user vectors over the item vectors."""
    score = f"round({_cos('u.vector', 'i.vector')}, 9)"
    join = ""
    if seen:
        join = f" LEFT JOIN (SELECT user_id, item_id, true AS gone FROM ({seen})) s USING (user_id, item_id)"
        score = f"CASE WHEN gone THEN -1 ELSE {score} END"
    keep = " WHERE gone IS NULL" if seen and mode == "drop" else ""
    return f"""SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM (
 SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM (
 SELECT user_id, item_id, {score} AS score FROM (SELECT user_id, {_unit('vector')} AS vector FROM ({users})) u
 CROSS JOIN (SELECT item_id, {_unit('vector')} AS vector FROM ({B.VECTORS})) i{join}{keep})) WHERE rank <= {k}"""


SEEN = f"SELECT DISTINCT user_id, item_id FROM ({B.TRAIN}) WHERE item_id IN (SELECT CAST(vec_id AS VARCHAR) FROM embeddings)"


def _as_users(hits):
    return hits.select(
        F.col("query_id").alias("user_id"), "item_id", "rank", F.round("score", 6).alias("score")
    )


def _queries(spark, d):
    return user_vectors(spark, d).withColumnRenamed("user_id", "query_id")


def _seen(spark, d):
    return R.seen_items(B.train(spark, d), B.vectors(spark, d)).withColumnRenamed(
        "user_id", "query_id"
    )


@query("retrieve_top_k", top_k_sql(USER_VECTORS.format(src=B.TRAIN), 20, SEEN))
def _(spark, d):
    """Seen items score -1."""
    return _as_users(R.retrieve_top_k(_queries(spark, d), B.vectors(spark, d), 20, _seen(spark, d)))


@query("retrieve_top_k_drop_seen", top_k_sql(USER_VECTORS.format(src=B.TRAIN), 20, SEEN, "drop"))
def _(spark, d):
    return _as_users(
        R.retrieve_top_k(_queries(spark, d), B.vectors(spark, d), 20, _seen(spark, d), "drop")
    )


@query(
    "batch_recommend",
    f"""WITH hits AS ({top_k_sql(USER_VECTORS.format(src=B.TRAIN), 10)}),
 asked AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer)
 SELECT user_id, rank IS NOT NULL AS known_user, coalesce(rank, 0) AS rank, coalesce(item_id, '') AS item_id,
 coalesce(score, 0) AS score FROM asked LEFT JOIN hits USING (user_id)""",
)
def _(spark, d):
    """Every customer asks; those without training events are unknown."""
    asked = B.users(spark, d).select("user_id")
    out = R.batch_recommend(asked, user_vectors(spark, d), B.vectors(spark, d), 10)
    return out.withColumn("score", F.round("score", 6)).fillna({"rank": 0, "item_id": "", "score": 0.0})


@query("seen_items", SEEN)
def _(spark, d):
    return R.seen_items(B.train(spark, d), B.vectors(spark, d))


@query(
    "enrich_with_catalog",
    f"""SELECT user_id, item_id, r, title, category FROM ({MATRIX.format(src=B.PURCHASES)})
 JOIN (SELECT * FROM ({B.ITEMS}) WHERE category <> 'War') USING (item_id)""",
)
def _(spark, d):
    known = B.items(spark, d).where(F.col("category") != "War")
    return R.enrich_with_catalog(M.implicit_matrix(B.purchases(spark, d)), known)


@query("embed_items")
def _(spark, d):
    return embed_items(B.items(spark, d))


@query(
    "mean_pool",
    long_sql(
        f"""SELECT text_id, {_unit('vector')} AS vector FROM (SELECT text_id, list(x ORDER BY pos) AS vector FROM (
 SELECT text_id, pos, coalesce(avg(x) FILTER (WHERE mask), 0) AS x FROM (SELECT label AS text_id, vec_id % 3 > 0 AS mask,
 unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY text_id, pos) GROUP BY text_id)""",
        "text_id",
    ),
)
def _(spark, d):
    tokens = B.table(spark, d, "embeddings").select(
        F.col("label").alias("text_id"),
        F.col("embedding").alias("vector"),
        (F.col("vec_id") % 3 > 0).cast("int").alias("mask"),
    )
    return long_vectors(M.mean_pool(tokens, B.DIM), "text_id")


_SELF = f"SELECT item_id AS user_id, vector FROM ({B.VECTORS})"


@query("vector_search", top_k_sql(_SELF, 10).replace("SELECT user_id,", "SELECT user_id AS query_id,", 1))
def _(spark, d):
    """Every vector looks for its nearest ten."""
    v = B.vectors(spark, d)
    hits = R.vector_search(v.withColumnRenamed("item_id", "query_id"), v, 10)
    return hits.withColumn("score", F.round("score", 6))


_GROUPED = """SELECT CAST(vec_id AS VARCHAR) AS item_id, list_transform(list_zip(CAST(embedding AS DOUBLE[]), range(1, len(embedding) + 1)),
 lambda x: round(x[1], 3) + ((label * 7 + x[2] * 3) % 11 - 5) * 4) AS vector FROM embeddings"""


def _grouped(spark, d):
    """The item vectors, moved apart by label."""
    shift = lambda x, j: F.round(x.cast("double"), 3) + (F.pmod(F.col("label") * 7 + (j + 1) * 3, F.lit(11)) - 5) * 4
    return B.table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("item_id"), F.transform("embedding", shift).alias("vector"))


def _grouped_top(spark, d, cosine: bool):
    v = _grouped(spark, d)
    asked = v.withColumnRenamed("item_id", "query_id")
    return R.block_search(asked, v, 10, cosine=cosine, item_block=32, query_block=32)


_DOT = """SELECT a.item_id AS query_id, b.item_id, round(list_dot_product(a.vector, b.vector), 9) AS score FROM g a CROSS JOIN g b"""


@query(
    "vector_search_pruned",
    top_k_sql(f"SELECT item_id AS user_id, vector FROM ({_GROUPED})", 10).replace(B.VECTORS, _GROUPED).replace("SELECT user_id,", "SELECT user_id AS query_id,", 1),
)
def _(spark, d):
    """Exact cosine search over grouped vectors in small blocks, most of which are skipped."""
    return _grouped_top(spark, d, True)[0].withColumn("score", F.round("score", 6))


@query(
    "inner_product_search_pruned",
    f"""WITH g AS ({_GROUPED}) SELECT query_id, item_id, CAST(rank AS INTEGER) AS rank, round(score, 3) AS score FROM (
 SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM ({_DOT})) WHERE rank <= 10""",
)
def _(spark, d):
    return _grouped_top(spark, d, False)[0].withColumn("score", F.round("score", 3))


@query(
    "search_blocks_skipped",
    "SELECT unnest(['cosine', 'dot']) AS metric, n >= 500 AS many_pairs, true AS most_are_skipped FROM (SELECT count(*) AS n FROM embeddings)",
)
def _(spark, d):
    """Share of block pairs that the two pruned searches score."""
    out = None
    for metric in ("cosine", "dot"):
        share = _grouped_top(spark, d, metric == "cosine")[1]
        row = share.select(F.lit(metric).alias("metric"), (F.col("pairs") > 100).alias("many_pairs"), (F.col("scored") * 2 < F.col("pairs")).alias("most_are_skipped"))
        out = row if out is None else out.unionByName(row)
    return out


@query("approx_vector_search")
def _(spark, d):
    """Every vector looks for its nearest ten, with the settings that the index measured."""
    v = B.vectors(spark, d)
    return V.approx_vector_search(v.withColumnRenamed("item_id", "query_id"), v, 10)


@query(
    "approx_search_recall",
    """SELECT count(*) AS n_queries, true AS recall_reached, true AS under_a_tenth_read, true AS reopened_alike FROM embeddings""",
)
def _(spark, d):
    """All vectors against the exact search: recall at 10 of 0.95 or more, reading less than a tenth of the vectors."""
    v = B.vectors(spark, d)
    asked = v.withColumnRenamed("item_id", "query_id")
    index = V.build_index(v)
    near = materialize(index.search(asked, 10), "near")
    again = V.open_index(spark, index.path).search(asked, 10)
    other = near.exceptAll(again).union(again.exceptAll(near)).agg(F.count("*").alias("n"))
    found = V.recall(near, R.vector_search(asked, v, 10))
    return found.select(
        "n_queries",
        (F.col("recall") >= 0.95).alias("recall_reached"),
        F.lit(index.share_read(10) < 0.1).alias("under_a_tenth_read"),
        (other.scalar() == 0).alias("reopened_alike"),
    )


@query(
    "approx_vector_search_all_cells",
    top_k_sql(_SELF, 10).replace("SELECT user_id,", "SELECT user_id AS query_id,", 1),
)
def _(spark, d):
    """With every cell probed and every item a candidate the approximate search is the exact one."""
    v = B.vectors(spark, d)
    asked = v.withColumnRenamed("item_id", "query_id")
    hits = V.approx_vector_search(asked, v, 10, n_cells=12, n_probe=12, candidates=v.count())
    return hits.withColumn("score", F.round("score", 6))


@query(
    "point_id",
    f"""SELECT item_id, concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), '5' || substr(h, 14, 3),
 printf('%02x', (CAST('0x' || substr(h, 17, 2) AS INTEGER) & 63) | 128) || substr(h, 19, 2), substr(h, 21, 12)) AS point_id
 FROM (SELECT item_id, sha1(unhex('{uuid.NAMESPACE_URL.hex}') || encode('recsys:' || item_id)) AS h FROM ({B.ITEMS}))""",
)
def _(spark, d):
    return B.items(spark, d).select("item_id", point_id(F.col("item_id")).alias("point_id"))


@query(
    "upsert_vectors",
    """SELECT CAST(vec_id AS VARCHAR) AS item_id, CASE WHEN label % 2 = 0 THEN 3 WHEN label = 1 THEN 2 ELSE 1 END AS version,
 round(CASE WHEN label % 2 = 0 THEN embedding[3] WHEN label = 1 THEN embedding[2] ELSE embedding[1] END::DOUBLE, 6) AS head
 FROM embeddings""",
)
def _(spark, d):
    """Two change sets over the stored vectors; replaying the first changes nothing."""
    e = B.table(spark, d, "embeddings")

    def version(rows, n: int):
        item = F.col("vec_id").cast("string")
        return rows.select(
            point_id(item).alias("point_id"),
            item.alias("item_id"),
            F.slice("embedding", n, 2).alias("vector"),
            F.lit(n).alias("version"),
        )

    second = version(e.where("label % 2 = 0 or label = 1"), 2)
    out = R.upsert_vectors(version(e, 1), second)
    out = R.upsert_vectors(out, version(e.where("label % 2 = 0"), 3))
    out = R.upsert_vectors(out, second)
    return out.select("item_id", "version", F.round(F.col("vector")[0].cast("double"), 6).alias("head"))


_VERSIONS = """SELECT CAST(vec_id AS VARCHAR) AS item_id, CAST(CASE WHEN label % 2 = 0 THEN 3 WHEN label = 1 THEN 2 ELSE 1 END AS BIGINT) AS version,
 round(CASE WHEN label % 2 = 0 THEN embedding[3] WHEN label = 1 THEN embedding[2] ELSE embedding[1] END::DOUBLE, 6) AS head
 FROM embeddings WHERE NOT (label = 5 OR (label = 1 AND vec_id % 2 = 1))"""


def _point_table(spark, d):
    """Loaded, changed, cut by tombstones and replayed; returns the table and the buckets its second merge rewrote."""
    e = B.table(spark, d, "embeddings")
    item = F.col("vec_id").cast("string")

    def rows(of, n: int):
        return of.select(item.alias("point_id"), item.alias("item_id"), F.slice("embedding", n, 2).alias("vector"), F.lit(n).alias("version"))

    points = VectorTable(spark, scratch_path(spark, "points"), 128)
    points.apply("load", rows(e, 1))
    points.merge()
    second = rows(e.where("label % 2 = 0 OR label = 1"), 2)
    points.apply("second", second)
    points.delete("gone", e.where("label = 5 OR (label = 1 AND vec_id % 2 = 1)").select(item.alias("point_id")), 2)
    points.apply("third", rows(e.where("label % 2 = 0"), 3))
    points.apply("second", second)
    rewritten = points.merge()
    points.apply("late", rows(e, 1))  # older versions, sent again after the tombstones
    points.apply("load", rows(e, 9))  # a known name changes nothing
    return points, rewritten


@query("vector_table", _VERSIONS)
def _(spark, d):
    points, _ = _point_table(spark, d)
    return points.read().select("item_id", "version", F.round(F.col("vector")[0].cast("double"), 6).alias("head"))


@query(
    "vector_table_rewritten",
    """SELECT CAST(CAST('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) % 128 AS INTEGER) AS bucket, count(*) AS n_changed
 FROM embeddings WHERE label % 2 = 0 OR label IN (1, 5) GROUP BY 1""",
)
def _(spark, d):
    """Buckets that the second merge rewrote: those that a change or a tombstone touched, and no other."""
    points, rewritten = _point_table(spark, d)
    changed = B.table(spark, d, "embeddings").where("label % 2 = 0 OR label IN (1, 5)")
    n = changed.groupBy(bucket_of(F.col("vec_id").cast("string"), points.buckets).alias("bucket")).agg(F.count("*").alias("n_changed"))
    written = spark.createDataFrame([(b,) for b in rewritten], "bucket int")
    return written.join(n, "bucket", "full")


@query(
    "vectors_round_trip",
    """SELECT CAST(vec_id AS VARCHAR) AS id, CAST(len(embedding) AS INTEGER) AS dim, 'v1' AS version,
 round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM embeddings""",
)
def _(spark, d):
    out = scratch_path(spark, "vectors")
    write_vectors(B.vectors(spark, d).withColumnRenamed("item_id", "id"), out, "v1")
    total = F.aggregate(F.col("vector").cast("array<double>"), F.lit(0.0), lambda s, x: s + x)
    return read_vectors(spark, out).select(
        "id", F.size("vector").alias("dim"), "version", F.round(total, 6).alias("total")
    )
