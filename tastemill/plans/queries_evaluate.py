"""Offline evaluation and experiment queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tastemill.functions.hashing import assign_bucket, assign_variant
from tastemill.operators import experiment as G
from tastemill.operators import models as M
from tastemill.operators import ranking_metrics as R
from tastemill.operators.retrieval import retrieve_top_k
from tastemill.plans import bindings as B
from tastemill.plans import train as T
from tastemill.plans.queries_models import (
    ALS_SETTINGS,
    POP,
    SEEN,
    USER_VECTORS,
    top_k_sql,
    user_vectors,
)
from tastemill.plans.registry import query
from tastemill.schemas import DEFAULTS
from tastemill.session import materialize, scratch_path
from tastemill.sources.tables import ablation_table, read_experiments, record_experiment

WEIGHTS = G.normalized_weights({"vectors": 0.6, "popular": 0.4})


def _truth(spark, d):
    return R.ground_truth(B.test(spark, d), B.train(spark, d))


TRUTH = f"""SELECT DISTINCT user_id, item_id FROM ({B.TEST}) WHERE (user_id, item_id) NOT IN (
 SELECT (user_id, item_id) FROM ({B.TRAIN}))"""
_TOP = f"SELECT item_id, row_number() OVER (ORDER BY score DESC, item_id) AS rank FROM (SELECT * FROM ({POP.format(src=B.TRAIN)}) ORDER BY score DESC, item_id LIMIT 20)"
POP_RECS = f"SELECT user_id, item_id, rank FROM (SELECT DISTINCT user_id FROM ({TRUTH})) CROSS JOIN ({_TOP})"


def _pop_recs(spark, d):
    users = _truth(spark, d).select("user_id").distinct()
    return R.popular_recs_for_users(M.popularity(B.train(spark, d)), users, 20)


def metrics_sql(recs: str, truth: str, k_values=(10, 20), keys: str = "user_id") -> str:
    """Per-user recall, ndcg and hit."""
    cols = []
    for k in k_values:
        ideal = f"list_sum(list_transform(range(1, least(n_truth, {k}) + 1), lambda i: 1.0::DOUBLE / log2(i + 1)))"
        cols.append(f'h{k} / n_truth::DOUBLE AS "recall@{k}"')
        cols.append(f'coalesce(g{k}, 0) / {ideal} AS "ndcg@{k}"')
        cols.append(f'(h{k} > 0)::INTEGER::DOUBLE AS "hit@{k}"')
    aggs = ", ".join(
        f"count(*) FILTER (WHERE rank <= {k}) AS h{k}, sum(1.0::DOUBLE / log2(rank + 1)) FILTER (WHERE rank <= {k}) AS g{k}"
        for k in k_values
    )
    return f"""SELECT {keys}, n_truth, {', '.join(cols)} FROM (
 SELECT {keys}, count(*) AS n_truth, {aggs} FROM ({truth}) LEFT JOIN ({recs}) USING ({keys}, item_id) GROUP BY {keys})"""


def means_sql(per_user: str, k_values=(10, 20), by: str = "") -> str:
    cols = ", ".join(
        f'round(avg("{m}@{k}"), 6) AS "{m}@{k}"' for m in R.METRICS for k in k_values
    )
    lead, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"SELECT {lead}{cols}, count(*) AS n_users FROM ({per_user}){tail}"


def _rounded(df):
    return df.select(
        *[F.round(F.col(f"`{c}`"), 6).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes]
    )


@query("ground_truth", TRUTH)
def _(spark, d):
    return _truth(spark, d)


@query(
    "ground_truth_in_catalog",
    f"SELECT * FROM ({TRUTH}) WHERE item_id IN (SELECT item_id FROM ({B.TRAIN}) WHERE event_type = 'purchase')",
)
def _(spark, d):
    bought = B.train(spark, d).where(F.col("event_type") == "purchase").select("item_id").distinct()
    return R.ground_truth(B.test(spark, d), B.train(spark, d), bought)


_P_CUT = "1999-01-01"


@query(
    "ground_truth_purchases",
    f"""SELECT DISTINCT user_id, item_id FROM ({B.PURCHASES}) t WHERE "timestamp" >= TIMESTAMP '{_P_CUT}' AND NOT EXISTS (
 SELECT 1 FROM ({B.PURCHASES}) p WHERE p.user_id = t.user_id AND p.item_id = t.item_id AND p."timestamp" < TIMESTAMP '{_P_CUT}')""",
)
def _(spark, d):
    p = B.purchases(spark, d)
    cut = F.lit(_P_CUT).cast("timestamp")
    return R.ground_truth(p.where(F.col("timestamp") >= cut), p.where(F.col("timestamp") < cut))


@query(
    "select_eval_users",
    f"SELECT user_id, count(*) AS n FROM ({TRUTH}) GROUP BY user_id ORDER BY n DESC, user_id LIMIT 100",
)
def _(spark, d):
    return R.select_eval_users(_truth(spark, d), 100)


@query("recall_at_k", f'SELECT user_id, round("recall@10", 6) AS recall FROM ({metrics_sql(POP_RECS, TRUTH)})')
def _(spark, d):
    return _rounded(R.recall_at_k(_pop_recs(spark, d), _truth(spark, d), 10))


@query("hit_rate_at_k", f'SELECT user_id, "hit@10" AS hit FROM ({metrics_sql(POP_RECS, TRUTH)})')
def _(spark, d):
    return R.hit_rate_at_k(_pop_recs(spark, d), _truth(spark, d), 10)


@query("ndcg_at_k", f'SELECT user_id, round("ndcg@10", 6) AS ndcg FROM ({metrics_sql(POP_RECS, TRUTH)})')
def _(spark, d):
    return _rounded(R.ndcg_at_k(_pop_recs(spark, d), _truth(spark, d), 10))


@query("evaluate_ranking", means_sql(metrics_sql(POP_RECS, TRUTH)))
def _(spark, d):
    return _rounded(R.evaluate_ranking(_pop_recs(spark, d), _truth(spark, d)))


@query(
    "coverage",
    f"""SELECT count(*) FILTER (WHERE item_id IN (SELECT item_id FROM ({POP_RECS}))) AS recommended, count(*) AS catalog_size,
 round(count(*) FILTER (WHERE item_id IN (SELECT item_id FROM ({POP_RECS}))) / count(*), 6) AS coverage FROM ({B.ITEMS})""",
)
def _(spark, d):
    return _rounded(R.coverage(_pop_recs(spark, d), B.items(spark, d)))


@query(
    "diversity_category",
    f"""SELECT round(avg(n / 10.0::DOUBLE), 6) AS diversity FROM (SELECT user_id, count(DISTINCT category) AS n
 FROM ({POP_RECS}) JOIN ({B.ITEMS}) USING (item_id) WHERE rank <= 10 GROUP BY user_id)""",
)
def _(spark, d):
    return _rounded(R.diversity_category(_pop_recs(spark, d), B.items(spark, d), 10))


@query("mean_list_len", f"SELECT round(avg(n), 6) AS mean_len FROM (SELECT count(*) AS n FROM ({TRUTH}) GROUP BY user_id)")
def _(spark, d):
    return _rounded(R.mean_list_len(_truth(spark, d)))


@query(
    "summarize",
    "SELECT printf('%s: %.4f | %s: %.4f | %s: %.4f', 'hit', h, 'ndcg', n, 'recall', r) AS summary FROM ("
    + f'SELECT avg("hit@10") AS h, avg("ndcg@10") AS n, avg("recall@10") AS r FROM ({metrics_sql(POP_RECS, TRUTH)}))',
)
def _(spark, d):
    m = R.evaluate_ranking(_pop_recs(spark, d), _truth(spark, d), [10])
    return R.summarize(
        m.select(*[F.col(f"`{n}@10`").alias(n) for n in R.METRICS])
    )


def _retrieval_sql(limit: str) -> str:
    rich = f"SELECT user_id FROM ({TRUTH}) WHERE item_id IN (SELECT item_id FROM ({B.VECTORS})) AND user_id IN (SELECT user_id FROM ({B.TRAIN})) GROUP BY user_id ORDER BY count(*) DESC, user_id {limit}"
    return means_sql(
        metrics_sql(
            top_k_sql(USER_VECTORS.format(src=B.TRAIN), 20, SEEN),
            f"SELECT * FROM ({TRUTH}) WHERE item_id IN (SELECT item_id FROM ({B.VECTORS})) AND user_id IN ({rich})",
        )
    )


@query("evaluate_retrieval", _retrieval_sql(""))
def _(spark, d):
    return _rounded(
        T.evaluate_retrieval(B.train(spark, d), B.test(spark, d), user_vectors(spark, d), B.vectors(spark, d))
    )


@query("evaluate_retrieval_richest", _retrieval_sql("LIMIT 30"))
def _(spark, d):
    """The same over the 30 users with most truth, an explicit limit."""
    settings = replace(DEFAULTS, eval_max_users=30)
    return _rounded(
        T.evaluate_retrieval(B.train(spark, d), B.test(spark, d), user_vectors(spark, d), B.vectors(spark, d), settings)
    )


@query(
    "sample_common_users",
    f"""SELECT user_id FROM (SELECT user_id FROM ({B.TRAIN}) INTERSECT SELECT user_id FROM ({B.TEST}))
 ORDER BY md5(concat_ws('|', '42', user_id)) LIMIT 50""",
)
def _(spark, d):
    return R.sample_common_users(B.train(spark, d), B.test(spark, d), 50)


_REACHABLE = f"""SELECT * FROM ({TRUTH}) WHERE item_id IN (SELECT item_id FROM ({B.TRAIN}))
 AND user_id IN (SELECT user_id FROM ({B.TRAIN}))"""


def _popularity_sql(limit: str) -> str:
    judged = f"""SELECT * FROM ({_REACHABLE}) WHERE user_id IN (
 SELECT user_id FROM ({_REACHABLE}) GROUP BY user_id ORDER BY count(*) DESC, user_id {limit})"""
    recs = f"SELECT user_id, item_id, rank FROM (SELECT DISTINCT user_id FROM ({judged})) CROSS JOIN ({_TOP})"
    return f"""SELECT m.*, c.coverage, v.diversity FROM ({means_sql(metrics_sql(recs, judged))}) m,
 (SELECT round(count(*) FILTER (WHERE item_id IN (SELECT item_id FROM ({recs}))) / count(*), 6) AS coverage FROM (SELECT DISTINCT item_id FROM ({B.TRAIN}))) c,
 (SELECT round(avg(n / 10.0::DOUBLE), 6) AS diversity FROM (SELECT user_id, count(DISTINCT category) AS n
 FROM ({recs}) JOIN ({B.ITEMS}) USING (item_id) WHERE rank <= 10 GROUP BY user_id)) v"""


@query("train_popularity", _popularity_sql(""))
def _(spark, d):
    """Popularity model, its ranking metrics, coverage and diversity; every user is judged."""
    return _rounded(T.train_popularity(B.train(spark, d), B.test(spark, d), B.items(spark, d)))


@query("train_popularity_richest", _popularity_sql("LIMIT 40"))
def _(spark, d):
    """The same over the 40 users with most truth, an explicit limit."""
    settings = replace(DEFAULTS, eval_max_users=40)
    return _rounded(T.train_popularity(B.train(spark, d), B.test(spark, d), B.items(spark, d), settings))


@query("train_als")
def _(spark, d):
    return T.train_als(B.train(spark, d), B.test(spark, d), B.items(spark, d), ALS_SETTINGS)


@query(
    "popularity_evaluation",
    f"""SELECT m.*, c.coverage, v.diversity FROM ({means_sql(metrics_sql(POP_RECS, TRUTH))}) m,
 (SELECT round(count(*) FILTER (WHERE item_id IN (SELECT item_id FROM ({POP_RECS}))) / count(*), 6) AS coverage FROM (SELECT DISTINCT item_id FROM ({B.TRAIN}))) c,
 (SELECT round(avg(n / 10.0::DOUBLE), 6) AS diversity FROM (SELECT user_id, count(DISTINCT category) AS n
 FROM ({POP_RECS}) JOIN ({B.ITEMS}) USING (item_id) WHERE rank <= 10 GROUP BY user_id)) v""",
)
def _(spark, d):
    """The whole flow against SQL; every user is evaluated."""
    settings = replace(DEFAULTS, eval_max_users=None)
    return _rounded(T.train_popularity(B.train(spark, d), B.test(spark, d), B.items(spark, d), settings))


_RUNS = """SELECT event_type AS model, 'v' || (event_id % 7) AS version, 'events' AS dataset, ts, event_id, value,
 event_id % 11 > 0 AS measured FROM events"""


@query(
    "record_experiment",
    """SELECT event_type AS model, 'v1' AS version, 'events' AS dataset, round(avg(value), 6) AS mean_value, count(*)::DOUBLE AS n
 FROM events GROUP BY event_type""",
)
def _(spark, d):
    """One run per event type appended to the log, with metrics of its events."""
    path = scratch_path(spark, "experiments")
    found = B.table(spark, d, "events").groupBy("event_type").agg(F.avg("value").alias("mean"), F.count("*").alias("n"))
    for r in found.collect():  # one row per event type
        record_experiment(spark, path, r["event_type"], "v1", "events", {"mean": r["mean"], "n": r["n"]})
    runs = read_experiments(spark, path)
    return runs.select("model", "version", "dataset", F.round(F.col("metrics")["mean"], 6).alias("mean_value"), F.col("metrics")["n"].alias("n"))


@query(
    "ablation_table",
    f"""SELECT model, version, dataset, recall_20, ndcg_20, 0.0::DOUBLE AS hit_20, 0.0::DOUBLE AS coverage, 0.0::DOUBLE AS diversity FROM (
 SELECT *, round(value / 1000, 6) AS recall_20, round(value / 500, 6) AS ndcg_20, row_number() OVER (PARTITION BY model ORDER BY ts DESC) AS rn
 FROM ({_RUNS}) WHERE measured) WHERE rn = 1""",
)
def _(spark, d):
    """Latest measured run per model, from a JSON log of runs written and read back."""
    runs = B.table(spark, d, "events").select(
        F.col("event_type").alias("model"),
        F.concat(F.lit("v"), F.col("event_id") % 7).alias("version"),
        F.lit("events").alias("dataset"),
        F.when(
            F.col("event_id") % 11 > 0,
            F.create_map(
                F.lit("recall@20"), F.round(F.col("value") / 1000, 6),
                F.lit("ndcg@20"), F.round(F.col("value") / 500, 6),
            ),
        )
        .otherwise(F.create_map().cast("map<string,double>"))
        .alias("metrics"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("string").alias("notes"),
    )
    path = scratch_path(spark, "runs")
    runs.write.json(path)
    return ablation_table(read_experiments(spark, path))


# Experiments

_BUCKET = "CAST('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 100"


@query("assign_bucket", f"SELECT o_orderkey, {_BUCKET} AS bucket FROM orders")
def _(spark, d):
    return B.table(spark, d, "orders").select("o_orderkey", assign_bucket(F.col("o_custkey")).alias("bucket"))


@query(
    "assign_variant",
    f"""SELECT o_orderkey, CASE WHEN b < 100 * (2 / 3.0::DOUBLE) THEN 'a' WHEN b < 100 * (2 / 3.0::DOUBLE) + 100 * (1 / 6.0::DOUBLE) THEN 'b' ELSE 'c' END AS variant
 FROM (SELECT o_orderkey, {_BUCKET} AS b FROM orders)""",
)
def _(spark, d):
    weights = G.normalized_weights({"a": 4.0, "b": 1.0, "c": 1.0})
    return B.table(spark, d, "orders").select(
        "o_orderkey", assign_variant(F.col("o_custkey"), weights).alias("variant")
    )


def _variant_recs(spark, d):
    """Both recommenders' lists for every truth user, tagged by variant."""
    users = _truth(spark, d).select("user_id").distinct()
    mine = user_vectors(spark, d).join(users, "user_id", "left_semi")
    hits = retrieve_top_k(
        mine.withColumnRenamed("user_id", "query_id"), B.vectors(spark, d), 20
    ).select(F.lit("vectors").alias("variant"), F.col("query_id").alias("user_id"), "item_id", "rank")
    pop = _pop_recs(spark, d).select(F.lit("popular").alias("variant"), "user_id", "item_id", "rank")
    return materialize(hits.unionByName(pop), "recs")


_VARIANT_RECS = f"""SELECT 'vectors' AS variant, user_id, item_id, rank FROM ({top_k_sql(USER_VECTORS.format(src=B.TRAIN), 20)})
 UNION ALL SELECT 'popular', user_id, item_id, rank FROM ({POP_RECS})"""
_ROUTED = f"""SELECT user_id, CASE WHEN CAST('0x' || substr(md5(user_id), 1, 8) AS BIGINT) % 100 < 60 THEN 'vectors' ELSE 'popular' END AS variant
 FROM (SELECT DISTINCT user_id FROM ({TRUTH}))"""
_RVT = f"SELECT variant, user_id, item_id FROM ({TRUTH}) JOIN ({_ROUTED}) USING (user_id)"


@query(
    "offline_ab",
    means_sql(metrics_sql(_VARIANT_RECS, _RVT, keys="variant, user_id"), by="variant"),
)
def _(spark, d):
    return _rounded(
        G.offline_ab(_variant_recs(spark, d), _truth(spark, d), WEIGHTS)
    )


_BOTH = f"SELECT variant, user_id, item_id FROM ({TRUTH}) CROSS JOIN (VALUES ('vectors'), ('popular')) v(variant)"
_PAIRED = metrics_sql(_VARIANT_RECS, _BOTH, (20,), keys="variant, user_id")


@query("paired_variant_eval", means_sql(_PAIRED, (20,), by="variant"))
def _(spark, d):
    return _rounded(
        G.paired_variant_eval(_variant_recs(spark, d), _truth(spark, d), ["vectors", "popular"])
    )


@query(
    "welch_statistics",
    f"""SELECT n1, n2, round(m1, 6) AS mean1, round(m2, 6) AS mean2, round(v1, 6) AS var1, round(v2, 6) AS var2,
 round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 6) AS t,
 round(power(v1 / n1 + v2 / n2, 2) / (power(v1 / n1, 2) / (n1 - 1) + power(v2 / n2, 2) / (n2 - 1)), 6) AS df FROM (
 SELECT count(*) FILTER (WHERE a) AS n1, avg(r) FILTER (WHERE a) AS m1, var_samp(r) FILTER (WHERE a) AS v1,
 count(*) FILTER (WHERE NOT a) AS n2, avg(r) FILTER (WHERE NOT a) AS m2, var_samp(r) FILTER (WHERE NOT a) AS v2
 FROM (SELECT variant = 'vectors' AS a, "recall@20" AS r FROM ({_PAIRED})))""",
)
def _(spark, d):
    per = G.paired_user_metrics(_variant_recs(spark, d), _truth(spark, d), ["vectors", "popular"], 20)
    samples = per.select("variant", F.col("`recall@20`").alias("value"))
    return _rounded(G.welch_statistics(samples, "vectors", "popular"))


@query(
    "welch_statistics_orders",
    """SELECT n1, n2, round(m1, 4) AS mean1, round(m2, 4) AS mean2, round(v1, 2) AS var1, round(v2, 2) AS var2,
 round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 6) AS t FROM (
 SELECT count(*) FILTER (WHERE a) AS n1, avg(r) FILTER (WHERE a) AS m1, var_samp(r) FILTER (WHERE a) AS v1,
 count(*) FILTER (WHERE NOT a) AS n2, avg(r) FILTER (WHERE NOT a) AS m2, var_samp(r) FILTER (WHERE NOT a) AS v2
 FROM (SELECT CAST('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 50 AS a, o_totalprice AS r FROM orders))""",
)
def _(spark, d):
    """Order value between two halves of the customers."""
    routed = B.table(spark, d, "orders").select(
        assign_variant(F.col("o_custkey"), [("a", 0.5), ("b", 0.5)]).alias("variant"),
        F.col("o_totalprice").alias("value"),
    )
    r = G.welch_statistics(routed, "a", "b")
    return r.select(
        "n1",
        "n2",
        *[F.round(c, 4).alias(c) for c in ("mean1", "mean2")],
        *[F.round(c, 2).alias(c) for c in ("var1", "var2")],
        F.round("t", 6).alias("t"),
    )


@query(
    "summarize_experiment",
    """SELECT event_type AS experiment, CAST(epoch_us(max(ts)) AS BIGINT) AS ts_us, arg_max(props, ts) AS variants
 FROM events GROUP BY event_type""",
)
def _(spark, d):
    results = B.table(spark, d, "events").select(
        F.col("event_type").alias("experiment"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("props").alias("variants"),
    )
    return G.summarize_experiment(results).select(
        "experiment", F.unix_micros("timestamp").alias("ts_us"), "variants"
    )
