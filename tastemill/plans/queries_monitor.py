"""Drift and serving-log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.functions.events import classify_error
from tastemill.operators import drift as D
from tastemill.operators import monitoring as H
from tastemill.operators.messages import estimate_tokens, validate_structured_output
from tastemill.operators.models import popularity
from tastemill.plans import bindings as B
from tastemill.plans.queries_evaluate import POP_RECS, _pop_recs
from tastemill.plans.queries_models import POP
from tastemill.plans.queries_search import _raw_json
from tastemill.plans.registry import query
from tastemill.session import materialize

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount"]
_BEFORE, _AFTER = "l_shipdate < TIMESTAMP '1998-01-01'", "l_shipdate >= TIMESTAMP '1998-01-01'"


def _sides(spark, d):
    """Line items before and after a date."""
    li = B.table(spark, d, "lineitem").select(*NUMERIC, "l_returnflag", "l_linestatus", "l_shipdate")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    return li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut)


_PROBS = "[" + ", ".join(f"{i / 10}" for i in range(11)) + "]"


def edges_sql(column: str, src: str) -> str:
    return f"SELECT list_sort(list_distinct(quantile_cont({column}, {_PROBS}))) AS e FROM ({src})"


@query(
    "quantile_edges",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, CAST(generate_subscripts(e, 1) - 1 AS INTEGER) AS pos, round(unnest(e), 6) AS edge
 FROM ({edges_sql(c, f'SELECT * FROM lineitem WHERE {_BEFORE}')})"""
        for c in NUMERIC
    ),
)
def _(spark, d):
    before, _after = _sides(spark, d)
    edges = D.quantile_edges(D.unpivot_numeric(before, NUMERIC), NUMERIC)
    return edges.select("feature", F.posexplode("edges").alias("pos", "edge")).withColumn(
        "edge", F.round("edge", 6)
    )


def _sketches(spark, d):
    """Stored sketches of either side: the earlier side's are merged from those of its years."""
    before, after = _sides(spark, d)
    year = F.year("l_shipdate")
    long = lambda df: df.select(year.alias("year"), *NUMERIC).unpivot(["year"], list(NUMERIC), "feature", "value")
    numeric = [df.select(*[c if c == "l_shipdate" else F.col(c).cast("double").alias(c) for c in ("l_shipdate", *NUMERIC)]) for df in (before, after)]
    by_year = materialize(D.sketch_values(long(numeric[0]), ["year"]), "sketches")
    return materialize(D.merge_sketches(by_year), "baseline"), D.sketch_values(long(numeric[1]))


@query(
    "quantile_edges_approximate",
    "SELECT feature, CAST(pos AS INTEGER) AS pos, true AS within, n FROM (SELECT unnest(["
    + ", ".join(f"'{c}'" for c in NUMERIC)
    + f"]) AS feature), (SELECT unnest(range(11)) AS pos), (SELECT count(*) AS n FROM lineitem WHERE {_BEFORE})",
)
def _(spark, d):
    """Whether the share of values up to each edge of the merged sketches is its percentile, within the rank error."""
    before, _after = _sides(spark, d)
    stored, _ = _sketches(spark, d)
    probs = F.array(*[F.lit(i / 10) for i in range(11)])
    points = stored.select("feature", F.posexplode(F.call_function("kll_sketch_get_quantile_double", "sketch", probs)).alias("pos", "edge"))
    met = D.unpivot_numeric(before, NUMERIC).join(F.broadcast(points), "feature").groupBy("feature", "pos").agg(
        F.avg((F.col("value") <= F.col("edge")).cast("double")).alias("hi"),
        F.avg((F.col("value") < F.col("edge")).cast("double")).alias("lo"),
        F.count("*").alias("n"),
    )
    p, e = F.col("pos") / 10, 4 * D.RANK_ERROR
    return met.select("feature", "pos", ((F.col("lo") - e <= p) & (p <= F.col("hi") + e)).alias("within"), "n")


def shares_sql(column: str, values: str, src: str) -> str:
    """Bin shares of ``values`` over the edges of ``src``, per bin."""
    bin_of = f"least(len(list_filter(e, lambda x: x <= {column})), len(e) - 1)"
    return f"""SELECT bin, n, greatest(1e-6::DOUBLE, n / greatest(1, sum(n) OVER ())::DOUBLE)
 / sum(greatest(1e-6::DOUBLE, n / greatest(1, tot)::DOUBLE)) OVER () AS p FROM (
 SELECT *, sum(n) OVER () AS tot FROM (SELECT b.bin, coalesce(c.n, 0) AS n FROM (
 SELECT unnest(range(1, len(e))) AS bin FROM ({edges_sql(column, src)})) b LEFT JOIN (
 SELECT {bin_of} AS bin, count(*) AS n FROM ({values}), ({edges_sql(column, src)})
 WHERE {column} >= e[1] AND {column} <= e[-1] GROUP BY 1) c USING (bin)))"""


_B, _A = f"SELECT * FROM lineitem WHERE {_BEFORE}", f"SELECT * FROM lineitem WHERE {_AFTER}"


@query(
    "bin_proportions",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, CAST(bin AS INTEGER) AS bin, CAST(n AS BIGINT) AS n, round(p, 6) AS p,
 (SELECT count(*) FROM ({_A}), ({edges_sql(c, _B)}) WHERE {c} < e[1] OR {c} > e[-1]) AS outside FROM ({shares_sql(c, _A, _B)})"""
        for c in NUMERIC
    ),
)
def _(spark, d):
    before, after = _sides(spark, d)
    edges = D.quantile_edges(D.unpivot_numeric(before, NUMERIC), NUMERIC)
    out = D.bin_proportions(D.unpivot_numeric(after, NUMERIC), edges)
    return out.withColumn("p", F.round("p", 6))


def psi_sql(column: str, actual: str, expected: str) -> str:
    return f"""SELECT sum((a.p - e.p) * ln(a.p / e.p)) AS psi FROM ({shares_sql(column, actual, expected)}) a
 JOIN ({shares_sql(column, expected, expected)}) e USING (bin)"""


@query("psi", f"SELECT 'l_extendedprice' AS feature, round(psi, 6) AS psi FROM ({psi_sql('l_extendedprice', _A, _B)})")
def _(spark, d):
    before, after = _sides(spark, d)
    return D.psi(after, before, "l_extendedprice").withColumn("psi", F.round("psi", 6))


@query(
    "psi_of_sketches",
    "SELECT feature, abs(psi) < 0.1 AS stable, true AS near FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, psi FROM ({psi_sql(c, _A, _B)})" for c in NUMERIC) + ")",
)
def _(spark, d):
    """The index from stored sketches alone, next to the exact one: the same verdict, and within a hundredth of it."""
    before, after = _sides(spark, d)
    stored, now = _sketches(spark, d)
    near = D.psi_of_sketches(now, stored, NUMERIC).withColumnRenamed("psi", "approximate")
    exact = D.psi_long(D.unpivot_numeric(after, NUMERIC), D.unpivot_numeric(before, NUMERIC), NUMERIC)
    both = near.join(exact, "feature")
    return both.select("feature", (F.col("approximate") < D.ALERT).alias("stable"), (F.abs(F.col("approximate") - F.col("psi")) < 0.01).alias("near"))


@query(
    "kl_divergence",
    f"SELECT 'l_extendedprice' AS feature, round(psi, 6) AS kl FROM ({psi_sql('l_extendedprice', _B, _A)})",
)
def _(spark, d):
    before, after = _sides(spark, d)
    return D.kl_divergence(after, before, "l_extendedprice").withColumn("kl", F.round("kl", 6))


def _both_sql(column: str) -> str:
    return f"""SELECT category, coalesce(r, 0) AS ref, coalesce(c, 0) AS cur FROM (
 SELECT {column} AS category, count(*) / sum(count(*)) OVER ()::DOUBLE AS r FROM ({_B}) GROUP BY 1) FULL JOIN (
 SELECT {column} AS category, count(*) / sum(count(*)) OVER ()::DOUBLE AS c FROM ({_A}) GROUP BY 1) USING (category)"""


_KIND = "l_returnflag || '-' || l_linestatus"


@query(
    "category_deltas",
    f"SELECT category, round(ref, 6) AS ref, round(cur, 6) AS cur, round(cur - ref, 4) AS delta FROM ({_both_sql(_KIND)})",
)
def _(spark, d):
    before, after = (s.withColumn("kind", F.concat_ws("-", "l_returnflag", "l_linestatus")) for s in _sides(spark, d))
    out = D.category_deltas(before, after, "kind")
    return out.select("category", F.round("ref", 6).alias("ref"), F.round("cur", 6).alias("cur"), "delta")


def shift_sql(column: str) -> str:
    return f"""SELECT sum((r - c) * ln(r / c)) AS score FROM (SELECT (ref + 1e-6) / sum(ref + 1e-6) OVER () AS r,
 (cur + 1e-6) / sum(cur + 1e-6) OVER () AS c FROM ({_both_sql(column)}))"""


@query("categorical_shift", f"SELECT round(score, 9) AS score FROM ({shift_sql('l_returnflag')})")
def _(spark, d):
    before, after = _sides(spark, d)
    return D.categorical_shift(before, after, "l_returnflag").withColumn("score", F.round("score", 9))


@query(
    "detect_drift",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, 'numeric' AS kind, round(psi, 6) AS score, CASE WHEN psi > 0.1 THEN 'yes' ELSE 'no' END AS alert, '' AS deltas FROM ({psi_sql(c, _A, _B)})"
        for c in NUMERIC
    )
    + f""" UNION ALL SELECT 'l_returnflag', 'categorical', round(score, 6), '', deltas FROM ({shift_sql('l_returnflag')}),
 (SELECT string_agg(category || ' ' || printf('%.4f', round(cur - ref, 4)), ',' ORDER BY category) AS deltas FROM ({_both_sql('l_returnflag')}))""",
)
def _(spark, d):
    before, after = _sides(spark, d)
    out = D.detect_drift(before, after, NUMERIC, ["l_returnflag"])
    alert = F.when(F.col("alert"), "yes").when(~F.col("alert"), "no").otherwise("")
    deltas = F.transform("deltas", lambda x: F.format_string("%s %.4f", x["category"], x["delta"]))
    out = out.withColumn("deltas", F.coalesce(F.array_join(deltas, ","), F.lit("")))
    return out.withColumn("score", F.round("score", 6)).withColumn("alert", alert)


# Recommendation quality


@query(
    "catalog_coverage",
    f"SELECT round(count(DISTINCT item_id) / 100.0::DOUBLE, 6) AS coverage FROM ({POP_RECS})",
)
def _(spark, d):
    return H.catalog_coverage(_pop_recs(spark, d), 100).withColumn("coverage", F.round("coverage", 6))


def _lists(spark, d):
    """Distinct items each user touched."""
    return B.interactions(spark, d).select("user_id", "item_id").distinct()


_LISTS = f"SELECT DISTINCT user_id, item_id FROM ({B.VALID})"


@query(
    "intra_list_diversity",
    f"""WITH l AS (SELECT user_id, item_id, vector FROM ({_LISTS}) JOIN ({B.VECTORS}) USING (item_id))
 SELECT user_id, round(coalesce(diversity, 0), 6) AS diversity FROM (SELECT DISTINCT user_id FROM ({_LISTS})) LEFT JOIN (
 SELECT a.user_id, 1 - avg(list_cosine_similarity(a.vector, b.vector)) AS diversity FROM l a JOIN l b
 ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY a.user_id) USING (user_id)""",
)
def _(spark, d):
    out = H.intra_list_diversity(_lists(spark, d), B.vectors(spark, d))
    return out.withColumn("diversity", F.round("diversity", 6))


@query(
    "personalization",
    f"""WITH m AS (SELECT user_id, list(x ORDER BY pos) AS v FROM (SELECT user_id, pos, avg(x) AS x FROM (
 SELECT user_id, unnest(vector) AS x, generate_subscripts(vector, 1) AS pos FROM ({_LISTS}) JOIN ({B.VECTORS}) USING (item_id)) GROUP BY 1, 2) GROUP BY 1)
 SELECT round(1 - avg(list_cosine_similarity(a.v, b.v)), 6) AS personalization FROM m a JOIN m b ON a.user_id < b.user_id""",
)
def _(spark, d):
    out = H.personalization(_lists(spark, d), B.vectors(spark, d), B.DIM)
    return out.withColumn("personalization", F.round("personalization", 6))


@query(
    "frequency_map",
    f"SELECT item_id, count(*) AS n, round(count(*) / sum(count(*)) OVER ()::DOUBLE, 9) AS p FROM ({B.PURCHASES}) GROUP BY item_id",
)
def _(spark, d):
    return H.frequency_map(B.purchases(spark, d), "item_id").withColumn("p", F.round("p", 9))


@query(
    "list_novelty",
    f"""SELECT user_id, round(avg(-log2(greatest(coalesce(p, 1e-9), 1e-9))), 6) AS novelty FROM ({_LISTS}) LEFT JOIN (
 SELECT item_id, score / sum(score) OVER () AS p FROM ({POP.format(src=B.TRAIN)})) USING (item_id) GROUP BY user_id""",
)
def _(spark, d):
    scores = popularity(B.train(spark, d))
    pop = scores.withColumn("p", F.col("score") / scores.agg(F.sum("score")).scalar())
    return H.list_novelty(_lists(spark, d), pop).withColumn("novelty", F.round("novelty", 6))


# Serving log: events as requests, their value as latency in milliseconds

_CLICK, _VIEW = "event_type = 'click'", "event_type = 'view'"


@query(
    "ctr",
    f"""SELECT json_extract_string(props, '$.k') AS item_id, count(*) FILTER (WHERE {_CLICK}) AS clicks, count(*) FILTER (WHERE {_VIEW}) AS impressions,
 round(coalesce(count(*) FILTER (WHERE {_CLICK}) / nullif(count(*) FILTER (WHERE {_VIEW}), 0)::DOUBLE, 0), 6) AS ctr FROM events GROUP BY 1""",
)
def _(spark, d):
    out = H.ctr(
        B.raw_interactions(spark, d),
        F.col("event_type") == "click",
        F.col("event_type") == "view",
        ["item_id"],
    )
    return out.withColumn("ctr", F.round("ctr", 6))


@query(
    "latency_percentiles",
    """SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
 round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type""",
)
def _(spark, d):
    return H.latency_percentiles(B.table(spark, d, "events"), "value", by=["event_type"])


@query(
    "latency_percentiles_overall",
    """SELECT round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95,
 round(quantile_cont(l_extendedprice, 0.99), 6) AS p99 FROM lineitem""",
)
def _(spark, d):
    return H.latency_percentiles(B.table(spark, d, "lineitem"), "l_extendedprice")


@query(
    "request_rates",
    """SELECT p_brand, count(*) AS requests, round(count(*) FILTER (WHERE p_size % 11 <= 1 OR p_size % 5 = 0 OR p_size % 4 >= 2 OR p_size % 7 = 0) / count(*)::DOUBLE, 6) AS parse_failure_rate,
 round(count(*) FILTER (WHERE p_size % 11 <= 1) / count(*)::DOUBLE, 6) AS fallback_rate FROM part GROUP BY p_brand""",
)
def _(spark, d):
    """Structured answers per brand: those that fail validation, and those not even JSON."""
    brand = B.table(spark, d, "part").select("p_partkey", "p_brand")
    checked = validate_structured_output(_raw_json(spark, d)).join(brand, "p_partkey")
    out = H.request_rates(
        checked, F.col("error").isNotNull(), F.coalesce(F.col("error") == "malformed", F.lit(False)), ["p_brand"]
    )
    return out.withColumn("parse_failure_rate", F.round("parse_failure_rate", 6)).withColumn(
        "fallback_rate", F.round("fallback_rate", 6)
    )


_TOK = "greatest(1, length(text) // 4)"


@query(
    "token_efficiency",
    f"""SELECT conv_id, CAST(u AS BIGINT) AS tokens_used, CAST(greatest(4096 - u, 0) AS BIGINT) AS tokens_remaining, round(u / 4096.0::DOUBLE, 6) AS utilization FROM (
 SELECT conv_id, sum({_TOK}) AS u FROM conversations GROUP BY conv_id)""",
)
def _(spark, d):
    """Tokens per conversation: users write the input, everyone else the output."""
    n = estimate_tokens(F.col("text"))
    user = F.col("role") == "user"
    out = H.token_efficiency(
        B.table(spark, d, "conversations"), F.when(user, n), F.when(~user, n), 4096, ["conv_id"]
    )
    return out.withColumn("utilization", F.round("utilization", 6))


@query(
    "request_rollup",
    "SELECT event_type, count(*) AS requests, round(avg(value / 1000), 6) AS mean_latency, "
    + ", ".join(
        f"count(*) FILTER (WHERE value / 1000 <= {b}::DOUBLE) AS {H.bucket_name(b)}" for b in H.LATENCY_BUCKETS
    )
    + " FROM events GROUP BY event_type",
)
def _(spark, d):
    log = B.table(spark, d, "events").withColumn("seconds", F.col("value") / 1000)
    out = H.request_rollup(log, ["event_type"], "seconds")
    return out.withColumn("mean_latency", F.round("mean_latency", 6))


@query(
    "classify_error",
    """SELECT doc_id, CASE WHEN contains(m, 'timeout') OR contains(m, 'timed out') THEN 'timeout'
 WHEN contains(m, 'connect') OR contains(m, 'network') OR contains(m, 'dns') THEN 'connection'
 WHEN contains(m, '401') OR contains(m, '403') OR contains(m, 'unauthorized') OR contains(m, 'forbidden') THEN 'unavailable'
 ELSE 'other' END AS error_type FROM (SELECT doc_id, lower(text) AS m FROM documents)""",
)
def _(spark, d):
    return B.table(spark, d, "documents").select("doc_id", classify_error("text").alias("error_type"))


def _rank(q: int) -> str:
    return f"s[CAST(greatest(0, least(n - 1, round_even(n * {q}.0::DOUBLE / 100, 0))) AS INTEGER) + 1]"


@query(
    "load_summary",
    f"""SELECT event_type, n AS requests, ok AS success, round(ok / n::DOUBLE, 4) AS success_rate,
 round({_rank(50)}, 1) AS p50_ms, round({_rank(95)}, 1) AS p95_ms, round({_rank(99)}, 1) AS p99_ms,
 round(s[1], 1) AS min_ms, round(s[-1], 1) AS max_ms, round(a, 1) AS mean_ms, round((s[(n + 1) // 2] + s[n // 2 + 1]) / 2.0, 1) AS median_ms,
 round(el, 2) AS total_elapsed_s, round(n / el, 2) AS throughput_rps FROM (
 SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value < 100) AS ok, list_sort(list(value)) AS s, avg(value) AS a,
 (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::DOUBLE AS el FROM events GROUP BY event_type)""",
)
def _(spark, d):
    log = B.table(spark, d, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))
    return H.load_summary(
        log, ["event_type"], "value", F.col("value") < 100, (F.max("t") - F.min("t")) / 1e6
    )


@query(
    "error_counts",
    "SELECT event_type, CASE WHEN value >= 200 THEN 'timeout' ELSE 'slow' END AS error, count(*) AS n FROM events WHERE value >= 100 GROUP BY 1, 2",
)
def _(spark, d):
    kind = F.when(F.col("value") >= 200, "timeout").when(F.col("value") >= 100, "slow")
    return H.error_counts(B.table(spark, d, "events").withColumn("error", kind), "error", ["event_type"])
