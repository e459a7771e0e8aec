"""Recommendation quality and serving-log metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.functions.vectors import l2_normalize, vector_sum, weighted_means, zeros
from tastemill.operators.ordering import exact_percentiles, rank_values

COSINE_EPS = 1e-9
POPULARITY_FLOOR = 1e-9

# Latency bucket bounds in seconds.
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


def rate(numerator: Column, denominator: Column) -> Column:
    """Ratio, 0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0)).cast("double")


def catalog_coverage(recs: DataFrame, catalog_size: int) -> DataFrame:
    return recs.agg(
        rate(F.count_distinct("item_id"), F.lit(catalog_size)).alias("coverage")
    )


def _square(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)


def _mean_pair_cosine(sum_vector: Column, sum_squares: Column, n: Column) -> Column:
    """Mean cosine over all pairs of n unit vectors: (|sum|^2 - sum of squares) / (n (n - 1))."""
    n = n.cast("double")
    return (_square(sum_vector) - sum_squares) / (n * (n - 1.0))


def intra_list_diversity(recs: DataFrame, vectors: DataFrame, by: str = "user_id") -> DataFrame:
    """1 - mean pairwise cosine per list, linear in the list length; short lists give 0.

    Items without a vector are left out; one item listed twice counts twice.
    """
    unit = l2_normalize(F.col("vector"), COSINE_EPS)
    rows = recs.select(by, "item_id").join(vectors.select("item_id", unit.alias("_v")), "item_id")
    agg = rows.groupBy(by).agg(
        vector_sum(F.col("_v")).alias("_s"), F.sum(_square(F.col("_v"))).alias("_q"), F.count("*").alias("_n")
    )
    lists = recs.select(by).distinct().join(agg, by, "left")
    value = F.when(F.col("_n") >= 2, 1.0 - _mean_pair_cosine(F.col("_s"), F.col("_q"), F.col("_n")))
    return lists.select(by, F.coalesce(value, F.lit(0.0)).alias("diversity"))


def personalization(recs: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """1 - mean pairwise cosine of the users' mean item vectors, linear in the users."""
    rows = recs.select("user_id", "item_id").join(vectors.select("item_id", "vector"), "item_id")
    means = weighted_means(rows, ["user_id"], "vector", F.lit(1.0), dim, "_m")
    users = recs.select("user_id").distinct().join(means, "user_id", "left")
    unit = users.select(l2_normalize(F.coalesce("_m", zeros(F.lit(dim))), COSINE_EPS).alias("_v"))
    agg = unit.agg(
        vector_sum(F.col("_v")).alias("_s"), F.sum(_square(F.col("_v"))).alias("_q"), F.count("*").alias("_n")
    )
    value = F.when(F.col("_n") >= 2, 1.0 - _mean_pair_cosine(F.col("_s"), F.col("_q"), F.col("_n")))
    return agg.select(F.coalesce(value, F.lit(0.0)).alias("personalization"))


def frequency_map(df: DataFrame, key: str) -> DataFrame:
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    return counts.withColumn("p", F.col("n") / counts.agg(F.sum("n")).scalar())


def list_novelty(recs: DataFrame, popularity: DataFrame, by: str = "user_id") -> DataFrame:
    """Mean -log2 popularity per list; unknown items count as the rarest."""
    p = F.greatest(F.coalesce("p", F.lit(POPULARITY_FLOOR)), F.lit(POPULARITY_FLOOR))
    return (
        recs.join(popularity.select("item_id", "p"), "item_id", "left")
        .groupBy(by)
        .agg(F.avg(-F.log2(p)).alias("novelty"))
    )


def ctr(
    events: DataFrame, is_click: Column, is_impression: Column, by: Sequence[str] = ()
) -> DataFrame:
    clicks, shown = F.count_if(is_click), F.count_if(is_impression)
    return events.groupBy(*by).agg(
        clicks.alias("clicks"), shown.alias("impressions"), rate(clicks, shown).alias("ctr")
    )


def latency_percentiles(
    df: DataFrame, value: str, qs: Sequence[int] = (50, 95, 99), by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated percentiles to 6 decimals; an empty log gives zeros."""
    ranks = exact_percentiles(df, value, [q / 100 for q in qs], by)
    return ranks.groupBy(*by).agg(
        *[
            F.round(
                F.coalesce(F.max(F.when(F.col("p") == q / 100, F.col("value"))), F.lit(0.0)), 6
            ).alias(f"p{q}")
            for q in qs
        ]
    )


def request_rates(log: DataFrame, failed: Column, fell_back: Column, by: Sequence[str] = ()) -> DataFrame:
    """Share of requests whose output failed validation, and that fell back."""
    n = F.count("*")
    return log.groupBy(*by).agg(
        n.alias("requests"),
        rate(F.count_if(failed), n).alias("parse_failure_rate"),
        rate(F.count_if(fell_back), n).alias("fallback_rate"),
    )


def token_efficiency(
    log: DataFrame, tokens_in: Column, tokens_out: Column, budget: int, by: Sequence[str] = ()
) -> DataFrame:
    used = F.coalesce(F.sum(tokens_in), F.lit(0)) + F.coalesce(F.sum(tokens_out), F.lit(0))
    return log.groupBy(*by).agg(
        used.alias("tokens_used"),
        F.greatest(F.lit(budget) - used, F.lit(0)).alias("tokens_remaining"),
        rate(used, F.lit(budget)).alias("utilization"),
    )


def bucket_name(bound: float) -> str:
    return "le_" + format(bound, "g").replace(".", "_")


def request_rollup(
    log: DataFrame, by: Sequence[str], seconds: str, buckets: Sequence[float] = LATENCY_BUCKETS
) -> DataFrame:
    """Request count, mean latency and cumulative latency buckets per label set, in one pass."""
    s = F.col(seconds)
    return log.groupBy(*by).agg(
        F.count("*").alias("requests"),
        F.avg(s).alias("mean_latency"),
        *[F.count_if(s <= b).alias(bucket_name(b)) for b in buckets],
    )


def load_summary(
    log: DataFrame, by: Sequence[str], latency: str, ok: Column, elapsed: Column
) -> DataFrame:
    """Summary of a load run per group of ``log``.

    Percentiles pick the value at rank round(n q / 100) of the sorted latencies; the median
    averages the two middle ones.
    """
    keys = list(by)
    base = log.groupBy(*keys).agg(
        F.count("*").alias("requests"),
        F.count_if(ok).alias("success"),
        F.min(latency).alias("min_ms"),
        F.max(latency).alias("max_ms"),
        F.avg(latency).alias("mean_ms"),
        elapsed.alias("elapsed_s"),
    )

    def ranked(q: int):
        return lambda n: F.greatest(
            F.lit(0), F.least(n - 1, F.rint(n * F.lit(float(q)) / 100.0).cast("bigint"))
        )

    wanted = {f"p{q}": ranked(q) for q in (50, 95, 99)}
    wanted["_m1"] = lambda n: F.floor((n - 1) / F.lit(2.0))
    wanted["_m2"] = lambda n: F.ceil((n - 1) / F.lit(2.0))
    picks = rank_values(log, latency, wanted, keys).drop("n")
    return base.join(picks, keys).select(
        *keys,
        "requests",
        "success",
        F.round(rate(F.col("success"), F.col("requests")), 4).alias("success_rate"),
        *[F.round(f"p{q}", 1).alias(f"p{q}_ms") for q in (50, 95, 99)],
        F.round("min_ms", 1).alias("min_ms"),
        F.round("max_ms", 1).alias("max_ms"),
        F.round("mean_ms", 1).alias("mean_ms"),
        F.round((F.col("_m1") + F.col("_m2")) / 2.0, 1).alias("median_ms"),
        F.round("elapsed_s", 2).alias("total_elapsed_s"),
        F.round(rate(F.col("requests"), F.col("elapsed_s")), 2).alias("throughput_rps"),
    )


def error_counts(log: DataFrame, error: str, by: Sequence[str]) -> DataFrame:
    return log.where(F.col(error).isNotNull()).groupBy(*by, error).agg(F.count("*").alias("n"))
