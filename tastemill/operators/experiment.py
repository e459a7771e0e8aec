"""A/B tests over recommendation tables, and their result logs."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.functions.hashing import assign_variant
from tastemill.functions.stats import two_sided_p
from tastemill.operators.ranking_metrics import (
    evaluate_ranking,
    per_user_metrics,
    select_eval_users,
)


def normalized_weights(weights: dict[str, float]) -> list[tuple[str, float]]:
    total = sum(weights.values())
    return [(name, w / total) for name, w in weights.items()]


def sequential_weights(weights: Sequence[tuple[str, float]]) -> list[tuple[str, float]]:
    """Weights as they end up when variants are added one by one, renormalising each time."""
    out: list[tuple[str, float]] = []
    for variant in weights:
        out.append(variant)
        total = sum(w for _, w in out)
        out = [(n, w / total) for n, w in out]
    return out


def route_users(users: DataFrame, weights: Sequence[tuple[str, float]], n_buckets: int = 100) -> DataFrame:
    return users.withColumn("variant", assign_variant(F.col("user_id"), list(weights), n_buckets))


def offline_ab(
    recs: DataFrame,
    truth: DataFrame,
    weights: Sequence[tuple[str, float]],
    k_values: Sequence[int] = (10, 20),
    max_users: int | None = None,
    n_buckets: int = 100,
) -> DataFrame:
    """Metrics per variant, each evaluation user judged only by the variant they are routed to.

    ``recs`` is ``(variant, user_id, item_id, rank)``.
    """
    users = route_users(select_eval_users(truth, max_users).select("user_id"), weights, n_buckets)
    routed = truth.join(users, "user_id")
    mine = recs.join(users, ["user_id", "variant"], "left_semi")
    return evaluate_ranking(mine, routed, k_values, by=["variant"])


def paired_variant_eval(
    recs: DataFrame, truth: DataFrame, variants: Sequence[str], k_values: Sequence[int] = (20,)
) -> DataFrame:
    """Metrics of every variant over the same users."""
    return evaluate_ranking(recs, _truth_per_variant(truth, variants), k_values, by=["variant"])


def _truth_per_variant(truth: DataFrame, variants: Sequence[str]) -> DataFrame:
    return truth.withColumn("variant", F.explode(F.array(*[F.lit(v) for v in variants])))


def paired_user_metrics(
    recs: DataFrame, truth: DataFrame, variants: Sequence[str], k: int
) -> DataFrame:
    return per_user_metrics(recs, _truth_per_variant(truth, variants), [k], by=["variant"])


def welch_statistics(samples: DataFrame, first: str, second: str, value: str = "value") -> DataFrame:
    """Welch's t and degrees of freedom of ``value`` between two variants, on one row."""

    def part(name: str) -> list[Column]:
        v = F.when(F.col("variant") == name, F.col(value))
        tag = "1" if name == first else "2"
        return [
            F.count(v).alias(f"n{tag}"),
            F.avg(v).alias(f"mean{tag}"),
            F.var_samp(v).alias(f"var{tag}"),
        ]

    row = samples.agg(*part(first), *part(second))
    s1, s2 = F.col("var1") / F.col("n1"), F.col("var2") / F.col("n2")
    return row.withColumn("t", (F.col("mean1") - F.col("mean2")) / F.sqrt(s1 + s2)).withColumn(
        "df",
        (s1 + s2) * (s1 + s2) / (s1 * s1 / (F.col("n1") - 1) + s2 * s2 / (F.col("n2") - 1)),
    )


def welch_t_test(samples: DataFrame, first: str, second: str, value: str = "value") -> dict:
    """t, df and two-sided p; the table is reduced to six numbers before anything leaves Spark."""
    r = welch_statistics(samples, first, second, value).first().asDict()
    if min(r["n1"], r["n2"]) < 2 or r["t"] is None:
        return {**r, "p": None}
    return {**r, "p": two_sided_p(r["t"], r["df"])}


def log_metric(spark, path: str, metric: str, value: float, tags: dict | None = None) -> None:
    """Append one metric event to a JSON log."""
    row = spark.range(1).select(
        F.current_timestamp().cast("string").alias("timestamp"),
        F.lit(metric).alias("metric"),
        F.lit(float(value)).alias("value"),
        F.lit(json.dumps(tags or {})).alias("tags"),
    )
    row.write.mode("append").json(path)


def summarize_experiment(results: DataFrame) -> DataFrame:
    """Latest result per experiment of ``(experiment, timestamp, variants)``."""
    return results.groupBy("experiment").agg(
        F.max_by(F.struct("timestamp", "variants"), F.col("timestamp")).alias("r")
    ).select("experiment", "r.*")
