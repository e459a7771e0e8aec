"""Offline ranking metrics over long recommendation and truth tables.

Recommendations are ``(user_id, item_id, rank)`` with 1-based ranks, truth ``(user_id, item_id)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.functions.hashing import seeded_order
from tastemill.operators.ordering import head_by_order

METRICS = ("recall", "ndcg", "hit")


def ground_truth(test: DataFrame, train: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """Test items the user had not touched in train, optionally only those of a catalog."""
    pairs = test.select("user_id", "item_id").distinct()
    fresh = pairs.join(train.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    if catalog is None:
        return fresh
    return fresh.join(catalog.select("item_id"), "item_id", "left_semi").select("user_id", "item_id")


def select_eval_users(
    truth: DataFrame, max_users: int | None = None, restrict: DataFrame | None = None
) -> DataFrame:
    """Users with the largest truth, ties by id; optionally only known users, or all of them."""
    sizes = truth.groupBy("user_id").agg(F.count("*").alias("n"))
    if restrict is not None:
        sizes = sizes.join(restrict.select("user_id"), "user_id", "left_semi")
    if max_users is None:
        return sizes
    ranked = sizes.withColumn("_neg", -F.col("n"))
    return head_by_order(ranked, ["_neg", "user_id"], max_users).drop("_neg")


def _ideal(size: Column, k: int) -> Column:
    """Best possible discounted gain with ``size`` relevant items among k places."""
    places = F.sequence(F.lit(1), F.least(size, F.lit(k)).cast("int"))
    return F.aggregate(places, F.lit(0.0), lambda s, i: s + F.lit(1.0) / F.log2(i + 1.0))


def per_user_metrics(
    recs: DataFrame, truth: DataFrame, k_values: Sequence[int] = (10, 20), by: Sequence[str] = ()
) -> DataFrame:
    """recall@k, ndcg@k and hit@k per truth user, all k in one pass.

    ``by`` names extra key columns present in both tables (such as a variant). Users without
    recommendations count 0. Hits aggregate map-side, so a user with a huge truth is no hot spot.
    """
    keys = [*by, "user_id"]
    ranked = recs.groupBy(*keys, "item_id").agg(F.min("rank").alias("rank"))
    rows = truth.select(*keys, "item_id").join(ranked, [*keys, "item_id"], "left")
    gain = F.lit(1.0) / F.log2(F.col("rank") + 1.0)
    aggs = [F.count("*").alias("n_truth")]
    for k in k_values:
        hit = F.col("rank") <= k
        aggs += [
            F.count_if(hit).alias(f"_h{k}"),
            F.coalesce(F.sum(F.when(hit, gain)), F.lit(0.0)).alias(f"_g{k}"),
        ]
    out = rows.groupBy(*keys).agg(*aggs)
    for k in k_values:
        out = (
            out.withColumn(f"recall@{k}", F.col(f"_h{k}") / F.col("n_truth"))
            .withColumn(f"ndcg@{k}", F.col(f"_g{k}") / _ideal(F.col("n_truth"), k))
            .withColumn(f"hit@{k}", (F.col(f"_h{k}") > 0).cast("double"))
        )
    return out.drop(*[f"_{p}{k}" for k in k_values for p in ("h", "g")])


def evaluate_ranking(
    recs: DataFrame, truth: DataFrame, k_values: Sequence[int] = (10, 20), by: Sequence[str] = ()
) -> DataFrame:
    """Mean of every metric over the truth users."""
    users = per_user_metrics(recs, truth, k_values, by)
    names = [f"{m}@{k}" for m in METRICS for k in sorted(k_values)]
    means = [F.coalesce(F.avg(F.col(f"`{n}`")), F.lit(0.0)).alias(n) for n in names]
    return users.groupBy(*by).agg(*means, F.count("*").alias("n_users"))


def recall_at_k(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    return per_user_metrics(recs, truth, [k]).select("user_id", F.col(f"`recall@{k}`").alias("recall"))


def hit_rate_at_k(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    return per_user_metrics(recs, truth, [k]).select("user_id", F.col(f"`hit@{k}`").alias("hit"))


def ndcg_at_k(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    return per_user_metrics(recs, truth, [k]).select("user_id", F.col(f"`ndcg@{k}`").alias("ndcg"))


def coverage(recs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Share of the catalog that was recommended to anyone."""
    shown = recs.select("item_id").distinct().withColumn("_r", F.lit(True))
    return (
        catalog.select("item_id")
        .distinct()
        .join(shown, "item_id", "left")
        .agg(
            F.count_if("_r").alias("recommended"),
            F.count("*").alias("catalog_size"),
        )
        .withColumn(
            "coverage",
            F.coalesce(F.try_divide(F.col("recommended"), F.col("catalog_size")), F.lit(0.0)),
        )
    )


def diversity_category(recs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Mean over users of distinct categories in the top k over k; users with none are skipped."""
    cats = items.select("item_id", "category").where(F.coalesce("category", F.lit("")) != "")
    per_user = (
        recs.where(F.col("rank") <= k)
        .join(cats, "item_id")
        .groupBy("user_id")
        .agg((F.count_distinct("category") / F.lit(float(k))).alias("v"))
    )
    return per_user.agg(F.coalesce(F.avg("v"), F.lit(0.0)).alias("diversity"))


def mean_list_len(recs: DataFrame) -> DataFrame:
    sizes = recs.groupBy("user_id").agg(F.count("*").alias("n"))
    return sizes.agg(F.coalesce(F.avg("n"), F.lit(0.0)).alias("mean_len"))


def summarize(metrics: DataFrame, decimals: int = 4) -> DataFrame:
    """One line ``name: value | ...`` in name order from a one-row metrics table."""
    names = sorted(metrics.columns)
    parts = [
        F.format_string(f"%s: %.{decimals}f", F.lit(n), F.col(f"`{n}`").cast("double")) for n in names
    ]
    return metrics.select(F.concat_ws(" | ", *parts).alias("summary"))


def popular_recs_for_users(scores: DataFrame, users: DataFrame, k: int) -> DataFrame:
    """The same popularity list for every user: k rows attached to each, without a join."""
    top = scores.orderBy(F.desc("score"), "item_id").limit(k)
    listed = top.agg(
        F.array_sort(
            F.collect_list(F.struct((-F.col("score")).alias("neg"), F.col("item_id")))
        ).alias("l")
    )  # k entries
    return users.select("user_id", F.posexplode(listed.scalar()).alias("p", "e")).select(
        "user_id", F.col("e.item_id").alias("item_id"), (F.col("p") + 1).alias("rank")
    )


def sample_common_users(train: DataFrame, test: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Seeded sample of the users present on both sides."""
    both = train.select("user_id").intersect(test.select("user_id"))
    hashed = both.withColumn("_h", seeded_order(both, ["user_id"], seed))
    return head_by_order(hashed, ["_h", "user_id"], n).drop("_h")
