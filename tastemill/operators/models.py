"""Popularity and factor models, training-set preparation and loss scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.functions.events import event_weight
from tastemill.functions.vectors import dot, l2_normalize, let, weighted_means, zeros
from tastemill.operators.ordering import head_by_order, with_global_index, with_group_running_total
from tastemill.operators.validate import apply_recency
from tastemill.schemas import DEFAULTS, Settings
from tastemill.session import materialize


def index_ids(df: DataFrame, column: str, name: str) -> DataFrame:
    """Contiguous 0-based integer per distinct id, in id order."""
    return with_global_index(df.select(column).distinct(), [column], name)


def implicit_matrix(interactions: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Summed event weight per (user, item): the sparse matrix as a long table."""
    return interactions.groupBy("user_id", "item_id").agg(
        F.sum(event_weight("event_type", settings.event_weights)).alias("r")
    )


def confidence(matrix: DataFrame, alpha: float) -> DataFrame:
    return matrix.withColumn("confidence", 1.0 + F.lit(float(alpha)) * F.col("r"))


def popularity(
    interactions: DataFrame, recency: bool = False, settings: Settings = DEFAULTS, reference=None
) -> DataFrame:
    """Summed weight per item, optionally decayed by age."""
    w = event_weight("event_type", settings.event_weights)
    rows = interactions
    if recency:
        rows = apply_recency(interactions, settings, reference, "_recency")
        w = w * F.col("_recency")
    return rows.groupBy("item_id").agg(F.sum(w).alias("score"))


def popular_items(scores: DataFrame, catalog: DataFrame, k: int = 20) -> DataFrame:
    """Top-k items with title and category; ids the catalog lacks vanish after the cut."""
    best = scores.orderBy(F.desc("score"), "item_id").limit(k)
    return best.join(catalog.select("item_id", "title", "category"), "item_id")


def fit_als(matrix: DataFrame, settings: Settings = DEFAULTS, seed: int = 42):
    """Implicit ALS on a long ``(user_id, item_id, r)`` table.

    Returns the model with the two id-to-index tables. Confidence 1 + alpha * r is formed inside
    the solver.
    """
    users = materialize(index_ids(matrix, "user_id", "user_idx"), "users")
    items = materialize(index_ids(matrix, "item_id", "item_idx"), "items")
    rated = (
        matrix.join(users, "user_id")
        .join(items, "item_id")
        .select(
            F.col("user_idx").cast("int").alias("user_idx"),
            F.col("item_idx").cast("int").alias("item_idx"),
            F.col("r").cast("float").alias("r"),
        )
    )
    als = ALS(
        rank=settings.als_factors,
        maxIter=settings.als_iterations,
        regParam=settings.als_regularization,
        alpha=settings.als_alpha,
        implicitPrefs=True,
        userCol="user_idx",
        itemCol="item_idx",
        ratingCol="r",
        checkpointInterval=10,
        seed=seed,
    )
    return als.fit(rated), users, items


def als_factors(model: ALSModel, users: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """User and item factor tables keyed by the original ids."""
    u = model.userFactors.join(users, F.col("id") == F.col("user_idx")).select(
        "user_id", F.col("features").alias("vector")
    )
    i = model.itemFactors.join(items, F.col("id") == F.col("item_idx")).select(
        "item_id", F.col("features").alias("vector")
    )
    return u, i


def _distinct_ranks(n: int, size, seed: int, *keys: str):
    """``n`` distinct places below ``size`` (all of them if there are fewer), every set of them equally likely.

    Floyd's method: the j-th step draws below ``size - n + j + 1`` and takes the last of these where the draw is taken.
    """
    take = F.least(F.lit(n).cast("bigint"), size)

    def step(chosen, j):
        top = size - take + j
        drawn = F.pmod(F.xxhash64(F.lit(seed), *keys, j), top + 1)
        return F.array_append(chosen, F.when(F.array_contains(chosen, drawn), top).otherwise(drawn))

    return F.when(take > 0, F.aggregate(F.sequence(F.lit(0).cast("bigint"), take - 1), F.array().cast("array<bigint>"), step))


def sample_negatives(
    positives: DataFrame, item_index: DataFrame, n: int, seed: int = 42
) -> DataFrame:
    """Per positive ``(pos_id, user_id, item_id)``, ``n`` distinct items its user never touched.

    One law for all users: each positive draws a uniform set of ranks among its user's unseen items, and a rank
    becomes a catalog position by the number of seen positions before it. If ``s(i)`` is the i-th seen position,
    ``s(i) - i`` unseen items lie before it, so the position of rank ``r`` is ``r`` plus the number of i with
    ``s(i) - i <= r``. Both counts are running totals over (user, position), which no single task holds for a user.

    Users who have seen the whole catalog draw from all of it; a pool smaller than ``n`` is returned whole.
    """
    items = materialize(item_index.select("item_id", F.col("item_idx").cast("bigint").alias("item_idx")), "catalog")
    n_items = items.count()
    seen = positives.join(items, "item_id").select("user_id", "item_idx").distinct()
    seen = with_group_running_total(seen, ["user_id"], ["item_idx"], name="_i", total="n_seen")
    seen = materialize(seen.where(F.col("n_seen") < n_items), "seen")
    per_user = seen.groupBy("user_id").agg(F.max("n_seen").alias("n_seen"))
    size = F.lit(n_items).cast("bigint") - F.coalesce("n_seen", F.lit(0))
    drawn = positives.select("pos_id", "user_id").join(per_user, "user_id", "left").select(
        "pos_id", "user_id", F.explode(_distinct_ranks(n, size, seed, "pos_id", "user_id")).alias("_at")
    )
    # Seen positions sort before the ranks they precede and carry the weight.
    events = drawn.withColumn("_w", F.lit(0).cast("bigint")).unionByName(
        seen.select(
            F.lit(None).cast(positives.schema["pos_id"].dataType).alias("pos_id"), "user_id",
            (F.col("item_idx") - F.col("_i")).alias("_at"), F.lit(1).cast("bigint").alias("_w"),
        )
    ).withColumn("_draw", F.lit(1) - F.col("_w"))
    ranked = with_group_running_total(events, ["user_id"], ["_at", "_draw", "pos_id"], weight="_w", name="_before", total="_all")
    placed = ranked.where(F.col("_draw") == 1).select("pos_id", "user_id", (F.col("_at") + F.col("_before")).alias("item_idx"))
    return placed.join(items, "item_idx").select("pos_id", "user_id", "item_id")


def contrastive_loss(
    positives: DataFrame, negatives: DataFrame, user_vectors: DataFrame, item_vectors: DataFrame
) -> DataFrame:
    """Mean -log softmax of each positive against its negatives, for given vectors.

    ``positives`` and ``negatives`` are ``(pos_id, user_id, item_id)``; vectors ``(.., vector)``.
    Pairs meet the vectors of their items first: popular items then crowd narrow rows, and the rows that carry
    a vector are dealt by user. Both vector tables are hashed in shares, so no row with a vector is sorted.
    """
    pairs = positives.select("pos_id", "user_id", "item_id", F.lit(True).alias("is_pos")).unionByName(
        negatives.select("pos_id", "user_id", "item_id", F.lit(False).alias("is_pos"))
    )
    scored = (
        pairs.join(item_vectors.select("item_id", F.col("vector").alias("_i")).hint("shuffle_hash"), "item_id")
        .join(user_vectors.select("user_id", F.col("vector").alias("_u")).hint("shuffle_hash"), "user_id")
        .select("pos_id", "is_pos", dot(F.col("_u"), F.col("_i")).alias("s"))
    )
    # One positive and K negatives per group; shifting by the largest keeps exp() in range.
    per = scored.groupBy("pos_id").agg(
        F.max(F.when(F.col("is_pos"), F.col("s"))).alias("s_pos"), F.collect_list("s").alias("ss")
    )
    lse = let(
        F.array_max("ss"),
        lambda top: top
        + F.log(F.aggregate("ss", F.lit(0.0), lambda acc, s: acc + F.exp(s - top))),
    )
    return (
        per.where(F.col("s_pos").isNotNull())
        .select((lse - F.col("s_pos")).alias("loss"))
        .agg(F.avg("loss").alias("loss"), F.count("*").alias("n"))
    )


def user_embedding(
    interactions: DataFrame,
    item_vectors: DataFrame,
    dim: int,
    settings: Settings = DEFAULTS,
    recency: bool = False,
) -> DataFrame:
    """Event-weighted mean of the vectors of each user's items; users without any get zeros.

    Weights are summed per (user, item) first, so a user's repeated events cost one vector each.
    """
    w = event_weight("event_type", settings.event_weights)
    rows = interactions
    if recency:
        rows = apply_recency(interactions, settings, name="_recency")
        w = w * F.col("_recency")
    weighted = rows.groupBy("user_id", "item_id").agg(F.sum(w).alias("w"))
    known = weighted.join(item_vectors.select("item_id", "vector"), "item_id")
    means = weighted_means(known, ["user_id"], "vector", F.col("w"), dim)
    users = interactions.select("user_id").distinct()
    return users.join(means, "user_id", "left").select(
        "user_id", F.coalesce("vector", zeros(F.lit(dim))).alias("vector")
    )


def mean_pool(tokens: DataFrame, dim: int, key: Sequence[str] = ("text_id",)) -> DataFrame:
    """Masked mean of the token vectors ``(key.., vector, mask)`` per text, scaled to unit length."""
    pooled = weighted_means(tokens, key, "vector", F.col("mask").cast("double"), dim)
    return pooled.select(*key, l2_normalize(F.col("vector")).alias("vector"))


def top_from_scores(scores: DataFrame, k: int) -> DataFrame:
    """The k best-scored items of one score table."""
    return head_by_order(scores.withColumn("_neg", -F.col("score")), ["_neg", "item_id"], k).drop("_neg")
