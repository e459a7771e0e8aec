"""Train-and-evaluate flows over prepared splits."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tastemill.operators.models import als_factors, fit_als, implicit_matrix, popularity
from tastemill.operators.ranking_metrics import (
    coverage,
    diversity_category,
    evaluate_ranking,
    ground_truth,
    popular_recs_for_users,
    select_eval_users,
)
from tastemill.operators.retrieval import retrieve_top_k, seen_items
from tastemill.schemas import DEFAULTS, Settings
from tastemill.session import materialize


def _report(recs, truth, items, catalog, settings: Settings) -> DataFrame:
    """Ranking metrics, coverage and diversity as one row."""
    row = evaluate_ranking(recs, truth, settings.eval_k)
    cov = coverage(recs, catalog).select("coverage")
    div = diversity_category(recs, items, settings.eval_k[0])
    return row.withColumn("coverage", cov.scalar()).withColumn("diversity", div.scalar())


def evaluation_set(
    train: DataFrame, test: DataFrame, settings: Settings = DEFAULTS
) -> tuple[DataFrame, DataFrame]:
    """Truth of the richest known users, and the catalog of trained items."""
    catalog = train.select("item_id").distinct()
    truth = materialize(ground_truth(test, train, catalog), "truth")
    known = train.select("user_id").distinct()
    users = select_eval_users(truth, settings.eval_max_users, known).select("user_id")
    return truth.join(users, "user_id", "left_semi"), catalog


def train_popularity(
    train: DataFrame, test: DataFrame, items: DataFrame, settings: Settings = DEFAULTS, recency: bool = False
) -> DataFrame:
    truth, catalog = evaluation_set(train, test, settings)
    scores = popularity(train, recency, settings)
    users = truth.select("user_id").distinct()
    recs = materialize(popular_recs_for_users(scores, users, settings.top_k), "recs")
    return _report(recs, truth, items, catalog, settings)


def als_recommend(
    user_vectors: DataFrame, item_vectors: DataFrame, users: DataFrame, seen: DataFrame, k: int
) -> DataFrame:
    """Top-k unseen items per user by factor product; users without factors get no rows."""
    wanted = user_vectors.join(users.select("user_id"), "user_id", "left_semi")
    mine = seen.join(users.select("user_id"), "user_id", "left_semi")
    hits = retrieve_top_k(
        wanted.withColumnRenamed("user_id", "query_id"),
        item_vectors,
        k,
        mine.withColumnRenamed("user_id", "query_id"),
        seen_mode="drop",
        metric="dot",
    )
    return hits.withColumnRenamed("query_id", "user_id")


def train_als(
    train: DataFrame, test: DataFrame, items: DataFrame, settings: Settings = DEFAULTS, seed: int = 42
) -> DataFrame:
    truth, catalog = evaluation_set(train, test, settings)
    matrix = materialize(implicit_matrix(train, settings), "matrix")
    user_vectors, item_vectors = als_factors(*fit_als(matrix, settings, seed))
    users = truth.select("user_id").distinct()
    recs = als_recommend(
        user_vectors, item_vectors, users, seen_items(train, catalog), settings.top_k
    )
    return _report(materialize(recs, "recs"), truth, items, catalog, settings)


def evaluate_retrieval(
    train: DataFrame,
    test: DataFrame,
    user_vectors: DataFrame,
    item_vectors: DataFrame,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Ranking metrics of given vectors over the richest users seen in train.

    Catalog: items that have a vector. Train items of a user are masked out of their list.
    """
    catalog = item_vectors.select("item_id")
    truth = materialize(ground_truth(test, train, catalog), "truth")
    known = train.select("user_id").distinct()
    users = select_eval_users(truth, settings.eval_max_users, known).select("user_id")
    truth = truth.join(users, "user_id", "left_semi")
    wanted = user_vectors.join(users, "user_id", "left_semi")
    seen = seen_items(train, catalog).join(users, "user_id", "left_semi")
    recs = retrieve_top_k(
        wanted.withColumnRenamed("user_id", "query_id"),
        item_vectors,
        max(settings.eval_k),
        seen.withColumnRenamed("user_id", "query_id"),
    ).withColumnRenamed("query_id", "user_id")
    return evaluate_ranking(recs, truth, settings.eval_k)

