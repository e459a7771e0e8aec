"""Catalog search, metadata re-ranking and score fusion for tables of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.functions.text import (
    content_tokens,
    detect_categories,
    normalize_query,
    strip_accents,
)
from tastemill.operators.keyword_index import KeywordIndex, build_keyword_index
from tastemill.operators.ordering import top_k_per_group
from tastemill.session import materialize, shuffled

# Re-ranking bonuses, the cap on title evidence and the cap on the whole bonus.
CATEGORY_BONUS = 0.15
TITLE_TOKEN_BONUS = 0.05
TITLE_TOKEN_CAP = 0.10
TAG_BONUS = 0.03
DESCRIPTION_BONUS = 0.02
BONUS_CAP = 0.25

# Semantic share of a fused score per preset, with and without explicit intent.
FUSION_PRESETS = {"A": 0.70, "B": 0.50, "C": 0.30}
FUSION_STRONG = 0.70
FUSION_WEAK = 0.30

NO_CATEGORY_RANK = 9


def query_terms(queries: DataFrame) -> DataFrame:
    """Distinct search terms per query: the folded phrase and the tokens of its English form.

    The phrase looks at title, tags and description only; tokens also look at the category.
    """
    phrase = F.struct(F.lower(strip_accents(F.col("q"))).alias("term"), F.lit(False).alias("in_cat"))
    tokens = F.transform(
        content_tokens(normalize_query(F.col("q"))),
        lambda t: F.struct(t.alias("term"), F.lit(True).alias("in_cat")),
    )
    return (
        queries.select("q", F.explode(F.array_union(F.array(phrase), tokens)).alias("t"))
        .select("q", "t.term", "t.in_cat")
        .distinct()
    )


def keyword_search(
    queries: DataFrame, catalog: DataFrame, limit: int = 20, index: KeywordIndex | None = None
) -> DataFrame:
    """Items containing the query phrase or any of its content tokens, best categories first.

    ``queries`` is (request_id, q). Equal texts are searched once. Items go by the position of
    their category among those the query names (9 if none), then by id; the score is 1. Without a stored
    ``index`` of the catalog one is built for this call.
    """
    index = index or build_keyword_index(catalog)
    texts = materialize(queries.select("q").distinct(), "texts")
    terms = materialize(query_terms(texts), "terms")
    # An item among a query's first `limit` is among the first `limit` of its category for some
    # term, since within a category items go by id: the cut per term loses nothing.
    matches = index.matches(terms, limit)
    cats = texts.select(
        "q", F.transform(detect_categories(F.col("q")), lambda c: F.lower(c)).alias("cats")
    )
    at = F.array_position("cats", F.lower(F.trim(F.coalesce("cat", F.lit("")))))
    per_text = (
        terms.join(matches, ["term", "in_cat"])
        .select("q", "cat", "item_id")
        .distinct()
        .join(cats, "q")
        .withColumn("cat_rank", F.when(at > 0, at - 1).otherwise(F.lit(NO_CATEGORY_RANK)).cast("int"))
    )
    best = top_k_per_group(per_text, ["q"], [F.asc("cat_rank"), F.asc("item_id")], limit)
    shown = best.select("q", "item_id", "cat_rank", "rank", F.lit(1.0).alias("score")).join(
        catalog.select("item_id", "title", "category"), "item_id"
    )
    return queries.join(shown, "q").select(
        "request_id", "q", "item_id", "title", "category", "cat_rank", "rank", "score"
    )


def query_features(texts: DataFrame) -> DataFrame:
    """Content tokens and named categories of each distinct text ``q``."""
    return texts.select("q").distinct().select(
        "q",
        content_tokens(F.col("q")).alias("_tokens"),
        detect_categories(F.col("q")).alias("_cats"),
    )


def folded_catalog(items: DataFrame) -> DataFrame:
    """Catalog with accent-free copies of the texts re-ranking looks at."""

    def text(name: str) -> Column:
        return strip_accents(F.lower(F.coalesce(F.col(name), F.lit(""))))

    return (
        items.withColumn("_title", text("title"))
        .withColumn("_tags", text("tags"))
        .withColumn("_desc", text("text_description"))
    )


def rerank(candidates: DataFrame) -> DataFrame:
    """Add the six score components to ``(q, semantic, title, category, tags, text_description)``.

    A text's features are worked out once, however many candidates it has; candidates taken from a
    ``folded_catalog`` bring their folded texts with them.
    """
    if "_tokens" not in candidates.columns:
        candidates = candidates.join(query_features(candidates), "q")
    if "_title" not in candidates.columns:
        candidates = folded_catalog(candidates)

    def hits(name: str) -> Column:
        return F.size(F.filter("_tokens", lambda t: F.contains(F.col(name), t)))

    category = F.lower(F.trim(F.coalesce("category", F.lit(""))))
    rows = (
        candidates.withColumn("_hits", hits("_title"))
        .withColumn("category_match", F.exists("_cats", lambda c: F.lower(c) == category).cast("double"))
        .withColumn("tag_match", (hits("_tags") > 0).cast("double"))
        .withColumn("description_match", (hits("_desc") > 0).cast("double"))
        .withColumn(
            "title_match",
            F.least(F.lit(1.0), F.col("_hits") / F.greatest(F.lit(1), F.size("_tokens"))),
        )
    )
    bonus = F.least(
        F.lit(BONUS_CAP),
        F.lit(CATEGORY_BONUS) * F.col("category_match")
        + F.least(F.lit(TITLE_TOKEN_CAP), F.lit(TITLE_TOKEN_BONUS) * F.col("_hits"))
        + F.lit(TAG_BONUS) * F.col("tag_match")
        + F.lit(DESCRIPTION_BONUS) * F.col("description_match"),
    )
    return rows.withColumn("final", F.col("semantic") + bonus).drop(
        "_tokens", "_cats", "_title", "_tags", "_desc", "_hits"
    )


def minmax(df: DataFrame, by: str = "request_id", score: str = "score", name: str = "norm") -> DataFrame:
    """Scale scores to [0, 1] within each list; a list of equal scores becomes 0."""
    span = df.groupBy(by).agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    width = F.when(F.col("_hi") == F.col("_lo"), F.lit(1.0)).otherwise(F.col("_hi") - F.col("_lo"))
    return shuffled(df).join(span, by).withColumn(name, (F.col(score) - F.col("_lo")) / width).drop("_lo", "_hi")


def preset_weight(preset: Column) -> Column:
    """Semantic share that a preset fixes, null for any other."""
    out = None
    for name, weight in FUSION_PRESETS.items():
        out = (F if out is None else out).when(preset == name, F.lit(weight))
    return out


def fusion_weight(preset: Column, message: Column) -> Column:
    """Semantic share: the preset's, else weak for a message without category or content token."""
    generic = (F.size(detect_categories(message)) == 0) & (F.size(content_tokens(message)) == 0)
    return preset_weight(preset).when(generic, F.lit(FUSION_WEAK)).otherwise(F.lit(FUSION_STRONG))


def fuse_rankings(semantic: DataFrame, personal: DataFrame, weights: DataFrame, k: int = 10) -> DataFrame:
    """Blend two scored lists per request; a side that lacks an item counts 0.

    Lists are ``(request_id, item_id, score)``, weights ``(request_id, w_sem)``. Equal fused
    scores put semantic items first, then go by id.
    """
    sem = minmax(semantic, name="sem").select("request_id", "item_id", "sem")
    per = minmax(personal, name="per").select("request_id", "item_id", "per")
    both = (
        sem.join(per, ["request_id", "item_id"], "full")
        .join(shuffled(weights.select("request_id", "w_sem")), "request_id")
        .withColumn("from_sem", F.col("sem").isNotNull())
        .fillna(0.0, ["sem", "per"])
        .withColumn("fused", F.col("w_sem") * F.col("sem") + (1.0 - F.col("w_sem")) * F.col("per"))
        # Blends of the same parts must tie whichever way they were added up.
        .withColumn("_key", F.round("fused", 12))
    )
    best = top_k_per_group(
        both, ["request_id"], [F.desc("_key"), F.desc("from_sem"), F.asc("item_id")], k
    )
    return best.select("request_id", "item_id", "rank", F.round("fused", 4).alias("score"))


def order_reranked(scored: DataFrame, k: int = 20, cap_before_sort: bool = False) -> DataFrame:
    """Top-k re-ranked candidates per request; scores above 1 are capped before or after sorting."""
    key = F.least(F.lit(1.0), F.col("final")) if cap_before_sort else F.col("final")
    best = top_k_per_group(
        scored.withColumn("_key", F.round(key, 9)), ["request_id"], [F.desc("_key"), F.asc("item_id")], k
    )
    capped = F.least(F.lit(1.0), F.col("final"))
    return best.withColumn("score", F.round(capped, 4)).withColumn("final", capped).drop("_key")


def without(requests: DataFrame, other: DataFrame, key: str = "request_id") -> DataFrame:
    """Requests that the other result does not answer."""
    return requests.join(shuffled(other.select(key).distinct()), key, "left_anti")


__all__ = [
    "fuse_rankings",
    "fusion_weight",
    "keyword_search",
    "minmax",
    "order_reranked",
    "preset_weight",
    "query_terms",
    "rerank",
    "without",
]
