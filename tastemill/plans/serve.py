"""Search and hybrid recommendation over tables of requests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemill.functions.text import ITEM_TEXT_FIELDS, item_text, normalize_query, strip_accents
from tastemill.operators.keyword_index import KeywordIndex
from tastemill.operators.list_fusion import fuse_lists
from tastemill.operators.retrieval import enrich_with_catalog, retrieve_top_k, vector_search
from tastemill.operators.search import (
    folded_catalog,
    keyword_search,
    order_reranked,
    query_features,
    rerank,
    without,
)
from tastemill.operators.sparse_text import SparseText
from tastemill.operators.vector_index import VectorIndex
from tastemill.session import materialize, shuffled, spread

TEXT_DIM = 256
CANDIDATES = 50
#: Copies of each text's list, when requests meet the lists.
SHARES = 8
Encoder = Callable[[DataFrame], DataFrame]


def fit_text_encoder(items: DataFrame, dim: int = TEXT_DIM) -> PipelineModel:
    """Hashed TF-IDF vectors of unit length, fitted on the catalog's text."""
    texts = items.select(strip_accents(item_text(ITEM_TEXT_FIELDS)).alias("text"))
    stages = [
        RegexTokenizer(inputCol="text", outputCol="_w", pattern="[a-z0-9]+", gaps=False, minTokenLength=1),
        HashingTF(inputCol="_w", outputCol="_tf", numFeatures=dim),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="_unit"),
    ]
    return Pipeline(stages=stages).fit(texts)


def encode_text(model: PipelineModel, df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``vector`` (ARRAY<FLOAT>) for a text column."""
    ready = df.withColumn("text", strip_accents(F.col(text)))
    out = model.transform(ready).withColumn("vector", vector_to_array("_unit", "float32"))
    return out.select(*[c for c in df.columns], "vector")


def embed_items(items: DataFrame, encoder: PipelineModel | Encoder | None = None) -> DataFrame:
    """``(item_id, vector)`` of every item's text.

    Without an encoder the native text vectors are used; a function taking and returning a
    DataFrame (for instance around ``mapInPandas``) plugs in any other.
    """
    texts = items.select("item_id", item_text(ITEM_TEXT_FIELDS).alias("text"))
    if encoder is None:
        encoder = fit_text_encoder(items)
    if isinstance(encoder, PipelineModel):
        return encode_text(encoder, texts).select("item_id", "vector")
    return encoder(texts)


def known_words(texts: DataFrame, text: str, catalog: DataFrame) -> DataFrame:
    """``(text, known)``: the words of each text that the catalog's texts have, in their order.

    Texts without such a word are left out. The vocabulary is exact, whatever space the words are
    hashed to later.
    """

    def words(column):
        return F.regexp_extract_all(strip_accents(column), F.lit("[a-z0-9]+"), F.lit(0))

    vocabulary = catalog.select(F.explode(words(item_text(ITEM_TEXT_FIELDS))).alias("w")).distinct()
    placed = texts.select(text, F.posexplode(words(F.col(text))).alias("at", "w"))
    found = placed.join(vocabulary, "w").groupBy(text).agg(
        F.array_sort(F.collect_list(F.struct("at", "w"))).alias("l")
    )
    return found.select(text, F.concat_ws(" ", F.transform("l", lambda x: x["w"])).alias("known"))


def encode_queries(
    texts: DataFrame, text: str, catalog: DataFrame, encoder: PipelineModel | Encoder
) -> DataFrame:
    """``(query_id, vector)`` of distinct texts by the encoder that the items were embedded with.

    A function gets ``(item_id, text)`` and returns ``(item_id, vector)``, as for items. The native
    encoder sees only words of the catalog; a text without one has no vector.
    """
    if isinstance(encoder, PipelineModel):
        known = known_words(texts, text, catalog)
        return encode_text(encoder, known, "known").select(F.col(text).alias("query_id"), "vector")
    coded = encoder(texts.select(F.col(text).alias("item_id"), F.col(text).alias("text")))
    return coded.select(F.col("item_id").alias("query_id"), "vector")


def semantic_candidates(
    requests: DataFrame,
    catalog: DataFrame,
    item_vectors: DataFrame,
    encoder: PipelineModel | Encoder | SparseText,
    candidates: int = CANDIDATES,
    index: VectorIndex | None = None,
) -> DataFrame:
    """Re-ranked nearest items per request of ``(request_id, q)``; equal texts are scored once.

    A text that shares no word with the catalog, or whose nearest item has no positive cosine, gets
    no candidates. ``candidates`` nearest items of a text are re-ranked, found exactly or through an ``index``
    of the item vectors. With a ``SparseText`` encoder, ``item_vectors`` are its sparse vectors of the items.
    """
    texts = materialize(requests.select("q").distinct(), "texts")
    texts = texts.withColumn("normalized", normalize_query(F.col("q")))
    texts = materialize(texts.join(query_features(texts), "q"), "texts")
    asked = texts.select("normalized").distinct()
    if isinstance(encoder, SparseText):
        coded = encoder.encode(asked.select(F.col("normalized").alias("id"), F.col("normalized").alias("text")))
        near = encoder.search(coded.withColumnRenamed("id", "query_id"), item_vectors, candidates)
    else:
        coded = encode_queries(asked, "normalized", catalog, encoder)
        known = coded.where(F.exists("vector", lambda x: x != 0))
        near = index.search(known, candidates) if index else vector_search(known, item_vectors, candidates)
    near = near.select(F.col("query_id").alias("normalized"), "item_id", F.col("score").alias("semantic"))
    best = F.max("semantic").over(Window.partitionBy("normalized"))  # at most `candidates` rows
    near = near.withColumn("_best", best).where(F.col("_best") > 0).drop("_best")
    scored = rerank(texts.join(near, "normalized").join(shuffled(folded_catalog(spread(catalog))), "item_id"))
    return scored.select("q", "item_id", "title", "category", "final")


def semantic_lists(
    requests: DataFrame,
    catalog: DataFrame,
    item_vectors: DataFrame,
    encoder: PipelineModel | Encoder | SparseText,
    k: int = 20,
    cap_before_sort: bool = False,
    candidates: int = CANDIDATES,
    index: VectorIndex | None = None,
) -> DataFrame:
    """The ``k`` best re-ranked items of each distinct text ``q`` of the requests."""
    scored = semantic_candidates(requests, catalog, item_vectors, encoder, max(k, candidates), index)
    best = order_reranked(scored.withColumnRenamed("q", "request_id"), k, cap_before_sort)
    return best.withColumnRenamed("request_id", "q")


def semantic_search(
    requests: DataFrame,
    catalog: DataFrame,
    item_vectors: DataFrame,
    encoder: PipelineModel | Encoder | SparseText,
    k: int = 20,
    cap_before_sort: bool = False,
    candidates: int = CANDIDATES,
    index: VectorIndex | None = None,
) -> DataFrame:
    best = semantic_lists(requests, catalog, item_vectors, encoder, k, cap_before_sort, candidates, index)
    return requests.join(best, "q").select(
        "request_id", "q", "rank", "item_id", "title", "category", "score", "final"
    )


def search_with_fallback(
    requests: DataFrame,
    catalog: DataFrame,
    item_vectors: DataFrame | None,
    encoder: PipelineModel | Encoder | SparseText | None,
    index: VectorIndex | None = None,
    keywords: KeywordIndex | None = None,
) -> DataFrame:
    """Semantic search, and keyword search for the requests it leaves unanswered."""
    cols = ["request_id", "q", "rank", "item_id", "title", "category", "score"]
    if item_vectors is None or encoder is None:
        return keyword_search(requests, catalog, index=keywords).select(*cols, F.lit("keyword").alias("source"))
    # Lists are kept by text: requests are many more rows, and meet their lists only as they are returned.
    best = materialize(semantic_lists(requests, catalog, item_vectors, encoder, index=index), "semantic")
    answered = requests.join(shuffled(best.where("rank = 1").select("q")), "q", "left_semi")
    rest = keyword_search(materialize(without(requests, answered), "rest"), catalog, index=keywords)
    # Many requests may share one text: they are dealt to SHARES groups, each with its copy of the lists.
    share = F.pmod(F.xxhash64("request_id"), F.lit(SHARES)).cast("int")
    lists = best.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    return (
        requests.withColumn("_share", share).join(shuffled(lists), ["q", "_share"])
        .select(*cols)
        .withColumn("source", F.lit("semantic"))
        .unionByName(rest.select(*cols).withColumn("source", F.lit("keyword")))
    )


def hybrid_recommend(
    requests: DataFrame,
    catalog: DataFrame,
    text_vectors: DataFrame,
    encoder: PipelineModel | Encoder | SparseText,
    user_vectors: DataFrame,
    item_vectors: DataFrame,
    k: int = 10,
    depth: int = 20,
    text_index: VectorIndex | None = None,
    item_index: VectorIndex | None = None,
) -> DataFrame:
    """Fuse intent and personal rankings per ``(request_id, user_id, q, preset)``.

    Both sides give their first ``depth`` items, or ``k`` if that is more, found exactly or through an index of
    the text or item vectors. Unknown users get the intent side alone; a request with neither side gets the catalog head.
    """
    depth = max(k, depth)
    # Both lists are made once for each text and each user; requests meet them only as they are blended.
    requests = materialize(requests.select("request_id", "user_id", "q", "preset"), "requests")
    sem = semantic_lists(requests, catalog, text_vectors, encoder, depth, cap_before_sort=True, index=text_index)
    sem = materialize(sem.select("q", "item_id", F.col("final").alias("score")), "intent")
    asked = requests.select("user_id").distinct()
    known = user_vectors.join(asked, "user_id", "left_semi").withColumnRenamed("user_id", "query_id")
    near = item_index.search(known, depth) if item_index else retrieve_top_k(known, item_vectors, depth)
    per = enrich_with_catalog(near.withColumnRenamed("query_id", "user_id"), catalog)
    per = materialize(per.select("user_id", "item_id", "score"), "personal")
    return fuse_lists(requests, sem, per, catalog, k, depth)
