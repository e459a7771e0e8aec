"""Benchmark decontamination in DataFrame operations only.

1. Places of a document whose word shingle stands in some benchmark item give windows of that
   item's size, aligned with it; items of fewer words than a shingle are looked up at their own width. No window with a similarity above zero is without such a place.
2. Windows (equal ones once) and items get 64-bit SimHash fingerprints of their weighted shingles.
3. Multi-index Hamming join: of ``BLOCKS`` parts of the fingerprint at least one differs in at most
   radius // BLOCKS bits when the whole differs in at most the radius. Items are filed under every value
   that close to each part, windows under their own parts, so no fingerprint within the radius is missed.
   A fingerprint sums square roots of weights: weighted Jaccard J then bounds the cosine by 2J / (1 + J),
   and the radius is the number of bits that a pair of similarity J exceeds with a chance of ``MISS``.
4. Exact weighted Jaccard of the shingle sets decides. A shingle weighs ln(1 + items / items that have
   it), in thousandths; one that no item has weighs as much as one that a single item has.

Defined cases: null and empty documents or items match nothing; a text with fewer words than a
shingle is one shingle; repeated documents and items each get their rows; equal similarities take
the first window; extra columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import store

SHINGLE = 5
SIMILARITY = 0.8
#: Of a join that is given no radius; leaks() takes it from the similarity.
RADIUS = 15
BLOCKS = 8
#: Chance that a pair just similar enough differs in more bits than the radius.
MISS = 2e-5
#: A table is sent to all tasks only up to this many counted rows; larger ones are shuffled.
SMALL_ROWS = 500_000
_BLANK = "\\u0020\\u0009\\u000A\\u000B\\u000C\\u000D"


def words_of(text: str) -> Column:
    """Lower-case words of a text column; empty array for null or blank texts."""
    trimmed = F.expr(f"btrim(lower(`{text}`), '{_BLANK}')")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>"))


def shingle_rows(df: DataFrame, words: str, n: int, keep: list[str]) -> DataFrame:
    """One row per shingle: ``keep``, at (word position), h. Shorter texts are one shingle."""
    size = F.size(words)
    shifted = [F.slice(words, F.lit(k + 1), F.greatest(size - (n - 1), F.lit(0))) for k in range(n)]
    long = df.where(size >= n).select(*keep, F.posexplode(F.arrays_zip(*[s.alias(f"w{k}") for k, s in enumerate(shifted)])).alias("at", "_gram"))
    long = long.select(*keep, "at", F.xxhash64(*[F.col(f"_gram.{c}") for c in long.schema["_gram"].dataType.fieldNames()]).alias("h"))
    short = df.where((size > 0) & (size < n)).select(*keep, F.lit(0).alias("at"), F.xxhash64(words).alias("h"))
    return long.unionAll(short)


def _checked(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Marked for broadcast if it is counted to be small; otherwise Spark shuffles both sides."""
    return F.broadcast(df) if df.count() <= limit else df


def weights(items: DataFrame) -> DataFrame:
    """h, weight of every shingle that an item has."""
    n = items.select("item").distinct().agg(F.count("*").alias("n"))
    df = items.groupBy("h").agg(F.countDistinct("item").alias("df"))
    return df.crossJoin(F.broadcast(n)).select("h", F.round(F.log1p(F.col("n") / F.col("df")) * 1000).cast("long").alias("weight"))


def radius_of(similarity: float, miss: float = MISS) -> int:
    """Bits of 64 that fingerprints of a pair of at least this similarity exceed with a chance of ``miss``."""
    p = math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi
    tail, radius = 1.0, -1
    while tail > miss and radius < 64:
        radius += 1
        tail -= math.comb(64, radius) * p**radius * (1 - p) ** (64 - radius)
    return radius


def fingerprints(rows: DataFrame, key: str, prefix: str) -> DataFrame:
    """key, simhash of the distinct weighted shingles (key, h, weight), by square roots of the weights."""
    part = F.col("root")
    bits = [F.sum(F.when(F.shiftright("h", b).bitwiseAND(1) == 1, part).otherwise(-part)).alias(f"b{b}") for b in range(64)]
    summed = rows.withColumn("root", F.round(F.sqrt("weight") * 1000).cast("long")).groupBy(key).agg(*bits)
    parts = [F.shiftleft((F.col(f"b{b}") > 0).cast("long"), b) for b in range(64)]
    value = parts[0]
    for p in parts[1:]:
        value = value.bitwiseOR(p)
    return summed.select(key, value.alias(prefix))


def block_keys(value: str, near: bool, radius: int = RADIUS, blocks: int = BLOCKS) -> Column:
    """Array of (block, value of the block); with ``near`` also all values radius // blocks bits away."""
    width = 64 // blocks
    mask = (1 << width) - 1
    masks = [0]
    for _ in range(radius // blocks if near else 0):
        masks = sorted({m ^ (1 << b) for m in masks for b in range(width)} | set(masks))
    return F.array(
        *(
            F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(value, k * width).bitwiseAND(mask).bitwiseXOR(m).alias("part"))
            for k in range(blocks)
            for m in masks
        )
    )


def hamming_candidates(left: DataFrame, right: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All pairs (w, item) whose fingerprints (fp, item_fp) differ in at most ``radius`` bits."""
    a = left.select("w", "fp", F.explode(block_keys("fp", False, radius, blocks)).alias("k")).select("w", "fp", "k.*")
    b = right.select("item", "item_fp", F.explode(block_keys("item_fp", True, radius, blocks)).alias("k")).select("item", "item_fp", "k.*")
    met = a.join(b, ["block", "part"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    return met.select("w", "item").distinct()


def leaks(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, n: int = SHINGLE,
    radius: int | None = None, blocks: int = BLOCKS,
) -> DataFrame:
    """doc_id, item_id, start (word), n_words of the best window of each item in each document, similarity.

    Without a ``radius`` it follows from the similarity.
    """
    radius = radius_of(similarity) if radius is None else radius
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "row", F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    )
    items = benchmark.select("item_id", words_of("text").alias("words")).where(F.size("words") > 0)
    # Equal items are one; their ids come back at the end.
    items = items.withColumn("item", F.xxhash64("words"))
    ids = items.select("item", "item_id")
    items = items.dropDuplicates(["item"]).select("item", "words", F.size("words").alias("n_item"))
    of_items = store(shingle_rows(items, "words", n, ["item", "n_item"]), "item-shingles")
    weight = store(weights(of_items), "item-weights")

    # 1. Places that share a shingle with an item, then windows aligned with it.
    known = _checked(weight.select("h"))
    split = docs.select("row", words_of("text").alias("words"))
    of_docs = shingle_rows(split, "words", n, ["row"])
    for r in items.where(F.col("n_item") < n).select("n_item").distinct().collect():
        of_docs = of_docs.unionAll(shingle_rows(split.where(F.size("words") >= r["n_item"]), "words", r["n_item"], ["row"]))
    places = store(of_docs.join(known, "h"), "places")
    # Items that share a shingle at the same place ask for the same windows: each place meets an offset once.
    offsets = of_items.select("h", F.col("at").alias("offset"), "n_item").distinct()
    aligned = places.join(offsets, "h").select("row", (F.col("at") - F.col("offset")).alias("start"), "n_item").distinct()
    aligned = store(aligned, "windows")
    rows = _checked(aligned.select("row").distinct())
    texts = docs.join(rows, "row", "left_semi").dropDuplicates(["row"]).select("row", words_of("text").alias("words"))
    begin, stop = F.greatest("start", F.lit(0)), F.least(F.col("start") + F.col("n_item"), F.size("words"))
    windows = aligned.join(texts, "row").select(
        "row", begin.alias("start"), (stop - begin).alias("n_words"), F.slice("words", begin + 1, stop - begin).alias("words")
    )
    windows = store(windows.withColumn("w", F.xxhash64("words")), "window-words")
    contents = windows.groupBy("w").agg(F.first("words").alias("words"))

    # 2. Fingerprints of distinct shingles with weights.
    top = weight.agg(F.max("weight").alias("top"))
    of_windows = shingle_rows(contents, "words", n, ["w"]).select("w", "h").distinct()
    of_windows = store(
        of_windows.join(weight, "h", "left").crossJoin(F.broadcast(top)).select("w", "h", F.coalesce("weight", "top").alias("weight")),
        "window-shingles",
    )
    in_items = store(of_items.select("item", "h").distinct().join(weight, "h"), "item-weighed")
    # Written by themselves: sums over 64 bits make long plans, which the driver would plan again with each step of the join.
    left = store(fingerprints(of_windows, "w", "fp"), "window-prints")
    right = store(fingerprints(in_items, "item", "item_fp"), "item-prints")

    # 3. and 4. Candidates within the radius, decided by the shingles themselves.
    near = store(hamming_candidates(left, right, radius, blocks), "near")
    both = (
        near.join(of_windows.withColumnRenamed("weight", "shared"), "w")
        .join(in_items.select("item", "h"), ["item", "h"]).groupBy("w", "item").agg(F.sum("shared").alias("shared"))
    )
    sums = of_windows.groupBy("w").agg(F.sum("weight").alias("of_window"))
    item_sums = in_items.groupBy("item").agg(F.sum("weight").alias("of_item"))
    both = store(both, "shared")
    scored = both.join(sums, "w").join(item_sums, "item").select(
        "w", "item", (F.col("shared") / (F.col("of_window") + F.col("of_item") - F.col("shared"))).alias("similarity")
    ).where(F.col("similarity") >= similarity)
    found = windows.select("row", "start", "n_words", "w").join(scored, "w").groupBy("row", "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n_words")).alias("best")
    )
    return (
        docs.select("doc_id", "row").join(store(found, "leaks"), "row").join(ids, "item")
        .select("doc_id", "item_id", (-F.col("best.before")).alias("start"), "best.n_words", "best.similarity")
    )
