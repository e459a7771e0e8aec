"""Line dedup in DataFrame operations only: keep bitmaps from one range sort of line hashes.

1. Every line becomes a row (document, position, hash of its key). The key is the line without blanks
   at both ends and with A-Z lower-cased.
2. Rows are range-partitioned by hash and sorted by hash, document and position. One pass over the sorted
   rows finds the first line of each document under a key (its number of documents) and the very first line.
3. Lines that go are packed into 64-bit words per document: a bitmap that lists only the words of 64 lines
   that lose a line. Texts are neither sorted nor returned by this step; ``apply_bitmaps`` cuts them.

A key that many lines share is cut into slices by document, so that no task holds more than its share. A
sketch over all rows (``approx_top_k``) names such keys; it decides only where rows are sorted, not what goes.

Defined cases: a null or empty text is one empty line; the empty key has 0 code points, so it never goes
while ``min_chars`` is 1 or more; rows that share a doc_id are one document when documents are counted, rows
without a doc_id together are one as well, but each text loses its own lines; repeated rows get the same result each;
extra columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemill.llm.common import partitions, store

MIN_DOCS = 10
MIN_CHARS = 1
#: Lines per word of a bitmap.
WORD = 64
_BLANK = " \\t\\n\\u000B\\f\\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    """The line without blanks around it, A-Z lower-cased and nothing else."""
    bare = F.btrim(line, F.expr(f"'{_BLANK}'"))
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, text, d (document), t (hash of the text): d and t name a row, equal rows equally."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("d", F.coalesce("doc_id", F.lit(_NO_ID).cast("long"))).withColumn("t", F.xxhash64("text"))


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """d, t, at (position), h, h2: one row per line whose key has at least ``min_chars`` code points."""
    lines = _named(docs).select("d", "t", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    keyed = lines.select("d", "t", "at", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keyed.select("d", "t", "at", F.xxhash64("key").alias("h"), F.hash("key").alias("h2"))


def crowded(lines: DataFrame, parts: int) -> DataFrame:
    """h of the keys that hold more than a quarter of a partition's fair share of the rows, at most 4 * parts of them.

    From 1024 partitions on the bar stays at one in 4096 rows.
    """
    tracked = min(16 * parts, 16_384)
    # Sketches of fixed size; those of many tasks meet in groups first.
    some = lines.select("h", F.pmod(F.spark_partition_id(), F.lit(64)).alias("g"))
    part = some.groupBy("g").agg(F.count("*").alias("n"), F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("sketch"))
    top = part.groupBy(F.lit("all").alias("all")).agg(F.sum("n").alias("n"), F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch), {tracked // 4})").alias("top"))
    return top.select("n", F.explode("top").alias("x")).where(F.col("x.count") * (tracked // 4) > F.col("n")).select("x.item").toDF("h")


def repeated_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False
) -> DataFrame:
    """d, t, at of the lines that go: those whose key stands in ``min_docs`` documents or more.

    With ``keep_first`` the first line under each key, by document and position, stays.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    lines = store(line_rows(docs, min_chars), "lines")
    hot = F.broadcast(crowded(lines, parts).withColumn("hot", F.lit(True)))
    slice_of = F.when(F.col("hot"), F.pmod(F.xxhash64("d"), F.lit(parts))).otherwise(-1).cast("int")
    placed = lines.join(hot, "h", "left").withColumn("slice", slice_of).drop("hot")
    order = ["d", "t", "at"]
    ranged = placed.repartitionByRange("h", "slice").sortWithinPartitions("h", "slice", "h2", *order)
    # The range partitioning and the sort already serve these windows: no further shuffle.
    group = Window.partitionBy("h", "slice", "h2")
    passing = group.orderBy(*order)
    before = F.lag("d").over(passing)
    seen = ranged.withColumn("opens", (before.isNull() | (before != F.col("d"))).cast("int"))
    seen = seen.withColumn("head", F.row_number().over(passing) == 1).withColumn("n_docs", F.sum("opens").over(group))
    sliced = F.col("slice") >= 0
    seen = seen.where(sliced | (F.col("n_docs") >= min_docs))
    seen = store(seen.select("h", "h2", "slice", *order, "head", "n_docs"), "repeated-lines")
    whole = seen.where(~sliced)
    # The documents of a sliced key are those of its slices, which share none.
    totals = seen.where(sliced & F.col("head")).groupBy("h", "h2").agg(
        F.sum("n_docs").alias("all_docs"), F.min(F.struct(*order)).alias("lead")
    )
    # Sliced keys come from the list of crowded ones, which has a fixed size.
    cut = seen.where(sliced).join(F.broadcast(totals.where(F.col("all_docs") >= min_docs)), ["h", "h2"])
    if keep_first:
        whole = whole.where(~F.col("head"))
        cut = cut.where(F.struct(*order) != F.col("lead"))
    return whole.select(*order).unionByName(cut.select(*order))


def keep_bitmaps(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False
) -> DataFrame:
    """d, t, keep: per text that loses lines, (word, bits) of every 64 lines that lose some, in order.

    Bit b of word w is 1 if line 64 * w + b stays; words that are not listed keep all lines. ``d`` and ``t`` are the
    document and the hash of its text.
    """
    gone = repeated_lines(docs, min_docs, min_chars, keep_first)
    # One shuffle by text; the words of a text never exceed a sixty-fourth of its lines.
    gone = gone.repartition(partitions(docs.sparkSession), "d", "t")
    bit = F.expr(f"shiftleft(1L, cast(at % {WORD} AS int))")
    words = gone.groupBy("d", "t", F.expr(f"cast(at div {WORD} AS int)").alias("word")).agg(F.bit_or(bit).alias("gone"))
    entry = F.struct("word", F.bitwise_not("gone").alias("bits"))
    return words.groupBy("d", "t").agg(F.array_sort(F.collect_list(entry)).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text, kept_sha256: texts cut by their keep bitmaps."""
    # Dense words up to the last listed one, so that a line finds its bit by position.
    dense = F.flatten(
        F.transform("keep", lambda x, i: F.concat(F.array_repeat(F.lit(-1).cast("long"), _gap(x, i)), F.array(x["bits"])))
    )
    lost = F.aggregate("keep", F.lit(0).cast("long"), lambda s, x: s + (F.lit(WORD) - F.bit_count(x["bits"])).cast("long"))
    bits = store(bitmaps.select("d", "t", dense.alias("bits"), lost.alias("n_dropped")), "keep-bitmaps")
    joined = _named(docs).join(bits, ["d", "t"], "left")
    stays = F.expr(
        f"filter(split(text, '\\n'), (x, i) -> (shiftright(coalesce(get(bits, i div {WORD}), -1L), i % {WORD}) & 1L) = 1L)"
    )
    kept = F.when(F.col("bits").isNull(), F.col("text")).otherwise(F.array_join(stays, "\n"))
    out = joined.select(
        "doc_id", F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept_text"),
    )
    return out.withColumn("kept_sha256", F.sha2("kept_text", 256))


def _gap(x: Column, i: Column) -> Column:
    """Words between an entry and the one before it."""
    before = F.when(i == 0, F.lit(-1)).otherwise(F.col("keep")[i - 1]["word"])
    return x["word"] - before - 1


def drop_repeated_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False
) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text, kept_sha256."""
    return apply_bitmaps(docs, keep_bitmaps(docs, min_docs, min_chars, keep_first))
