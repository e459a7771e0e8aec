"""Stored postings of three-character pieces of a catalog's texts, grown by batches.

Layout under the root folder, one subfolder per batch of items: ``items`` (folded texts), ``postings`` (gram, item_id)
and ``counts`` (gram, df). A batch is written once and counts as soon as its marker is there. An item that comes
again replaces its older text: the new text is looked up by its own pieces, and what the older
pieces still find is refused by the exact look at the current text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.functions.text import strip_accents
from tastemill.operators.ordering import top_k_per_group
from tastemill.session import materialize, scratch_path, shuffled, spread

FIELDS = ("title", "tags", "category", "text_description")
GRAM = 3
#: Two characters behind every text, so that a piece begins at each of its characters.
_PAD = "\\u0000\\u0000"
#: A second piece is looked up if it is at most this many times as frequent as the rarest.
SECOND = 8


def folded(name: str) -> Column:
    return F.lower(strip_accents(F.coalesce(F.col(name), F.lit(""))))


def _pieces(text: Column, last: Column) -> Column:
    """Distinct pieces that begin at the characters 1 to ``last``."""
    return F.when(
        last > 0,
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(GRAM)))),
    ).otherwise(F.array().cast("array<string>"))


class KeywordIndex:
    """Catalog texts by pieces, under a folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/batches"))

    def batches(self) -> list[str]:
        """Names of the batches in the order they were added."""
        found = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/batches"))]
        return [n.partition("-")[2] for n in sorted(found, key=lambda n: int(n.partition("-")[0]))]

    def add(self, name: str, catalog: DataFrame) -> bool:
        """File a batch of items; False if a batch of this name is there."""
        known = self.batches()
        if name in known:
            return False
        where, number = f"{self.root}/data/{name}", len(known)
        fields = [folded(c).alias(f"{c}_f") if c in catalog.columns else F.lit("").alias(f"{c}_f") for c in FIELDS]
        items = spread(catalog).select(F.col("item_id").cast("string").alias("item_id"), F.col("category").alias("cat"), *fields, F.lit(number).alias("batch"))
        items.write.mode("overwrite").parquet(f"{where}/items")
        items = self.spark.read.schema(items.schema).parquet(f"{where}/items")
        texts = [F.concat(F.col(f"{c}_f"), F.expr(f"'{_PAD}'")) for c in FIELDS]
        grams = F.array_distinct(F.flatten(F.array(*[_pieces(t, F.length(t) - 2) for t in texts])))
        postings = items.select("item_id", F.explode(grams).alias("gram")).repartition("gram").sortWithinPartitions("gram")
        postings.select("gram", "item_id").write.mode("overwrite").parquet(f"{where}/postings")
        counts = self.spark.read.schema("gram string, item_id string").parquet(f"{where}/postings").groupBy("gram")
        counts.agg(F.count("*").alias("df")).write.mode("overwrite").parquet(f"{where}/counts")
        out = self._fs.create(self._path(f"{self.root}/batches/{number}-{name}"), False)
        out.close()
        return True

    def _table(self, kind: str, schema: str) -> DataFrame:
        names = self.batches()
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/data/{n}/{kind}" for n in names))

    def items(self) -> DataFrame:
        """item_id, cat and folded texts, the last batch's for each item."""
        schema = "item_id string, cat string, " + ", ".join(f"{c}_f string" for c in FIELDS) + ", batch int"
        rows = self._table("items", schema)
        if len(self.batches()) > 1:
            rest = [c for c in rows.columns if c != "item_id"]
            rows = rows.groupBy("item_id").agg(F.max_by(F.struct(*rest), "batch").alias("r")).select("item_id", "r.*")
        return rows.drop("batch")

    def postings(self) -> DataFrame:
        rows = self._table("postings", "gram string, item_id string")
        return rows.distinct() if len(self.batches()) > 1 else rows

    def counts(self) -> DataFrame:
        """gram, df: items with the piece, at least."""
        rows = self._table("counts", "gram string, df long")
        return rows.groupBy("gram").agg(F.sum("df").alias("df")) if len(self.batches()) > 1 else rows

    def matches(self, terms: DataFrame, keep: int) -> DataFrame:
        """Per distinct (term, in_cat) and category, the ``keep`` first items containing the term.

        A containing item holds every piece of the term. Terms of three or more characters meet the items that hold
        their two rarest pieces, shorter ones those of all pieces that begin with them; the texts then decide.
        """
        asked = terms.select("term", "in_cat").distinct()
        counts, t = self.counts(), F.col("term")

        def cut(some: DataFrame) -> DataFrame:
            own = some.withColumn("gram", F.explode(_pieces(t, F.length("term") - (GRAM - 1)))).join(counts, "gram", "left")
            return own.withColumn("df", F.coalesce("df", F.lit(0)))

        # A piece no item holds: the term matches nothing. Most terms of long texts end here, before any sort.
        rarest = cut(asked.where(F.length("term") >= GRAM)).groupBy("term", "in_cat").agg(F.min("df").alias("least"))
        own = cut(materialize(rarest.where("least > 0").select("term", "in_cat"), "found-terms"))
        ranked = F.array_sort(F.collect_list(F.struct("df", "gram")))
        # A term has no more pieces than characters.
        best = own.groupBy("term", "in_cat").agg(F.slice(ranked, 1, 2).alias("best"))
        near = F.filter("best", lambda x: x["df"] <= F.col("best")[0]["df"] * SECOND)
        wanted = best.select("term", "in_cat", F.posexplode(near).alias("at", "b"), F.size(near).alias("n"))
        bits = F.when(F.col("at") == 0, 1).otherwise(2)
        wanted = wanted.select("term", "in_cat", "b.gram", bits.alias("bit"), F.when(F.col("n") == 1, 1).otherwise(3).alias("all"))
        for size in range(1, GRAM):
            short = asked.where(F.length("term") == size)
            begin = counts.select("gram", F.substring("gram", 1, size).alias("term"))
            wanted = wanted.unionByName(short.join(begin, "term").select("term", "in_cat", "gram", F.lit(1).alias("bit"), F.lit(1).alias("all")))
        wanted = materialize(wanted, "wanted")
        # Only postings of wanted pieces move; an item in several batches may come more than once, which its bits do not show.
        pieces = materialize(wanted.select("gram").distinct(), "pieces")
        held = self._table("postings", "gram string, item_id string").join(pieces, "gram", "left_semi")
        met = held.join(shuffled(wanted), "gram").groupBy("term", "in_cat", "item_id")
        pairs = met.agg(F.bit_or("bit").alias("found"), F.max("all").alias("all")).where("found = all").select("term", "in_cat", "item_id")
        inside = F.lit(False)
        for c in FIELDS:
            has = F.contains(F.col(f"{c}_f"), t)
            inside = inside | (has & F.col("in_cat") if c == "category" else has)
        hits = pairs.join(self.items(), "item_id").where(inside).select("term", "in_cat", "cat", "item_id")
        return top_k_per_group(hits, ["term", "in_cat", "cat"], [F.asc("item_id")], keep).drop("rank")


def build_keyword_index(catalog: DataFrame, root: str | None = None, name: str = "first") -> KeywordIndex:
    index = KeywordIndex(catalog.sparkSession, root or scratch_path(catalog.sparkSession, "keyword-index"))
    index.add(name, catalog)
    return index


__all__: Sequence[str] = ("FIELDS", "KeywordIndex", "build_keyword_index", "folded")
