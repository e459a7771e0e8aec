"""A table of vectors that takes change sets without being rewritten.

Layout under the root folder:

- ``changes/<id>/bucket=b``: one change set, its newest row per point, tombstones included
- ``commits/<name>``: marker of a committed change set, holding its folder
- ``base/gen=g/bucket=b``: merged rows
- ``heads/<n>``: which generation each bucket of the base is read from, and the change sets merged into it

A change set counts once its marker is there, and a marker is created only if absent, so a replay or a second
writer of the same name changes nothing. Merging rewrites the buckets that change sets touch and then puts a new
head beside the old one; readers of the old head go on undisturbed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
ROWS = "point_id string, item_id string, vector array<float>, version long, deleted boolean, bucket int"


def bucket_of(point_id: Column, buckets: int) -> Column:
    """The first 32 bits of the md5 of the id, modulo the number of buckets."""
    return (F.conv(F.substring(F.md5(point_id), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def _newest(rows: DataFrame) -> DataFrame:
    """The last version of every point; of equal versions a tombstone, then the greater row."""
    order = F.struct("version", "deleted", "item_id", F.col("vector").cast("string"))
    columns = [c for c in rows.columns if c not in ("point_id", "bucket")]
    best = F.max_by(F.struct(*columns), order).alias("r")
    return rows.groupBy("point_id", "bucket").agg(best).select("point_id", "r.*", "bucket")


class VectorTable:
    """``(point_id, item_id, vector, version)`` by point id, in a folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._io = jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for folder in ("changes", "commits", "base", "heads"):
            self._fs.mkdirs(self._path(f"{self.root}/{folder}"))
        if not self._names("heads"):
            self._create("heads/0", json.dumps({"buckets": buckets, "gens": {}, "merged": []}))
        self.buckets = self.head()["buckets"]

    def _names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/{folder}")))

    def _create(self, name: str, text: str) -> bool:
        """Write a small file unless it exists."""
        path = self._path(f"{self.root}/{name}")
        if self._fs.exists(path):
            return False
        try:
            out = self._fs.create(path, False)
        except Exception as e:  # the other writer of this name was first
            if self._fs.exists(path):
                return False
            raise e
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _text(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.root}/{name}"))
        try:
            return bytes(self._io.toByteArray(stream)).decode()
        finally:
            stream.close()

    def head(self) -> dict:
        return json.loads(self._text(f"heads/{max(map(int, self._names('heads')))}"))

    def pending(self) -> list[str]:
        """Committed change sets that are not merged."""
        return sorted(set(self._names("commits")) - set(self.head()["merged"]))

    def apply(self, name: str, changes: DataFrame) -> bool:
        """Commit ``(point_id, item_id, vector, version)`` rows, tombstones where ``deleted`` is true; False if known."""
        if name in self._names("commits"):
            return False
        gone = F.coalesce(F.col("deleted"), F.lit(False)) if "deleted" in changes.columns else F.lit(False)
        rows = changes.select(
            F.col("point_id").cast("string").alias("point_id"),
            F.col("item_id").cast("string").alias("item_id"),
            F.col("vector").cast("array<float>").alias("vector"),
            F.col("version").cast("long").alias("version"),
            gone.alias("deleted"),
        ).withColumn("bucket", bucket_of(F.col("point_id"), self.buckets))
        folder = uuid.uuid4().hex
        _newest(rows).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.root}/changes/{folder}")
        if self._create(f"commits/{name}", folder):
            return True
        self._fs.delete(self._path(f"{self.root}/changes/{folder}"), True)
        return False

    def delete(self, name: str, point_ids: DataFrame, version: int) -> bool:
        """Commit tombstones for the points of ``point_ids``."""
        rows = point_ids.select(
            "point_id", F.lit(None).cast("string").alias("item_id"), F.lit(None).cast("array<float>").alias("vector"),
            F.lit(version).alias("version"), F.lit(True).alias("deleted"),
        )
        return self.apply(name, rows)

    def _read(self, base: str, folders: list[str]) -> DataFrame:
        folders = [f for f in folders if self._fs.exists(self._path(f))]
        if not folders:
            return self.spark.createDataFrame([], ROWS)
        rows = self.spark.read.schema(ROWS).option("basePath", base).parquet(*folders)
        return rows.select("point_id", "item_id", "vector", "version", "deleted", "bucket")

    def _changes(self, names: list[str]) -> DataFrame:
        out = None
        for name in names:
            folder = f"{self.root}/changes/{self._text(f'commits/{name}')}"
            rows = self._read(folder, [folder])
            out = rows if out is None else out.unionByName(rows)
        return self.spark.createDataFrame([], ROWS) if out is None else out

    def _base(self, head: dict, buckets: list[int] | None = None) -> DataFrame:
        gens = {int(b): g for b, g in head["gens"].items() if buckets is None or int(b) in buckets}
        base = f"{self.root}/base"
        return self._read(base, [f"{base}/gen={g}/bucket={b}" for b, g in gens.items()])

    def _current(self, head: dict, names: list[str], buckets: list[int] | None = None) -> DataFrame:
        """Base rows but those with a newer change, and the changes that are newer; tombstones stay in."""
        base = self._base(head, buckets)
        if not names:
            return base
        # Only changes are grouped. The base meets them by a join that sends no vectors where they are few.
        new = _newest(self._changes(names))
        if buckets is not None:
            new = new.where(F.col("bucket").isin(buckets))
        stamp = F.struct("version", "deleted", "item_id", F.col("vector").cast("string"))
        mine = base.withColumn("_is", stamp)
        other = new.withColumn("_is", stamp)
        kept = mine.join(other.select("point_id", F.col("_is").alias("_new")), "point_id", "left")
        kept = kept.where(F.col("_new").isNull() | (F.col("_is") >= F.col("_new"))).drop("_is", "_new")
        fresh = other.join(mine.select("point_id", F.col("_is").alias("_old")), "point_id", "left")
        fresh = fresh.where(F.col("_old").isNull() | (F.col("_is") > F.col("_old"))).drop("_is", "_old")
        return kept.unionByName(fresh)

    def read(self) -> DataFrame:
        """Current ``(point_id, item_id, vector, version)`` rows."""
        return self._current(self.head(), self.pending()).where(~F.col("deleted")).drop("deleted", "bucket")

    def merge(self) -> list[int]:
        """Merge the pending change sets into the base; the buckets that were rewritten.

        Tombstones stay in the base, so that a late replay of an older version finds them.
        """
        number, head, names = max(map(int, self._names("heads"))), self.head(), self.pending()
        touched = sorted(r["bucket"] for r in self._changes(names).select("bucket").distinct().collect())  # at most `buckets`
        if not names:
            return []
        gen = uuid.uuid4().hex
        rows = self._current(head, names, touched)
        rows.repartition(len(touched) or 1, "bucket").write.partitionBy("bucket").parquet(f"{self.root}/base/gen={gen}")
        after = {
            "buckets": head["buckets"],
            "gens": head["gens"] | {str(b): gen for b in touched},
            "merged": sorted({*head["merged"], *names}),
        }
        if not self._create(f"heads/{number + 1}", json.dumps(after)):
            self._fs.delete(self._path(f"{self.root}/base/gen={gen}"), True)
            raise RuntimeError("another merge was first; run merge again")
        return touched
