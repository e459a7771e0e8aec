"""Hash trees of files of any size and kind, as tables.

Files are read by Spark's splittable text reader, so one file is the work of many tasks and any store that Spark
reads will do. Lines are its unit, taken as raw bytes: a leaf covers the lines that begin within one chunk
of fixed size, wherever the reader happened to split the file. Each further level hashes up to ``FAN`` nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHUNK = 1 << 18
FAN = 1024
#: Levels above the leaves: FAN ** LEVELS chunks, 256 terabytes a file.
LEVELS = 3
_NAMES = ["file", "size_bytes", "chunk", "start", "sha256", "hashes"]
_PIECE = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]


def chunk_hashes(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """Leaves of every file below a path: ``(name, chunk, sha256, size_bytes)``, the size being the file's.

    ``name`` is the path below ``path``. Files are taken as they are stored, so none may carry the ending of a codec. A file
    without a byte has no leaf.
    """
    rows = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    meta = F.col("_metadata")
    rows = rows.select(
        meta["file_path"].alias("file"), meta["file_size"].alias("size_bytes"), meta["file_block_start"].alias("block"),
        F.col("value").cast("binary").alias("line"),
    ).withColumn("step", F.octet_length("line") + F.lit(1).cast("bigint"))
    # Where a block's first line begins follows from the bytes of the blocks before it; a block is one reader's share.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("file", "block").agg(F.sum("step").alias("bytes"))
    blocks = blocks.select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("first"))
    # Blocks behind the first one of a file, at most one for each share of the bytes.
    later = blocks.where(F.col("first") > 0).select("file", "block", "first")
    hashed = rows.select("file", "size_bytes", "block", "step", F.unhex(F.sha2("line", 256)).alias("h"))
    placed = hashed.join(F.broadcast(later), ["file", "block"], "left").select(
        "file", "size_bytes", "block", F.coalesce("first", F.lit(0)).alias("first"), "step", "h"
    )
    pieces = placed.mapInArrow(_pieces(chunk), "file string, size_bytes long, chunk long, start long, sha256 string, hashes string")
    # A chunk that meets the edge of a block comes in pieces, all others are whole.
    joined = F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("start", "hashes"))), lambda x: x["hashes"]))
    out = pieces.groupBy("file", "size_bytes", "chunk").agg(F.coalesce(F.max("sha256"), F.sha2(joined, 256)).alias("sha256"))
    name = F.element_at(F.split("file", "\\Q" + path.rstrip("/") + "/\\E", 2), -1)
    return out.select(name.alias("name"), "chunk", "sha256", "size_bytes")


def _pieces(chunk: int):
    """Arrow function over the lines of whole blocks in file order: a leaf of each chunk within a block, the line hashes of the others.

    A block's lines stay in the task that reads them, so only what lies at its edges is left to be put together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None  # file and block
        size = place = 0  # the file's size, where the next line begins
        of = start = -1  # chunk that is open, and where its first line begins
        edge, text = True, []

        def leave(last: bool) -> list[tuple]:
            joined = "".join(text)
            if edge or last:
                return [(at[0], size, of, start, None, joined)]
            return [(at[0], size, of, start, hashlib.sha256(joined.encode()).hexdigest(), None)]

        for batch in batches:
            if not batch.num_rows:
                continue
            done = []
            files, blocks = batch.column("file").to_pylist(), batch.column("block").to_numpy(zero_copy_only=False)
            sizes, firsts = batch.column("size_bytes").to_numpy(), batch.column("first").to_numpy()
            steps = batch.column("step").to_numpy()
            hashes = pa.concat_arrays([batch.column("h").cast(pa.large_binary())])
            raw, ends = hashes.buffers()[2], np.frombuffer(hashes.buffers()[1], np.int64)[hashes.offset : hashes.offset + len(hashes) + 1]
            other = pc.not_equal(batch.column("file")[1:], batch.column("file")[:-1]).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(other | (blocks[1:] != blocks[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if at != (files[a], blocks[a]):
                    if text:
                        done += leave(True)
                    at, size, place, of, text = (files[a], blocks[a]), int(sizes[a]), int(firsts[a]), -1, []
                begins = place + np.cumsum(steps[a:b]) - steps[a:b]
                place = int(begins[-1] + steps[b - 1])
                number = begins // chunk
                new = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1)]
                for x, y in zip(new, [*new[1:], b - a]):
                    if number[x] != of:
                        if text:
                            done += leave(False)
                        # The first chunk of a block may have begun in the one before.
                        edge = of < 0 and firsts[a] > 0
                        of, start, text = int(number[x]), int(begins[x]), []
                    text.append(bytes(raw[int(ends[a + x]) : int(ends[a + y])]).hex())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), _PIECE)] if done else [pa.array([], t) for t in _PIECE], _NAMES)
        if text:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*leave(True)), _PIECE)], _NAMES)

    return run


def tree_roots(chunks: DataFrame) -> DataFrame:
    """``(name, sha256, n_chunks, size_bytes)``: the root over a file's leaves, sealed with its size."""
    level = chunks.select("name", "size_bytes", F.col("chunk").alias("at"), "sha256", F.lit(1).cast("bigint").alias("n"))
    for _ in range(LEVELS):
        node = F.array_sort(F.collect_list(F.struct("at", "sha256")))  # at most FAN children
        joined = F.concat_ws("", F.transform(node, lambda x: x["sha256"]))
        up = level.withColumn("up", F.floor(F.col("at") / FAN))
        level = up.groupBy("name", "size_bytes", "up").agg(F.sha2(joined, 256).alias("sha256"), F.sum("n").alias("n"))
        level = level.withColumnRenamed("up", "at")
    sealed = F.sha2(F.concat_ws("-", F.col("size_bytes").cast("string"), "sha256"), 256)
    return level.select("name", sealed.alias("sha256"), F.col("n").alias("n_chunks"), "size_bytes")


def compare_trees(stored: DataFrame, current: DataFrame) -> DataFrame:
    """``(name, expected, actual, n_changed, ok)`` of every file on either side, from two tables of leaves."""
    old = tree_roots(stored).select("name", F.col("sha256").alias("expected"))
    new = tree_roots(current).select("name", F.col("sha256").alias("actual"))
    a = stored.select("name", "chunk", F.col("sha256").alias("old"))
    b = current.select("name", "chunk", F.col("sha256").alias("new"))
    changed = a.join(b, ["name", "chunk"], "full").where(~F.col("old").eqNullSafe(F.col("new")))
    changed = changed.groupBy("name").agg(F.count("*").alias("n_changed"))
    both = old.join(new, "name", "full").join(changed, "name", "left")
    ok = F.col("expected").eqNullSafe(F.col("actual"))
    return both.select("name", "expected", "actual", F.coalesce("n_changed", F.lit(0)).alias("n_changed"), ok.alias("ok"))
