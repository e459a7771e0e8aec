"""Connected components of a link table by alternating star rounds, and a fixed-size row filter."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import store

FILTER_BITS = 24


def components(links: DataFrame) -> DataFrame:
    """node, component (least node reachable) for every node of ``links`` (a, b: long).

    Each round hangs every node's larger neighbours, then its smaller ones, under its least
    neighbour. Least neighbours are pre-aggregated, links are joined to them (skewed nodes are
    split), and every round is written, so nothing depends on one task or a long lineage.
    """
    some = F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")
    links = store(links.select(*some).where("u <> v").distinct(), "links")
    before = None
    while True:
        both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        links = store(small, "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    own = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(own)


def filter_words(keys: DataFrame, column: str) -> np.ndarray:
    """Bit field of fixed size (2**FILTER_BITS bits) with a bit set for each key's hash."""
    place = F.shiftrightunsigned(F.xxhash64(column), 64 - FILTER_BITS)
    words = (
        keys.select(place.alias("p"))
        .groupBy(F.shiftright("p", 6).cast("int").alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(p & 63 AS INT))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[words["w"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def maybe_in(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` that may have their ``column`` among the keys: drops most others before a
    shuffle. What is sent to the tasks has a fixed size; a full field only lets more rows pass."""
    words = df.sparkSession.sparkContext.broadcast(filter_words(keys, key))
    hashed = df.withColumn("_place", F.shiftrightunsigned(F.xxhash64(column), 64 - FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = words.value
        for batch in batches:
            p = batch.column("_place").to_numpy()
            hit = (field[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1
            yield batch.drop_columns(["_place"]).filter(pa.array(hit))

    return hashed.mapInArrow(run, df.schema)


