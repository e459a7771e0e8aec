"""Per-user event history as list state of each user and day.

The state of a key is one day of one user, so a user with very many events is many states, on many tasks, and no
state grows without end. A batch writes the ordered day of every key it touched; reading a user looks into one folder,
takes the last version of each day and adds up the days before it. No event is sorted when the state is read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tastemill.streaming.events import DRAIN

BUCKETS = 64
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EVENT = "event_id bigint, item_id string, event_type string, at bigint"
_DAYS = f"user_id string, day date, place int, n int, {_EVENT}"


class _Day(StatefulProcessor):
    """Events of one user on one day, each once, kept in a list and given out in order of time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.events = handle.getListState("events", _EVENT)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timers) -> Iterator[Row]:
        # Each look at the state is a call to the JVM: one reads the list, one adds to it.
        day = [tuple(e) for e in self.events.get()]
        known = {e[0] for e in day}
        fresh = []
        for e in rows:
            if e.event_id not in known:
                known.add(e.event_id)
                fresh.append((e.event_id, e.item_id, e.event_type, e.at))
        if fresh:
            self.events.appendList(fresh)
        day = sorted(day + fresh, key=lambda e: (e[3], e[0]))
        for place, e in enumerate(day):
            yield Row(user_id=key[0], day=key[1], place=place, n=len(day), event_id=e[0], item_id=e[1], event_type=e[2], at=e[3])

    def close(self) -> None:
        pass


def bucket_of(user_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(user_id), F.lit(buckets)).cast("int")


def keep_days(events: DataFrame, path: str, checkpoint: str, buckets: int = BUCKETS, trigger: dict | None = None):
    """Stream ``(user_id, event_id, item_id, event_type, timestamp)`` into ordered days under ``path``.

    Events that were seen are left out, and repeating a batch after a failure overwrites its own folders.
    """
    spark = events.sparkSession
    rows = events.select(
        F.col("user_id").cast("string").alias("user_id"), F.to_date("timestamp").alias("day"), F.col("event_id").cast("bigint").alias("event_id"),
        "item_id", "event_type", F.unix_micros("timestamp").alias("at"),
    )
    days = rows.groupBy("user_id", "day").transformWithState(
        statefulProcessor=_Day(), outputStructType=_DAYS, outputMode="Update", timeMode="None"
    )

    def step(batch: DataFrame, epoch: int) -> None:
        placed = batch.withColumn("bucket", bucket_of(F.col("user_id"), buckets))
        placed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/batch={epoch}")

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        return (
            days.writeStream.foreachBatch(step).outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or DRAIN)).start()
        )
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def read_days(spark: SparkSession, path: str, users: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``(user_id, event_id, item_id, event_type, at, seq, n_events)``: every user's events in order.

    With ``users`` only their buckets are read. What meets across tasks is one row per user and day.
    """
    rows = spark.read.schema(f"{_DAYS}, batch int, bucket int").parquet(path)
    if users is not None:
        mine = [bucket_of(F.lit(u), buckets).alias(f"b{k}") for k, u in enumerate(users)]
        held = sorted(set(spark.range(1).select(*mine).first())) if users else []
        rows = rows.where(F.col("bucket").isin(held) & F.col("user_id").isin(users))
    last = rows.groupBy("user_id", "day").agg(F.max("batch").alias("batch"), F.max_by("n", "batch").alias("n"))
    earlier = Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    last = last.withColumn("n_events", F.sum("n").over(Window.partitionBy("user_id"))).drop("n")
    return rows.drop("n").join(last, ["user_id", "day", "batch"]).select(
        "user_id", "event_id", "item_id", "event_type", "at", (F.col("_before") + F.col("place")).alias("seq"), "n_events"
    )
