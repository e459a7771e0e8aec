"""Event streams: source, validation, counters, per-user state, recent window, drift."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tastemill.operators.drift import bin_proportions, psi_from_shares, unpivot_numeric
from tastemill.operators.ordering import with_group_running_total
from tastemill.schemas import SERVING_EVENTS, STREAM_EVENT
from tastemill.session import materialize, scratch_path


# Process all that is there, then stop. A service passes its own, e.g. {"processingTime": "5 seconds"}.
DRAIN = {"availableNow": True}


def parse_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """Event columns of a JSON payload and ``payload_error``, true where it is no JSON object.

    Null payloads are skipped; others stay, so that validation can reject them by name.
    """
    text = F.col(value).cast("string")
    schema = T.StructType([*STREAM_EVENT.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(text, schema, {"columnNameOfCorruptRecord": "_corrupt"})
    return (
        raw.where(F.col(value).isNotNull())
        .select(parsed.alias("e"))
        .select("e.*")
        .withColumn("payload_error", F.col("_corrupt").isNotNull())
        .drop("_corrupt")
    )


def kafka_events(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Events of a topic from the earliest offset. Needs the Kafka connector on the class path."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    return parse_events(raw)


def json_events(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Events of a folder of JSON lines."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_events(reader.load(path))


def validate_events(events: DataFrame, catalog: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Normalise events and name the reason a row is rejected (null when accepted).

    Types are lower-cased and must be known, items must be in the catalog. Unknown users are kept
    and flagged. A missing event time becomes the arrival time; one that is no time is rejected and
    left null, as is a payload that did not parse. Works on batches and streams.
    """
    kind = F.lower("event_type")
    known_items = catalog.select("item_id").distinct().withColumn("_item", F.lit(True))
    rows = events.withColumn("event_type", kind).join(known_items, "item_id", "left")
    arrived = F.coalesce(F.col("received_at").try_cast("timestamp"), F.current_timestamp())
    when = F.col("timestamp").try_cast("timestamp")
    bad_time = F.col("timestamp").isNotNull() & when.isNull()
    broken = F.col("payload_error") if "payload_error" in events.columns else F.lit(False)
    reason = (
        F.when(broken, "payload")
        .when(~F.coalesce(kind.isin(*SERVING_EVENTS), F.lit(False)), "event_type")
        .when(F.col("_item").isNull(), "item_id")
        .when(bad_time, "timestamp")
    )
    out = (
        rows.withColumn("reject_reason", reason)
        .withColumn("received_at", arrived)
        .withColumn("timestamp", F.when(bad_time, None).otherwise(F.coalesce(when, "received_at")))
        .drop("_item", "payload_error")
    )
    if users is None:
        return out
    known = users.select("user_id").distinct().withColumn("known_user", F.lit(True))
    return out.join(known, "user_id", "left").fillna(False, ["known_user"])


def event_counters(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("n"))


def latest_event_per_user(events: DataFrame, order_by: tuple[str, ...] = ("timestamp", "event_id")) -> DataFrame:
    """Newest event per user: one row of state per user, however many events they send."""
    order = F.struct(*[F.col(c) for c in order_by])
    rest = [c for c in events.columns if c != "user_id"]
    newest = F.max_by(F.struct(*rest), order).alias("e")
    return events.groupBy("user_id").agg(newest).select("user_id", "e.*")


def append_history(
    events: DataFrame, path: str, checkpoint: str, buckets: int = 16, trigger: dict | None = None
):
    """Stream events to the history table the per-user state is read from.

    The file sink commits each batch once, so a restart from the checkpoint neither loses nor
    repeats an event. History is kept as rows: a user with very many events is many rows, never
    one growing state value. Rows are bucketed by user, so reading one user reads one bucket.
    """
    return (
        events.withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int"))
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("bucket")
        .outputMode("append")
        .trigger(**(trigger or DRAIN))
        .start(path)
    )


def user_state(history: DataFrame, order_by: tuple[str, ...] = ("timestamp", "event_id")) -> DataFrame:
    """Every user's events in order: ``seq`` is the 0-based position, ``n_events`` the length."""
    return with_group_running_total(
        history, ["user_id"], list(order_by), name="seq", total="n_events"
    )


def capped_user_state(events: DataFrame, cap: int) -> DataFrame:
    """Streaming state of at most the ``cap`` newest events per user, emitted on each change.

    Events are (user_id, item_id, event_type, timestamp, event_id); rows come back per user with
    ``position`` 0 for the newest. Each Arrow batch is cut to the cap per user before the shuffle:
    older events of a batch could not survive anyway, and a hot user stays a small group.
    """
    cols = ["event_id", "item_id", "event_type", "timestamp"]
    order = ["timestamp", "event_id"]

    def trim(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            yield chunk.sort_values(order, ascending=False).groupby("user_id", sort=False).head(cap)

    def update(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = pd.DataFrame(
            dict(zip(cols, map(list, state.get))) if state.exists else {c: [] for c in cols}
        )
        for chunk in chunks:
            both = pd.concat([kept, chunk[cols]], ignore_index=True) if len(kept) else chunk[cols]
            both = both.drop_duplicates("event_id")
            kept = both.sort_values(order, ascending=False).head(cap)
        state.update(tuple(kept[c].tolist() for c in cols))
        out = kept.reset_index(drop=True)
        out.insert(0, "user_id", key[0])
        out["position"] = range(len(out))
        yield out

    micros = events.select(
        "user_id", "event_id", "item_id", "event_type", F.unix_micros("timestamp").alias("timestamp")
    )
    return micros.mapInPandas(trim, micros.schema).groupBy("user_id").applyInPandasWithState(
        update,
        "user_id string, event_id bigint, item_id string, event_type string, timestamp bigint, position int",
        "event_id array<bigint>, item_id array<string>, event_type array<string>, timestamp array<bigint>",
        "update",
        GroupStateTimeout.NoTimeout,
    )


def newest(events: DataFrame, n: int, order_by: tuple[str, ...] = ("timestamp", "event_id")) -> DataFrame:
    return events.orderBy(*[F.desc(c) for c in order_by]).limit(n)


def keep_recent(
    events: DataFrame,
    path: str,
    checkpoint: str,
    n: int = 2000,
    order_by: tuple[str, ...] = ("timestamp", "event_id"),
    trigger: dict | None = None,
):
    """Stream into snapshots of the ``n`` newest events, one folder per batch.

    A batch reads the snapshot before it and writes its own, so repeating a batch after a failure
    writes the same rows again. Older snapshots than these two are removed.
    """

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if epoch > 0:
            rows = spark.read.schema(batch.schema).parquet(f"{path}/batch={epoch - 1}").unionByName(batch)
        newest(rows, n, order_by).write.mode("overwrite").parquet(f"{path}/batch={epoch}")
        _drop_before(spark, path, epoch - 1)

    return (
        events.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DRAIN))
        .start()
    )


def _batches(spark: SparkSession, path: str) -> dict[int, object]:
    """Batch number and path of each snapshot folder, from a listing of the folder alone."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = (s.getPath() for s in fs.listStatus(top))
    return {int(p.getName().split("=")[1]): p for p in found if p.getName().startswith("batch=")}


def _drop_before(spark: SparkSession, path: str, epoch: int) -> None:
    for number, folder in _batches(spark, path).items():
        if number < epoch:
            fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            fs.delete(folder, True)


def newest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the last batch folder; no other folder is read."""
    return spark.read.parquet(f"{path}/batch={max(_batches(spark, path))}")


def rolling_drift(
    events: DataFrame,
    baseline: DataFrame,
    edges: DataFrame,
    features: list[str],
    path: str,
    checkpoint: str,
    n: int = 1000,
    order_by: tuple[str, ...] = ("timestamp", "event_id"),
    trigger: dict | None = None,
):
    """Per batch, drift of the ``n`` newest events so far against a stored baseline.

    ``baseline`` is long ``(feature, value)`` and ``edges`` its stored bin edges; its bin shares are
    computed and stored once. Windows go to ``path/window`` (the last two stay), scores to
    ``path/drift``, one folder per batch each.
    """
    expected = materialize(bin_proportions(baseline, edges), "baseline-shares")

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        window = f"{path}/window"
        rows = batch
        if epoch > 0:
            rows = spark.read.schema(batch.schema).parquet(f"{window}/batch={epoch - 1}").unionByName(batch)
        newest(rows, n, order_by).write.mode("overwrite").parquet(f"{window}/batch={epoch}")
        recent = spark.read.schema(batch.schema).parquet(f"{window}/batch={epoch}")
        shares = bin_proportions(unpivot_numeric(recent, features), edges)
        scores = psi_from_shares(shares, expected, edges)
        scores.write.mode("overwrite").parquet(f"{path}/drift/batch={epoch}")
        _drop_before(spark, window, epoch - 1)

    return (
        events.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DRAIN))
        .start()
    )


def run_updates(stream: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Drain a keyed aggregate in update mode and return the last value of every key.

    Each batch writes only the keys it changed, to a folder of its own; repeating a batch
    overwrites the same folder.
    """
    spark = stream.sparkSession
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")

    def step(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    written = spark.read.parquet(out)
    rest = [c for c in written.columns if c not in (*keys, "batch")]
    last = F.max_by(F.struct(*rest), F.col("batch")).alias("r")
    return written.groupBy(*keys).agg(last).select(*keys, "r.*")
