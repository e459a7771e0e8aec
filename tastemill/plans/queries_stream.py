"""Streaming queries: the events table is replayed as a stream and drained."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.operators.drift import quantile_edges, unpivot_numeric
from tastemill.plans import bindings as B
from tastemill.plans.queries_monitor import psi_sql
from tastemill.plans.registry import query
from tastemill.session import materialize, scratch_path
from tastemill.streaming import events as S
from tastemill.streaming.user_days import keep_days, read_days

_KNOWN = "event_type IN ('view', 'click', 'like', 'purchase', 'rate')"


def _catalog(spark, d):
    """Catalog without the items of one brand, so that some events are rejected."""
    return B.items(spark, d).where(F.col("tags") != "Brand#7")


_ITEM_OK = "item_id IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_brand <> 'Brand#7')"
_EV = "SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS item_id, event_type, ts, value FROM events"


_BROKEN, _BAD_TIME = "event_id % 50 = 3", "event_id % 50 = 7"


def _json_folder(spark, d):
    """The events as JSON lines with the serving columns: upper-case types, some lines cut short and
    some times that are none."""
    path = scratch_path(spark, "json-events")
    time = F.when(F.expr(_BAD_TIME), "not a time").when(F.col("value") > 10, F.col("ts").cast("string"))
    line = F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("user_id"),
            F.get_json_object("props", "$.k").alias("item_id"),
            F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise(F.col("event_type")).alias("event_type"),
            time.alias("timestamp"),
            F.col("ts").cast("string").alias("received_at"),
        )
    )
    cut = F.when(F.expr(_BROKEN), F.lit('{"user_id": ')).otherwise(line)
    B.table(spark, d, "events").select(cut.alias("value")).write.text(path)
    return path


@query(
    "event_source",
    f"SELECT lower(event_type) AS event_type, false AS payload_error, count(*) AS n FROM events WHERE NOT ({_BROKEN}) GROUP BY 1"
    f" UNION ALL SELECT '', true, count(*) FROM events WHERE {_BROKEN}",
)
def _(spark, d):
    """JSON lines read as a stream, parsed and counted, broken ones apart."""
    events = S.json_events(spark, _json_folder(spark, d))
    kind = F.coalesce(F.lower("event_type"), F.lit(""))
    counted = events.groupBy(kind.alias("event_type"), "payload_error").agg(F.count("*").alias("n"))
    return S.run_updates(counted, ["event_type", "payload_error"], "counters")


@query(
    "validate_events",
    f"""SELECT user_id, item_id, lower(event_type) AS event_type,
 CASE WHEN {_BAD_TIME} THEN -1 ELSE CAST(epoch_us(ts) AS BIGINT) END AS ts_us,
 CASE WHEN NOT ({_KNOWN}) THEN 'event_type' WHEN NOT ({_ITEM_OK}) THEN 'item_id' WHEN {_BAD_TIME} THEN 'timestamp' ELSE '' END AS reject_reason,
 CAST(user_id AS BIGINT) % 10 > 0 AS known_user FROM ({_EV}) WHERE NOT ({_BROKEN})
 UNION ALL SELECT '', '', '', -1, 'payload', false FROM events WHERE {_BROKEN}""",
)
def _(spark, d):
    """Validated stream written through the file sink; every event keeps its reason."""
    out, checkpoint = scratch_path(spark, "validated"), scratch_path(spark, "validated-checkpoint")
    users = B.raw_interactions(spark, d).select("user_id").distinct().where(F.col("user_id").cast("int") % 10 > 0)
    checked = S.validate_events(S.json_events(spark, _json_folder(spark, d)), _catalog(spark, d), users)
    S.append_history(checked, out, checkpoint).awaitTermination()
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("user_id", "item_id", "event_type", "reject_reason")]
    # A broken payload has no event time; its arrival time is the clock's.
    lost = F.coalesce("reject_reason", F.lit("")) == "payload"
    time = F.when(~lost, F.unix_micros("timestamp"))
    return spark.read.parquet(out).select(*text, F.coalesce(time, F.lit(-1)).alias("ts_us"), "known_user")


@query(
    "validate_events_batch",
    f"""SELECT CASE WHEN NOT ({_KNOWN}) THEN 'event_type' WHEN NOT ({_ITEM_OK}) THEN 'item_id' ELSE 'accepted' END AS outcome,
 count(*) AS n FROM ({_EV}) GROUP BY 1""",
)
def _(spark, d):
    e = B.raw_interactions(spark, d).withColumn("received_at", F.col("timestamp").cast("string"))
    out = S.validate_events(e, _catalog(spark, d))
    return out.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")).agg(
        F.count("*").alias("n")
    )


@query("event_counters", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark, d):
    return S.run_updates(S.event_counters(B.event_stream(spark, d)), ["event_type"], "counters")


@query(
    "user_state",
    f"""SELECT user_id, event_id, item_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq,
 count(*) OVER (PARTITION BY user_id) AS n_events FROM ({_EV})""",
)
def _(spark, d):
    """Events streamed to the history table, then read as ordered per-user state."""
    out, checkpoint = scratch_path(spark, "history"), scratch_path(spark, "history-checkpoint")
    S.append_history(B.event_stream(spark, d), out, checkpoint).awaitTermination()
    return S.user_state(spark.read.parquet(out)).select(
        "user_id", "event_id", "item_id", "event_type", "seq", "n_events"
    )


_DAY_STATE = f"""SELECT user_id, event_id, item_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq,
 count(*) OVER (PARTITION BY user_id) AS n_events FROM ({_EV})"""


@query("user_day_state", _DAY_STATE)
def _(spark, d):
    """Events kept as list state of each user and day, sent twice; read without a sort of the history."""
    out, checkpoint = scratch_path(spark, "days"), scratch_path(spark, "days-checkpoint")
    events = B.event_stream(spark, d)
    keep_days(events.unionByName(events), out, checkpoint).awaitTermination()
    return read_days(spark, out).drop("at")


@query(
    "capped_user_state",
    f"""SELECT * FROM (SELECT user_id, event_id, item_id, event_type, CAST(epoch_us(ts) AS BIGINT) AS ts_us,
 CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) - 1 AS INTEGER) AS position FROM ({_EV})) WHERE position < 5""",
)
def _(spark, d):
    """The five newest events per user, kept as bounded stream state."""
    state = S.capped_user_state(B.event_stream(spark, d), 5)
    out = S.run_updates(state, ["user_id", "position"], "capped")
    return out.withColumnRenamed("timestamp", "ts_us")


@query(
    "latest_event_per_user",
    f"SELECT user_id, max(event_id) AS event_id, arg_max(item_id, (ts, event_id)) AS item_id, arg_max(event_type, (ts, event_id)) AS event_type FROM ({_EV}) GROUP BY user_id",
)
def _(spark, d):
    events = B.event_stream(spark, d).select("user_id", "event_id", "item_id", "event_type", "timestamp")
    out = S.run_updates(S.latest_event_per_user(events), ["user_id"], "latest")
    return out.drop("timestamp")


@query("recent_events", f"SELECT event_id, user_id, item_id FROM ({_EV}) ORDER BY ts DESC, event_id DESC LIMIT 2000")
def _(spark, d):
    out, checkpoint = scratch_path(spark, "recent"), scratch_path(spark, "recent-checkpoint")
    S.keep_recent(B.event_stream(spark, d), out, checkpoint, 2000).awaitTermination()
    return S.newest_snapshot(spark, out).select("event_id", "user_id", "item_id")


@query(
    "rolling_drift",
    f"""SELECT 'value' AS feature, round(psi, 6) AS psi FROM ({psi_sql(
        'value',
        'SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000',
        f"SELECT * FROM events WHERE ts < TIMESTAMP '{B.CUT}'",
    )})""",
)
def _(spark, d):
    """Drift of the newest thousand events' values against the events before the cut date."""
    before = B.table(spark, d, "events").where(F.col("ts").cast("timestamp") < F.lit(B.CUT).cast("timestamp"))
    baseline = materialize(unpivot_numeric(before, ["value"]), "baseline")
    edges = materialize(quantile_edges(baseline, ["value"]), "edges")
    out, checkpoint = scratch_path(spark, "drift"), scratch_path(spark, "drift-checkpoint")
    S.rolling_drift(
        B.event_stream(spark, d), baseline, edges, ["value"], out, checkpoint, 1000
    ).awaitTermination()
    return S.newest_snapshot(spark, f"{out}/drift").withColumn("psi", F.round("psi", 6))
