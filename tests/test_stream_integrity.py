"""Streaming restarts, integrity checks and the registry."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tastemill.operators import integrity as K
from tastemill.operators.drift import quantile_edges, unpivot_numeric
from tastemill.streaming import events as S

SCHEMA = "event_id long, user_id string, item_id string, event_type string, timestamp timestamp, value double"


def rows(spark, start, stop):
    return spark.sql(
        f"""SELECT id AS event_id, IF(id % 3 = 0, 'hot', concat('u', id % 5)) AS user_id, concat('i', id % 7) AS item_id,
        'view' AS event_type, timestamp'2024-01-01' + (id * 37 % 101) * interval 1 minute AS timestamp,
        id * 1.0D AS value FROM range({start}, {stop})"""
    )


def source(spark, path):
    return spark.readStream.schema(SCHEMA).parquet(path)


@pytest.fixture()
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def test_history_survives_restart(spark, place):
    rows(spark, 0, 40).write.mode("append").parquet(place("in"))
    S.append_history(source(spark, place("in")), place("out"), place("cp")).awaitTermination()
    rows(spark, 40, 100).write.mode("append").parquet(place("in"))
    S.append_history(source(spark, place("in")), place("out"), place("cp")).awaitTermination()
    S.append_history(source(spark, place("in")), place("out"), place("cp")).awaitTermination()
    got = S.user_state(spark.read.parquet(place("out")))
    want = S.user_state(rows(spark, 0, 100))
    key = ["event_id", "user_id", "seq", "n_events"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))


def run_capped(spark, place, cap):
    state = S.capped_user_state(source(spark, place("in")), cap)

    def step(batch, epoch):
        batch.write.mode("append").parquet(place("state"))

    q = (
        state.writeStream.outputMode("update").foreachBatch(step)
        .option("checkpointLocation", place("cp")).trigger(availableNow=True).start()
    )
    q.awaitTermination()


def test_capped_state_survives_restart(spark, place):
    for a, b in ((0, 40), (40, 100)):
        rows(spark, a, b).write.mode("append").parquet(place("in"))
        run_capped(spark, place, 3)
    last = {}
    for r in spark.read.parquet(place("state")).collect():
        # Newest events only move forward, so the largest time per place is the last one written.
        k = (r.user_id, r.position)
        last[k] = max(last.get(k, (0, 0)), (r.timestamp, r.event_id))
    want = {}
    for r in rows(spark, 0, 100).select("user_id", "event_id", F.unix_micros("timestamp").alias("t")).collect():
        want.setdefault(r.user_id, []).append((r.t, r.event_id))
    want = {(u, p): e for u, es in want.items() for p, e in enumerate(sorted(es, reverse=True)[:3])}
    assert last == want


def test_recent_and_drift(spark, place):
    base = unpivot_numeric(rows(spark, 0, 100), ["value"])
    edges = quantile_edges(base, ["value"])
    for a, b in ((0, 40), (40, 100)):
        rows(spark, a, b).write.mode("append").parquet(place("in"))
        S.keep_recent(source(spark, place("in")), place("recent"), place("cp1"), 15).awaitTermination()
        S.rolling_drift(
            source(spark, place("in")), base, edges, ["value"], place("drift"), place("cp2"), 30
        ).awaitTermination()
    got = {r.event_id for r in S.newest_snapshot(spark, place("recent")).collect()}
    want = {r.event_id for r in S.newest(rows(spark, 0, 100), 15).collect()}
    assert got == want
    scores = spark.read.parquet(place("drift") + "/drift").collect()
    assert len(scores) == 2 and all(r.psi > 0 for r in scores)


def test_latest_and_counters(spark, place):
    rows(spark, 0, 50).write.parquet(place("in"))
    got = S.run_updates(S.latest_event_per_user(source(spark, place("in"))), ["user_id"], "latest")
    want = S.latest_event_per_user(rows(spark, 0, 50))
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    n = S.run_updates(S.event_counters(source(spark, place("in"))), ["event_type"], "n").first()
    assert (n.event_type, n.n) == ("view", 50)


def test_json_and_validation(spark, place, tmp_path):
    folder = tmp_path / "json"
    folder.mkdir()
    events = [
        {"user_id": "u", "item_id": "a", "event_type": "VIEW", "received_at": "2024-01-01T00:00:05+00:00"},
        {"user_id": "x", "item_id": "a", "event_type": "rate", "timestamp": "2024-01-01T00:00:00+00:00"},
        {"user_id": "u", "item_id": "zz", "event_type": "view"},
        {"user_id": "u", "item_id": "a", "event_type": "boom"},
        {"user_id": "u", "item_id": "a", "event_type": "click", "timestamp": "not a time"},
    ]
    (folder / "e.json").write_text("\n".join([*map(json.dumps, events), '{"user_id": "u"', "[1"]))
    catalog = spark.createDataFrame([("a",), ("a",)], "item_id string")
    users = spark.createDataFrame([("u",)], "user_id string")
    checked = S.validate_events(S.json_events(spark, str(folder)), catalog, users)
    S.append_history(checked, place("out"), place("cp")).awaitTermination()
    got = spark.read.parquet(place("out")).collect()
    assert sorted((r.event_type or "", r.reject_reason or "", r.known_user) for r in got if r.reject_reason != "payload") == [
        ("boom", "event_type", True), ("click", "timestamp", True), ("rate", "", False), ("view", "", True),
        ("view", "item_id", True),
    ]
    assert sum(r.reject_reason == "payload" for r in got) == 2
    assert next(r for r in got if r.event_type == "click").timestamp is None
    first = next(r for r in got if r.event_type == "view" and r.item_id == "a")
    assert first.timestamp == first.received_at
    raw = spark.createDataFrame([(None,), ("{}",)], "value string")
    assert S.parse_events(raw).count() == 1


def vectors(make, pairs):
    return make(pairs, "id string, vector array<double>")


def test_check_embeddings(make):
    ids = make([("a",), ("b",)], "id string")
    good = vectors(make, [("a", [1.0, 2.0]), ("b", [0.0, 1.0])])
    K.require_ok(K.check_embeddings(good, ids, other_dim=2))
    bad = vectors(make, [("a", [1.0]), ("a", [float("nan"), 2.0]), ("c", [1.0, 2.0])])
    broken = {r.check for r in K.check_embeddings(bad, ids, other_dim=3).where("not ok").collect()}
    assert broken == {
        "rows_match_dataset", "unique_ids", "missing_ids", "extra_ids", "equal_dims", "finite_values",
        "dims_match_other_side",
    }
    with pytest.raises(ValueError, match="integrity check failed"):
        K.require_ok(K.check_embeddings(bad, ids))


def test_id_hash(make, monkeypatch):
    ids = make([("b",), ("a",), ("b",)], "id string")
    assert K.id_set_hash(ids, "id").first().sha256 == hashlib.sha256(b"a\nb").hexdigest()
    a, b = K.id_set_fingerprint(ids, "id").first(), K.id_set_fingerprint(ids.limit(2), "id").first()
    assert a == b != K.id_set_fingerprint(ids.limit(1), "id").first()
    before = K.id_set_digest(ids, "id").first()
    monkeypatch.setattr(K, "MAX_HASHED_BYTES", 2)
    with pytest.raises(ValueError, match="too large"):
        K.id_set_hash(ids, "id")
    # One definition at every size.
    assert before.n == 2 and before == K.id_set_digest(ids.repartition(3), "id").first()


def test_manifest(make):
    files = make([("f", "00", 3)], "name string, sha256 string, size_bytes long")
    u, i = vectors(make, [("u", [1.0])]), vectors(make, [("a", [1.0]), ("b", [2.0])])
    m = K.artifact_manifest(u, i, files)
    row = m.first()
    assert (row.user_count, row.item_count, row.item_dim, row.artifacts["f"].size_bytes) == (1, 2, 1, 3)
    assert all(r.ok for r in K.verify_manifest(m, m).collect())
    other = K.artifact_manifest(u, i.limit(1), files.withColumn("sha256", F.lit("11")))
    broken = {r.check for r in K.verify_manifest(m, other).where("not ok").collect()}
    assert broken == {"item_count", "item_ids_sha256", "file:f"}
    old = m.withColumn("schema_version", F.lit(2))
    assert {r.check for r in K.verify_manifest(old, m).where("not ok").collect()} == {"schema_version"}
    skipped = K.verify_manifest(None, m).first()
    assert skipped.actual == "skipped" and skipped.ok


def test_registry(spark, place):
    K.register_model(spark, place("reg"), "als", "v1", {"recall@20": 0.1}, {"alpha": 5})
    K.register_model(spark, place("reg"), "als", "v2", {})
    K.set_model_status(spark, place("reg"), "als", "v1", "production")
    got = {r.model_version: r for r in K.model_registry(K.read_registry(spark, place("reg"))).collect()}
    assert got["v1"].status == "production" and json.loads(got["v1"].metrics) == {"recall@20": 0.1}
    assert got["v2"].status == "candidate"
