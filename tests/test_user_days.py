"""List state of each user and day against sorting everything."""

import pytest
from pyspark.sql import functions as F

from tastemill.streaming.user_days import keep_days, read_days

SCHEMA = "event_id long, user_id string, item_id string, event_type string, timestamp timestamp"


def rows(spark, start, stop):
    return spark.sql(
        f"""SELECT id AS event_id, IF(id % 3 = 0, 'hot', concat('u', id % 5)) AS user_id, concat('i', id % 7) AS item_id,
        'view' AS event_type, timestamp'2024-01-01' + (id * 37 % 101) * interval 61 minutes AS timestamp FROM range({start}, {stop})"""
    )


def want(df):
    by_user = {}
    for r in df.select("user_id", "event_id", F.unix_micros("timestamp").alias("at")).collect():
        by_user.setdefault(r["user_id"], set()).add((r["at"], r["event_id"]))
    return sorted((u, e, k, len(es)) for u, es in by_user.items() for k, (_, e) in enumerate(sorted(es)))


def got(df):
    return sorted((r["user_id"], r["event_id"], r["seq"], r["n_events"]) for r in df.collect())


@pytest.fixture()
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def test_state_survives_restarts_late_events_and_repeats(spark, place):
    def drain():
        stream = spark.readStream.schema(SCHEMA).parquet(place("in"))
        keep_days(stream, place("out"), place("cp"), 8).awaitTermination()

    for a, b in ((0, 40), (40, 90), (30, 60), (90, 120)):
        rows(spark, a, b).write.mode("append").parquet(place("in"))
        drain()
    drain()
    assert got(read_days(spark, place("out"), buckets=8)) == want(rows(spark, 0, 120))
    one = read_days(spark, place("out"), ["hot"], 8)
    assert got(one) == [r for r in want(rows(spark, 0, 120)) if r[0] == "hot"]
    # One user's read prunes all buckets but one.
    scans = [line for line in one._jdf.queryExecution().toString().splitlines() if "PartitionFilters" in line]
    assert scans and all("bucket" in line.partition("PartitionFilters")[2].partition("PushedFilters")[0] for line in scans)
    assert read_days(spark, place("out"), [], 8).count() == 0


def test_a_batch_costs_two_looks_at_the_state():
    """One call reads a day, one adds to it, and rows go out without a table of their own for each day."""
    from datetime import date

    from pyspark.sql import Row

    from tastemill.streaming.user_days import _Day

    calls = []

    class Held:
        def __getattr__(self, name):
            return lambda *a: calls.append(name) or iter([(2, "b", "view", 20)])

    day = _Day()
    day.events = Held()
    fresh = [Row(event_id=k, item_id="a", event_type="view", at=at) for k, at in ((3, 30), (2, 20), (1, 10), (3, 30))]
    out = list(day.handleInputRows(("u", date(2024, 1, 1)), iter(fresh), None))
    assert [(r.event_id, r.place, r.n) for r in out] == [(1, 0, 3), (2, 1, 3), (3, 2, 3)]
    assert calls == ["get", "appendList"]
