"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
import check_queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    return check_queries.connect(SF)


@pytest.mark.parametrize("name", sorted(spark_entry.queries()))
def test_query(spark, duck, name):
    ok, note = check_queries.compare(spark, duck, name, SF)
    assert ok, note


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 20


def test_every_check_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.fixture()
def spread(spark):
    """Many uncoalesced partitions and no broadcast joins, as on large tables."""
    conf = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize(
    "name",
    [
        "split_per_user",
        "split_time_global",
        "trim_strided",
        "load_summary",
        "quantile_edges",
        "bin_proportions",
        "user_state",
        "retrieve_top_k",
        "fuse_rankings",
    ],
)
def test_query_over_many_partitions(spread, duck, name):
    ok, note = check_queries.compare(spread, duck, name, SF)
    assert ok, note
