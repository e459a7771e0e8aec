import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tastemill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture()
def make(spark):
    """Small DataFrame from rows and a DDL schema."""

    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture()
def history(spark):
    """n hourly interactions over a few users, ids in time order."""

    def build(n, users=4, start="2024-01-01 00:00:00", step="1 hour"):
        return spark.sql(
            f"""SELECT concat('u', id % {users}) AS user_id, concat('i', lpad(id, 4, '0')) AS item_id,
            'view' AS event_type, timestamp'{start}' + id * interval {step} AS timestamp FROM range({n})"""
        )

    return build
