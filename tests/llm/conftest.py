import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpora import DOCS, make_corpus  # noqa: E402


@pytest.fixture(scope="session")
def corpus():
    return make_corpus()


@pytest.fixture()
def docs(spark):
    """Documents with extra columns whose names the operators use inside."""

    def build(rows):
        full = [(d, t, "en", "s", None if t is None else len(t), 1, "x", 2.0, 3, 4) for d, t in rows]
        schema = DOCS + ", _row int, ranges string, score double, sig int, spans int"
        return spark.createDataFrame(full, schema).repartition(4)

    return build
