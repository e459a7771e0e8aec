"""Searches on a grid of tiles: what goes between tasks follows the rows, and results stay exact."""

import numpy as np
import pytest

from tastemill.operators import retrieval as R
from tastemill.operators import tiles as T
from tastemill.operators import vector_index as V


def frame(spark, key, names, m):
    return spark.createDataFrame([(n, [float(x) for x in v]) for n, v in zip(names, m)], f"{key} string, vector array<float>").repartition(3)


def lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["item_id"], r["score"]))
    return out


def spied(monkeypatch, module):
    """Numbers of rows that the module ranks, call by call."""
    rows, held = [], module.top_k_per_group
    monkeypatch.setattr(module, "top_k_per_group", lambda df, *a: rows.append(df.count()) or held(df, *a))
    return rows


@pytest.fixture()
def vectors(spark):
    m = np.random.default_rng(11).normal(size=(400, 12))
    return frame(spark, "item_id", [f"i{k:03d}" for k in range(400)], m)


def test_a_search_ranks_k_rows_of_a_query_and_tile(spark, vectors, monkeypatch):
    asked = vectors.withColumnRenamed("item_id", "query_id").limit(50)
    rows = spied(monkeypatch, R)
    R.block_search(asked, vectors, 6, item_block=20, query_block=10)[0].count()
    assert max(rows) == 50 * 6
    monkeypatch.setattr(R, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(R, "MIN_JOIN_KEYS", 9)
    one = lists(R.block_search(asked, vectors, 6, item_block=20, query_block=10)[0])
    assert max(rows) <= 50 * 6 * 9
    monkeypatch.undo()
    assert one == lists(R.retrieve_top_k(asked, vectors, 6))


def test_an_index_ranks_its_candidates_only_once_a_tile(vectors, monkeypatch, tmp_path):
    index = V.build_index(vectors, str(tmp_path / "index"))
    asked = vectors.withColumnRenamed("item_id", "query_id")
    rows = spied(monkeypatch, V)
    index.search(asked, 5, n_probe=10, candidates=30).count()
    assert rows == [400 * 30, 400 * 30]
    rows.clear()
    # All items as candidates: scored where they are, not listed.
    every = lists(index.search(asked, 5, n_probe=len(index.quantizer.centers), candidates=400))
    assert rows == [400 * 5]
    assert every == lists(R.vector_search(asked, vectors, 5))


def test_few_probed_cells_with_all_their_items(vectors, tmp_path):
    index = V.build_index(vectors, str(tmp_path / "index"))
    asked = vectors.withColumnRenamed("item_id", "query_id")
    few, listed = index.search(asked, 5, n_probe=3, candidates=400), index.search(asked, 5, n_probe=3, candidates=399)
    assert lists(few) == lists(listed)


def test_ties_seen_and_zero_vectors(spark):
    """Equal vectors by id, beyond one block of columns and with seen pairs among them."""
    m = np.zeros((T.COLUMNS + 300, 3))
    m[:, 0] = 1.0
    m[5] = 0.0
    names = [f"i{k:05d}" for k in range(len(m))]
    items = frame(spark, "item_id", names, m)
    asked = frame(spark, "query_id", ["a", "b"], [[2.0, 0.0, 0.0], [0.0, 0.0, 0.0]])
    seen = spark.createDataFrame([("a", names[k]) for k in (0, 2)] + [("b", names[1]), ("b", "other"), ("z", names[3])], "query_id string, item_id string")
    got = lists(R.retrieve_top_k(asked, items, 4, seen, "drop"))
    assert [i for i, _ in got["a"]] == [names[k] for k in (1, 3, 4, 6)]
    assert [i for i, _ in got["b"]] == [names[k] for k in (0, 2, 3, 4)]
    marked = lists(R.retrieve_top_k(asked, items.where("item_id < 'i00004'"), 4, seen))
    assert marked["a"] == [(names[1], 1.0), (names[3], 1.0), (names[0], -1.0), (names[2], -1.0)]


def test_what_the_grid_moves_follows_the_rows():
    def moved(n):
        g = T.grid_of(n, n, 64, 10, T.cells_for(n, n, 64, R.MIN_JOIN_KEYS))
        return g.across + g.down

    assert moved(600_000) <= moved(100_000)
    small = T.grid_of(2000, 2000, 64, 10, T.cells_for(2000, 2000, 64, R.MIN_JOIN_KEYS))
    assert small == T.Grid(1, 1)


def test_many_queries_over_few_items_are_the_work_of_many_tasks():
    cells = T.cells_for(540_000, 100, 64, R.MIN_JOIN_KEYS)
    assert cells == R.MIN_JOIN_KEYS
    assert T.grid_of(540_000, 100, 64, 10, cells) == T.Grid(R.MIN_JOIN_KEYS, 1)
