"""Stored approximate index, and exact search that skips blocks."""

import numpy as np
import pytest

from tastemill.operators import retrieval as R
from tastemill.operators import vector_index as V
from tastemill.plans.train import als_recommend
from tastemill.session import materialize


def frame(spark, key, names, m):
    return spark.createDataFrame([(n, [float(x) for x in v]) for n, v in zip(names, m)], f"{key} string, vector array<float>").repartition(3)


def brute(q, m, names, k, cosine=True):
    q, m = q.astype(np.float32).astype(float), m.astype(np.float32).astype(float)
    if cosine:
        q, m = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12) for x in (q, m))
    s = np.round(q @ m.T, 9)
    order = np.argsort(np.array(names), kind="stable")
    return [[(names[j], s[i, j]) for j in order[np.argsort(-s[i, order], kind="stable")][:k]] for i in range(len(q))]


def lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["item_id"], r["score"]))
    return out


def groups(seed, n, dim=12, tight=0.15):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(9, dim)) * 3
    return centers[rng.integers(9, size=n)] + tight * rng.normal(size=(n, dim))


@pytest.mark.parametrize("cosine", [True, False])
@pytest.mark.parametrize("tight", [0.1, 5.0])
def test_pruned_search_is_exact_and_skips(spark, cosine, tight):
    m, q = groups(1, 400, tight=tight), groups(2, 60, tight=tight)
    m[7] = m[8] = m[9]
    m[11], q[3] = 0.0, 0.0
    m[20] *= 50
    names, asked = [f"i{k:03d}" for k in range(400)], [f"q{k:02d}" for k in range(60)]
    hits, share = R.block_search(
        frame(spark, "query_id", asked, q), frame(spark, "item_id", names, m), 6, cosine=cosine, item_block=20, query_block=10
    )
    got, want = lists(hits), brute(q, m, names, 6, cosine)
    for name, w in zip(asked, want):
        assert [i for i, _ in got[name]] == [i for i, _ in w]
        assert [s for _, s in got[name]] == pytest.approx([s for _, s in w], abs=1e-5)
    row = share.first()
    assert row["scored"] <= row["pairs"]
    if tight < 1 and cosine:
        assert row["scored"] < 0.6 * row["pairs"]


def test_tighter_groups_score_fewer_pairs(spark):
    shares = []
    for tight in (2.0, 0.5, 0.05):
        names = [f"i{k}" for k in range(400)]
        m = frame(spark, "item_id", names, groups(1, 400, tight=tight))
        row = R.block_search(m.withColumnRenamed("item_id", "query_id"), m, 5, item_block=20, query_block=20)[1].first()
        shares.append(row["scored"] / row["pairs"])
    assert shares[0] > shares[1] > shares[2]


def test_als_lists_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    u, i = rng.normal(size=(40, 8)), rng.normal(size=(300, 8)) * rng.lognormal(size=(300, 1))
    users, items = [f"u{k}" for k in range(40)], [f"i{k:03d}" for k in range(300)]
    seen = [(f"u{k}", f"i{j:03d}") for k in range(40) for j in rng.choice(300, k, replace=False)]
    pairs = spark.createDataFrame(seen, "user_id string, item_id string")
    uv = frame(spark, "user_id", users, u)
    R.ITEM_BLOCK, held = 25, R.ITEM_BLOCK
    try:
        recs = als_recommend(uv, frame(spark, "item_id", items, i), uv.select("user_id"), pairs, 5)
        got = lists(recs.withColumnRenamed("user_id", "query_id"))
    finally:
        R.ITEM_BLOCK = held
    for name, ranked in zip(users, brute(u, i, items, 300, cosine=False)):
        gone = {j for x, j in seen if x == name}
        assert [j for j, _ in got[name]] == [j for j, _ in ranked if j not in gone][:5]


def test_index_reaches_its_target_and_can_be_opened_again(spark, tmp_path):
    rng = np.random.default_rng(5)
    m = np.vstack([groups(3, 700, dim=30, tight=0.8), rng.normal(size=(300, 30))])
    names = [f"i{k:04d}" for k in range(1000)]
    items = frame(spark, "item_id", names, m)
    index = V.build_index(items, str(tmp_path / "index"))
    asked = items.withColumnRenamed("item_id", "query_id")
    near = index.search(asked, 10)
    exact = R.vector_search(asked, items, 10)
    row = V.recall(near, exact).first()
    assert row["n_queries"] == 1000 and row["recall"] >= 0.95
    assert index.settings.recall >= index.settings.target and index.share_read() < 0.1
    again = V.open_index(spark, str(tmp_path / "index"))
    assert again.settings == index.settings
    assert lists(again.search(asked, 10)) == lists(near)
    # Scores are exact cosines: every hit that is no true neighbour is worse than the neighbours found.
    truth = lists(exact)
    for name, hits in lists(near).items():
        scores = dict(truth[name])
        assert all(scores.get(i, s) == pytest.approx(s, abs=1e-6) for i, s in hits)


def test_index_of_few_ties_and_zero_vectors(spark):
    m = np.array([[1, 0, 0, 0, 2], [1, 0, 0, 0, 2], [0, 0, 0, 0, 0], [0, 3, 0, 0, 0]], float)
    items = frame(spark, "item_id", ["b", "a", "z", "c"], m)
    index = V.build_index(items)
    got = lists(index.search(items.withColumnRenamed("item_id", "query_id"), 3, candidates=4, n_probe=9))
    assert [i for i, _ in got["a"]] == ["a", "b", "c"] and [s for _, s in got["a"]] == [1.0, 1.0, 0.0]
    assert len(got["z"]) == 3
    with pytest.raises(ValueError):
        V.build_index(items.limit(0))


def test_approximate_with_everything_probed_is_exact(spark):
    m = groups(6, 120, dim=8)
    items = frame(spark, "item_id", [f"i{k:03d}" for k in range(120)], m)
    asked = items.withColumnRenamed("item_id", "query_id")
    every = lists(V.approx_vector_search(asked, items, 10, n_cells=5, n_probe=5, candidates=120))
    exact = lists(R.vector_search(asked, items, 10))
    assert {k: [i for i, _ in v] for k, v in every.items()} == {k: [i for i, _ in v] for k, v in exact.items()}


def _reference(index, queries, items, k, n_probe, most):
    """Lists of (query_id, vector) by hand: the best decoded vectors of the probed cells, then their exact cosines."""
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    m = unit(np.array([v for _, v in items], np.float32).astype(float))
    cell, codes = index.quantizer.encode(m.astype(np.float32).astype(float))
    decoded, out = index.quantizer.decode(cell, codes), {}
    for name, v in queries:
        q = unit(np.array([v], np.float32).astype(float))
        probed = set(index.quantizer.cell_order(q)[0, :n_probe].tolist())
        near = sorted((-np.round(decoded[j] @ q[0], 5), items[j][0], j) for j in range(len(items)) if cell[j] in probed)[:most]
        hits = sorted((-np.round(m[j] @ q[0], 9), items[j][0]) for *_, j in near)
        out[name] = [(i, -s) for s, i in hits[:k]]
    return out


@pytest.mark.parametrize("tile_bytes", [None, 6000])
def test_candidate_lists_by_hand(spark, monkeypatch, tile_bytes):
    m = np.round(groups(7, 300, dim=10, tight=0.6), 2)
    m[40:90] = m[40]  # equal vectors: their ids decide who is a candidate
    rows = [(f"i{(7 * k) % 300:03d}", m[k].tolist()) for k in range(300)]
    items = frame(spark, "item_id", [r[0] for r in rows], m)
    index = V.build_index(items)
    asked = rows[30:120]
    if tile_bytes:
        monkeypatch.setattr(V.tiles, "TILE_BYTES", tile_bytes)
    written = {}

    def noted(df, label="stage"):
        out = materialize(df, label)
        written[label] = out.count()
        return out

    monkeypatch.setattr(V, "materialize", noted)
    got = lists(index.search(frame(spark, "query_id", [r[0] for r in asked], np.array([r[1] for r in asked])), 5, n_probe=9, candidates=20))
    assert written["candidates"] == len(asked)  # one list for each query, whatever its candidates
    for name, want in _reference(index, asked, rows, 5, 9, 20).items():
        assert [i for i, _ in got[name]] == [i for i, _ in want]
        assert [s for _, s in got[name]] == pytest.approx([s for _, s in want], abs=1e-6)


def test_ids_that_come_twice_or_not_at_all(spark):
    m = groups(8, 200, dim=8, tight=0.8)
    names = [f"i{k:03d}" for k in range(198)] + ["i000", None]
    index = V.build_index(frame(spark, "item_id", names, m))
    asked = frame(spark, "query_id", ["a", "a", "b", None], m[[0, 5, 198, 3]])
    got = lists(index.search(asked, 40, n_probe=99, candidates=60))
    assert set(got) == {"a", "b"} and len(got["a"]) == len(got["b"]) == 40
    assert all(i for hits in got.values() for i, _ in hits)
    # Both vectors of i000 are met through each of its two candidates.
    assert sum(i == "i000" for i, _ in lists(index.search(asked, 150, n_probe=99, candidates=190))["b"]) == 4
