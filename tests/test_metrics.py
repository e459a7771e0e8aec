"""Ranking metrics, experiments, drift and monitoring."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemill.functions.hashing import assign_variant
from tastemill.functions.stats import regularized_beta, two_sided_p
from tastemill.operators import drift as D
from tastemill.operators import experiment as G
from tastemill.operators import monitoring as H
from tastemill.operators import ranking_metrics as R


def recs(make, lists):
    rows = [(u, i, n) for u, items in lists.items() for n, i in enumerate(items, 1)]
    return make(rows, "user_id string, item_id string, rank int")


def truth(make, sets):
    rows = [(u, i) for u, items in sets.items() for i in sorted(items)]
    return make(rows, "user_id string, item_id string")


def test_recall_hit_ndcg(make):
    r, t = recs(make, {"u": "abcd"}), truth(make, {"u": "ad"})
    assert R.recall_at_k(r, t, 2).first().recall == 0.5
    assert R.recall_at_k(r, t, 4).first().recall == 1.0
    assert R.recall_at_k(r, truth(make, {"u": "a"}).limit(0), 4).count() == 0
    r, t = recs(make, {"u": "ab"}), truth(make, {"u": "b"})
    assert R.hit_rate_at_k(r, t, 1).first().hit == 0.0
    assert R.hit_rate_at_k(r, t, 2).first().hit == 1.0
    want = (1 / math.log2(3) + 1 / math.log2(5)) / (1 + 1 / math.log2(3))
    got = R.ndcg_at_k(recs(make, {"u": "ABCD"}), truth(make, {"u": "BD"}), 4).first().ndcg
    assert got == pytest.approx(want)


def test_evaluate(make):
    r = recs(make, {"u1": "abc", "u2": "axy"})
    t = truth(make, {"u1": "abz", "u2": "y"})
    m = R.evaluate_ranking(r, t, [2, 3]).first()
    assert m["recall@2"] == pytest.approx(1 / 3) and m["hit@3"] == 1.0
    lonely = R.evaluate_ranking(r, truth(make, {"u9": "a"}), [2]).first()
    assert lonely["recall@2"] == 0.0 and lonely["n_users"] == 1
    assert R.summarize(R.evaluate_ranking(r, t, [3]).select(
        F.col("`hit@3`").alias("hit@3"), F.col("`recall@3`").alias("recall@3"))).first().summary == (
        "hit@3: 1.0000 | recall@3: 0.8333"
    )


def test_coverage_diversity(make):
    catalog = make([(c,) for c in "abcd"], "item_id string")
    assert R.coverage(recs(make, {"1": "ab", "2": "ac"}), catalog).first().coverage == 0.75
    items = make([("a", "X"), ("b", "X"), ("c", "Y"), ("d", "X")], "item_id string, category string")
    lists = recs(make, {"u1": ["a", "b", "d"], "u2": ["a", "b", "c"], "u3": ["zz"]})
    assert R.diversity_category(lists, items, 3).first().diversity == pytest.approx(0.5)
    assert R.mean_list_len(lists).first().mean_len == pytest.approx(7 / 3)


def test_truth_and_users(make):
    train = make([("u1", "a"), ("u2", "b"), ("u2", "c")], "user_id string, item_id string")
    test = make([("u1", "a"), ("u1", "c"), ("u2", "a"), ("u2", "c")], "user_id string, item_id string")
    got = {(r.user_id, r.item_id) for r in R.ground_truth(test, train).collect()}
    assert got == {("u1", "c"), ("u2", "a")}
    only = make([("a",)], "item_id string")
    assert [r.user_id for r in R.ground_truth(test, train, only).collect()] == ["u2"]
    t = truth(make, {"u1": "abcd", "u2": "a", "u3": "ab"})
    assert [r.user_id for r in R.select_eval_users(t, 2).collect()] == ["u1", "u3"]
    known = make([("u2",), ("u3",)], "user_id string")
    assert [r.user_id for r in R.select_eval_users(t, 9, known).collect()] == ["u3", "u2"]
    both = R.sample_common_users(t, make([("u1", 1), ("u2", 1)], "user_id string, n int"), 9)
    assert {r.user_id for r in both.collect()} == {"u1", "u2"}


def test_variants(make, spark):
    assert G.sequential_weights([("a", 0.5), ("b", 0.5)]) == [
        ("a", pytest.approx(2 / 3)), ("b", pytest.approx(1 / 3)),
    ]
    users = spark.range(2000).select(F.concat(F.lit("u"), "id").alias("user_id"))
    n = {r.variant: r["count"] for r in G.route_users(users, G.normalized_weights({"a": 3, "b": 1})).groupBy("variant").count().collect()}
    assert 0.7 < n["a"] / 2000 < 0.8
    # Weights that do not add up leave the rest to the last variant.
    rest = users.select(assign_variant(F.col("user_id"), [("a", 0.0), ("b", 0.0)]).alias("v"))
    assert {r.v for r in rest.distinct().collect()} == {"b"}


def test_welch(make):
    assert regularized_beta(0.5, 0.5, 0.3) == pytest.approx(2 / math.pi * math.asin(math.sqrt(0.3)))
    assert regularized_beta(2.0, 3.0, 0.4) == pytest.approx(0.5248)
    assert two_sided_p(2.0, 10.0) == pytest.approx(0.07338803, abs=1e-8)
    assert two_sided_p(0.0, 5.0) == pytest.approx(1.0)
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0, 8.0, 10.0]
    df = make([("a", x) for x in a] + [("b", x) for x in b], "variant string, value double")
    r = G.welch_t_test(df, "a", "b")
    se = np.var(a, ddof=1) / 4 + np.var(b, ddof=1) / 5
    assert r["t"] == pytest.approx((2.5 - 6.0) / math.sqrt(se))
    assert 0 < r["p"] < 0.1
    assert G.welch_t_test(df.where("variant = 'a'"), "a", "b")["p"] is None


def test_metric_log(spark, tmp_path):
    path = str(tmp_path / "log")
    G.log_metric(spark, path, "ctr", 0.5, {"v": "a"})
    G.log_metric(spark, path, "ctr", 0.6)
    assert spark.read.json(path).count() == 2


@pytest.fixture(scope="module")
def normal():
    rng = np.random.default_rng(7)
    return rng.normal(0, 1, 2000), rng.normal(0, 1, 2000), rng.normal(3, 1, 2000)


def frame(make, values):
    return make([(float(v),) for v in values], "score double")


def numpy_psi(actual, expected, bins=10):
    edges = np.unique(np.percentile(expected, np.linspace(0, 100, bins + 1)))
    share = lambda v: np.clip(np.histogram(v, edges)[0] / max(np.histogram(v, edges)[0].sum(), 1), 1e-6, None)
    a, e = share(actual), share(expected)
    a, e = a / a.sum(), e / e.sum()
    return float(np.sum((a - e) * np.log(a / e)))


def test_psi(make, normal):
    base, same, shifted = normal
    near = D.psi(frame(make, same), frame(make, base), "score").first().psi
    far = D.psi(frame(make, shifted), frame(make, base), "score").first().psi
    assert near < 0.05 and far > 0.1
    assert near == pytest.approx(numpy_psi(same, base)) and far == pytest.approx(numpy_psi(shifted, base))
    assert D.psi(frame(make, base), frame(make, base), "score").first().psi == 0.0
    assert D.psi(frame(make, base).limit(0), frame(make, base), "score").first().psi == 0.0
    kl = D.kl_divergence(frame(make, base), frame(make, shifted), "score").first().kl
    assert kl == pytest.approx(far)


def test_edges_of_odd_references(make):
    def edges(values):
        long = D.unpivot_numeric(frame(make, values), ["score"])
        return D.quantile_edges(long, ["score"], 4).first().edges

    assert edges([5.0, 5.0]) == [4.0, 4.5, 5.0, 5.5, 6.0]
    assert edges([]) == [0.0, 0.25, 0.5, 0.75, 1.0]
    assert edges([1.0, 1.0, 1.0, 2.0]) == list(np.unique(np.percentile([1, 1, 1, 2], [0, 25, 50, 75, 100])))


def test_detect_drift(make, normal):
    base, _same, shifted = normal
    a = make([(float(v), "red" if i % 2 else "blue") for i, v in enumerate(base)], "score double, color string")
    b = make([(float(v), "red") for v in shifted], "score double, color string")
    got = {r.feature: r for r in D.detect_drift(a, b, ["score", "nope"], ["color"]).collect()}
    assert got["score"].alert and got["color"].score > 0 and len(got) == 2
    assert [(d.category, d.delta) for d in got["color"].deltas] == [("blue", -0.5), ("red", 0.5)] and got["score"].deltas is None
    empty = D.detect_drift(a, b, ["nope"])
    assert empty.count() == 0 and empty.columns == ["feature", "kind", "score", "alert", "deltas"]


def test_bins_come_from_the_edges(make):
    values = make([("x", float(k)) for k in range(1000)], "feature string, value double")
    edges = D.quantile_edges(values, ["x"], 20)
    shares = D.bin_proportions(values, edges).collect()
    assert len(shares) == 20 and {r.n for r in shares} <= {49, 50, 51} and sum(r.n for r in shares) == 1000
    assert D.psi_from_edges(values.where("value > 500"), values, edges).first().psi > 1


def test_categories(make):
    r = make([("a",), ("b",), ("c",)], "c string")
    c = make([("a",), ("b",), ("d",)], "c string")
    d = {x.category: x.delta for x in D.category_deltas(r, c, "c").collect()}
    assert d["d"] > 0 > d["c"] and d["a"] == 0.0
    assert D.categorical_shift(r, c, "c").first().score >= 0


def test_percentiles(make):
    lat = make([(v,) for v in (10.0, 20.0, 30.0, 40.0, 50.0, 100.0)], "ms double")
    row = H.latency_percentiles(lat, "ms").first()
    assert (row.p50, row.p95, row.p99) == (35.0, 87.5, 97.5)
    none = H.latency_percentiles(lat.limit(0), "ms").first()
    assert (none.p50, none.p95, none.p99) == (0.0, 0.0, 0.0)


def test_quality(make):
    shown = make([("a", 1), ("b", 2), ("b", 2), ("c", 3)], "user_id string, item_id int")
    assert H.catalog_coverage(shown, 10).first().coverage == pytest.approx(0.3)
    assert H.catalog_coverage(shown.limit(0), 10).first().coverage == 0.0
    v = make(
        [("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [1.0, 0.0]), ("z", [0.0, 0.0])],
        "item_id string, vector array<double>",
    )
    lists = make([("u", "a"), ("u", "b"), ("v", "a"), ("w", "a"), ("w", "c")], "user_id string, item_id string")
    got = {r.user_id: r.diversity for r in H.intra_list_diversity(lists, v).collect()}
    assert got == {"u": pytest.approx(1.0), "v": 0.0, "w": pytest.approx(0.0)}
    two = make([("u", "a"), ("v", "b")], "user_id string, item_id string")
    assert H.personalization(two, v, 2).first().personalization == pytest.approx(1.0)
    assert H.personalization(two.limit(1), v, 2).first().personalization == 0.0
    pop = make([("a", 0.25)], "item_id string, p double")
    nov = H.list_novelty(make([("u", "a"), ("u", "q")], "user_id string, item_id string"), pop)
    assert nov.first().novelty == pytest.approx((2 - math.log2(1e-9)) / 2)


def test_rates(make):
    log = make([("click",)] * 5 + [("show",)] * 100, "e string")
    assert H.ctr(log, F.col("e") == "click", F.col("e") == "show").first().ctr == 0.05
    assert H.ctr(log.limit(0), F.col("e") == "click", F.col("e") == "show").first().ctr == 0.0
    t = H.token_efficiency(make([(100, 50)], "i int, o int"), F.col("i"), F.col("o"), 100000).first()
    assert (t.tokens_used, t.tokens_remaining, t.utilization) == (150, 99850, 0.0015)


def test_load_summary(make):
    log = make([("s", float(v), v != 3) for v in (5, 1, 3, 2, 4, 6)], "ep string, ms double, ok boolean")
    r = H.load_summary(log, ["ep"], "ms", F.col("ok"), F.lit(2.0)).first()
    assert (r.p50_ms, r.p95_ms, r.median_ms, r.success_rate, r.throughput_rps) == (4.0, 6.0, 3.5, 0.8333, 3.0)


def test_sketches_of_parts_stand_for_the_whole(spark):
    rows = spark.range(40_000).selectExpr("id % 8 AS part", "'x' AS feature", "pow(rand(5), 3) * 100 AS value").localCheckpoint()
    flat = spark.range(500).selectExpr("id % 8 AS part", "'flat' AS feature", "7.0D AS value")
    few = spark.range(4000).selectExpr("id % 8 AS part", "'few' AS feature", "CAST(id % 4 AS DOUBLE) AS value")
    odd = spark.sql("SELECT 0L AS part, 'x' AS feature, CAST('NaN' AS DOUBLE) AS value")
    values = rows.unionByName(flat).unionByName(few).unionByName(odd)
    merged = D.merge_sketches(D.sketch_values(values, ["part"]))
    assert {r["feature"]: r["n"] for r in merged.collect()} == {"x": 40_000, "flat": 500, "few": 4000}
    edges = {r["feature"]: list(r["edges"]) for r in D.edges_of_sketches(merged, ["x", "flat", "few", "none"], 10).collect()}
    ranks = [rows.where(F.col("value") <= e).count() / 40_000 for e in edges["x"]]
    assert all(abs(r - i / 10) <= 4 * D.RANK_ERROR for i, r in enumerate(ranks))
    assert edges["flat"][0] == 6.0 and edges["flat"][-1] == 8.0 and edges["few"] == [0.0, 1.0, 2.0, 3.0]
    assert edges["none"][0] == 0.0 and edges["none"][-1] == 1.0
    table = D.edges_of_sketches(merged, ["few"], 10)
    shares = {r["bin"]: r["p"] for r in D.shares_of_sketches(merged, table).collect()}
    assert shares == pytest.approx({1: 0.25, 2: 0.25, 3: 0.5}, abs=1e-3)
    exact = {r["bin"]: r["p"] for r in D.bin_proportions(few.drop("part"), table).collect()}
    assert shares == pytest.approx(exact, abs=1e-3)
    moved = D.sketch_values(rows.withColumn("value", F.col("value") + 20))
    same = {r["feature"]: r["psi"] for r in D.psi_of_sketches(merged, merged, ["x", "few"]).collect()}
    assert same == {"x": 0.0, "few": 0.0}
    assert D.psi_of_sketches(moved, merged, ["x"]).first()["psi"] > 1
