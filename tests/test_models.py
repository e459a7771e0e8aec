"""Retrieval, factor models, sampling, embeddings and skew-safe ordering."""

import math
import uuid
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tastemill.functions.hashing import assign_bucket, point_id, request_key
from tastemill.functions.vectors import cosine, l2_normalize
from tastemill.operators import models as M
from tastemill.operators import ordering as O
from tastemill.operators import retrieval as R
from tastemill.plans import queries_models, serve
from tastemill.plans.train import als_recommend, train_als, train_popularity
from tastemill.schemas import DEFAULTS


@pytest.fixture(scope="module")
def space(spark):
    rng = np.random.default_rng(3)
    users = {f"u{i:02d}": rng.normal(size=8).astype(np.float32) for i in range(30)}
    items = {f"i{i:03d}": rng.normal(size=8).astype(np.float32) for i in range(120)}
    items["i119"] = items["i118"]  # an exact tie
    items["i117"] = np.zeros(8, np.float32)

    def table(vectors, key):
        rows = [(k, [float(x) for x in v]) for k, v in vectors.items()]
        return spark.createDataFrame(rows, f"{key} string, vector array<float>")

    return users, items, table(users, "query_id"), table(items, "item_id")


def brute(users, items, k, seen=(), drop=False, dot=False):
    out = {}
    for u, uv in users.items():
        uv = uv.astype(float)
        scored = []
        for i, iv in items.items():
            iv = iv.astype(float)
            s = float(uv @ iv)
            if not dot:
                s /= max(np.linalg.norm(uv), 1e-12) * max(np.linalg.norm(iv), 1e-12)
            if (u, i) in seen:
                if drop:
                    continue
                s = -1.0
            scored.append((-round(s, 9), i))
        out[u] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def as_lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.item_id, r.score))
    return out


def check(got, want):
    assert got.keys() == want.keys()
    for u in want:
        assert [i for i, _ in got[u]] == [i for i, _ in want[u]]
        assert [s for _, s in got[u]] == pytest.approx([s for _, s in want[u]], abs=1e-6)


@pytest.mark.parametrize("k", [1, 5, 20, 200])
def test_top_k(space, k):
    users, items, q, i = space
    check(as_lists(R.retrieve_top_k(q, i, k)), brute(users, items, k))


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("mode", ["sentinel", "drop"])
def test_blocks_and_seen(space, spark, monkeypatch, small, mode):
    """Many small blocks, joined by broadcast or by shuffle, give the same lists."""
    users, items, q, i = space
    monkeypatch.setattr(R, "QUERY_BLOCK", 4)
    monkeypatch.setattr(R, "ITEM_BLOCK", 16)
    monkeypatch.setattr(R, "MIN_JOIN_KEYS", 32)
    monkeypatch.setattr(R, "BROADCAST_BYTES", 1 << 30 if small else 0)
    seen = {(u, f"i{n:03d}") for u in list(users)[:9] for n in range(0, 120, 2)}
    seen |= {("u00", i) for i in items}  # one user has seen everything
    pairs = spark.createDataFrame(sorted(seen), "query_id string, item_id string")
    got = as_lists(R.retrieve_top_k(q, i, 7, pairs, mode))
    want = brute(users, items, 7, seen, mode == "drop")
    check(got, {u: v for u, v in want.items() if v})


def test_dot_and_errors(space):
    users, items, q, i = space
    check(as_lists(R.retrieve_top_k(q, i, 3, metric="dot")), brute(users, items, 3, dot=True))
    with pytest.raises(ValueError):
        R.retrieve_top_k(q, i, 3, metric="l1")
    with pytest.raises(ValueError):
        R.retrieve_top_k(q, i, 3, seen_mode="x")
    assert R.retrieve_top_k(q, i.limit(0), 3).count() == 0


def test_batch_recommend(space):
    users, items, q, i = space
    asked = q.sparkSession.createDataFrame([("u01",), ("ghost",)], "user_id string")
    out = R.batch_recommend(asked, q.withColumnRenamed("query_id", "user_id"), i, 4).collect()
    ghost = [r for r in out if r.user_id == "ghost"]
    assert len(ghost) == 1 and not ghost[0].known_user and ghost[0].item_id is None
    assert sorted(r["rank"] for r in out if r.known_user) == [1, 2, 3, 4]


def test_upsert(make):
    s = "point_id string, item_id string, vector array<double>, version int"
    now = make([("p", "i", [1.0], 1), ("q", "j", [2.0], 1)], s)
    new = make([("p", "i", [9.0], 2), ("r", "k", [3.0], 2)], s)
    out = R.upsert_vectors(R.upsert_vectors(now, new), new)
    assert {r.point_id: r.vector[0] for r in out.collect()} == {"p": 9.0, "q": 2.0, "r": 3.0}


def test_ids(make):
    df = make([("ml_item_1",), ("ml_item_é",)], "i string")
    for r in df.select("i", point_id(F.col("i")).alias("p")).collect():
        assert r.p == str(uuid.uuid5(uuid.NAMESPACE_URL, f"recsys:{r.i}"))
    import hashlib

    row = df.select("i", assign_bucket(F.col("i")).alias("b"), request_key(F.col("i")).alias("k")).first()
    assert row.b == int(hashlib.md5(row.i.encode()).hexdigest()[:8], 16) % 100
    assert row.k == hashlib.sha256(row.i.encode()).hexdigest()[:16]


def test_vectors(make):
    df = make([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    got = df.select(l2_normalize(F.col("a")).alias("u"), cosine(F.col("a"), F.col("b")).alias("c")).collect()
    assert got[0].u == pytest.approx([0.6, 0.8]) and got[0].c == pytest.approx(0.96)
    assert got[1].u == [0.0, 0.0] and got[1].c == 0.0


INTER = "user_id string, item_id string, event_type string, timestamp timestamp"


def test_matrix_and_popularity(make):
    rows = [("u1", "a", "view"), ("u1", "b", "click"), ("u1", "a", "like"), ("u2", "a", "view")]
    df = make(rows, "user_id string, item_id string, event_type string")
    got = {(r.user_id, r.item_id): r.r for r in M.implicit_matrix(df).collect()}
    assert got == {("u1", "a"): 4.0, ("u1", "b"): 2.0, ("u2", "a"): 1.0}
    assert M.confidence(M.implicit_matrix(df), 5.0).agg(F.max("confidence")).first()[0] == 21.0
    scores = M.popularity(df)
    catalog = make([("b", "B", "C")], "item_id string, title string, category string")
    assert [r.item_id for r in M.popular_items(scores, catalog, 1).collect()] == []
    assert [r.item_id for r in M.popular_items(scores, catalog, 2).collect()] == ["b"]


def test_user_embedding(make):
    df = make([("u", "a", "view"), ("u", "b", "like"), ("u", "q", "like"), ("v", "q", "view")],
              "user_id string, item_id string, event_type string")
    v = make([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "item_id string, vector array<double>")
    got = {r.user_id: r.vector for r in M.user_embedding(df, v, 2).collect()}
    assert got["u"] == pytest.approx([0.25, 0.75]) and got["v"] == [0.0, 0.0]


def test_mean_pool(make):
    t = make([("x", [2.0, 0.0], 1), ("x", [0.0, 2.0], 1), ("x", [9.0, 9.0], 0), ("y", [1.0, 1.0], 0)],
             "text_id string, vector array<double>, mask int")
    got = {r.text_id: r.vector for r in M.mean_pool(t, 2).collect()}
    assert got["x"] == pytest.approx([math.sqrt(0.5)] * 2) and got["y"] == [0.0, 0.0]


def test_contrastive_loss(make):
    s = "pos_id int, user_id string, item_id string"
    pos, neg = make([(1, "u", "a")], s), make([(1, "u", "b"), (1, "u", "c")], s)
    u = make([("u", [1.0, 2.0])], "user_id string, vector array<double>")
    i = make([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [1.0, 1.0])], "item_id string, vector array<double>")
    want = math.log(math.exp(1) + math.exp(2) + math.exp(3)) - 1
    assert M.contrastive_loss(pos, neg, u, i).first().loss == pytest.approx(want)


def test_contrastive_loss_sorts_no_vectors(make):
    rows = make([(1, "a", "x")], "pos_id long, user_id string, item_id string")
    u, i = (make([(k, [1.0, 0.0])], f"{c} string, vector array<double>") for c, k in (("user_id", "a"), ("item_id", "x")))
    out = M.contrastive_loss(rows, rows.limit(0), u, i)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan
    assert out.first().loss == pytest.approx(0.0) and out.first().n == 1


def test_negatives(spark):
    """Hot users, users with almost no unseen item, and users who saw everything."""
    n_items = 60
    index = spark.range(n_items).select(
        F.concat(F.lit("i"), "id").alias("item_id"), F.col("id").alias("item_idx")
    )
    rows = [("all", i) for i in range(n_items)] + [("most", i) for i in range(n_items - 2)]
    rows += [("hot", i % 20) for i in range(400)] + [("one", 5)]
    rows += [("half", i) for i in range(0, n_items, 2)]
    pos = spark.createDataFrame(
        [(p, u, f"i{i}") for p, (u, i) in enumerate(rows)], "pos_id long, user_id string, item_id string"
    )
    out = M.sample_negatives(pos, index, 4)
    got = out.collect()
    seen = {(u, f"i{i}") for u, i in rows}
    per = {}
    for r in got:
        per.setdefault((r.pos_id, r.user_id), []).append(r.item_id)
        assert r.user_id == "all" or (r.user_id, r.item_id) not in seen
    assert len(per) == len(rows)
    for (_, user), items in per.items():
        assert len(items) == len(set(items)) == (2 if user == "most" else 4)
    assert len({r.item_id for r in got if r.user_id == "hot"}) > 30
    again = M.sample_negatives(pos, index, 4).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


@pytest.mark.parametrize("n_seen", [1, 10, 14])
def test_negatives_are_uniform_sets(spark, n_seen):
    """Every unseen item, and every pair of them, comes up alike often, however many items a user has seen."""
    n_items, draws = 16, 3000
    index = spark.range(n_items).select(F.concat(F.lit("i"), "id").alias("item_id"), F.col("id").alias("item_idx"))
    seen = [(k * 7) % n_items for k in range(n_seen)]
    pos = spark.range(draws).selectExpr("id AS pos_id", "'u' AS user_id").withColumn(
        "item_id", F.concat(F.lit("i"), F.element_at(F.array(*[F.lit(x) for x in seen]), (F.col("pos_id") % n_seen + 1).cast("int")))
    )
    got = M.sample_negatives(pos, index, 2).groupBy("pos_id").agg(F.array_sort(F.collect_list("item_id")).alias("s"))
    counts = {tuple(r["s"]): r["n"] for r in got.groupBy("s").agg(F.count("*").alias("n")).collect()}
    free = n_items - n_seen
    pairs = free * (free - 1) // 2
    assert sum(counts.values()) == draws and len(counts) == pairs
    chi = sum((c - draws / pairs) ** 2 / (draws / pairs) for c in counts.values())
    assert chi < pairs + 4 * (2 * pairs) ** 0.5 + 4


@pytest.fixture(scope="module")
def taste(spark):
    """Two groups of users with their own half of the catalog."""
    return spark.sql(
        """SELECT concat('u', u) AS user_id, concat('i', (u % 2) * 20 + i) AS item_id,
        IF(i % 3 = 0, 'like', 'view') AS event_type, timestamp'2024-01-01' + pmod(hash(u, i), 20) * interval 1 hour AS timestamp
        FROM (SELECT id AS u FROM range(30)) JOIN (SELECT id AS i FROM range(20)) ON (u * 7 + i * 3) % 5 > 0"""
    )


def test_als_queries_fit_the_documented_model():
    assert (queries_models.ALS_SETTINGS.als_factors, queries_models.ALS_SETTINGS.als_iterations) == (64, 40)


def test_als(spark, taste):
    settings = replace(DEFAULTS, als_factors=4, als_iterations=5, eval_k=(5,), top_k=5)
    fitted = M.fit_als(M.implicit_matrix(taste), settings)
    u, i = M.als_factors(*fitted)
    users = taste.select("user_id").distinct().unionByName(spark.createDataFrame([("ghost",)], "user_id string"))
    recs = als_recommend(u, i, users, taste.select("user_id", "item_id").distinct(), 4)
    assert recs.join(taste, ["user_id", "item_id"], "left_semi").count() == 0
    assert recs.where("user_id = 'ghost'").count() == 0
    own = recs.where("rank = 1").select(
        (F.substring("user_id", 2, 9).cast("int") % 2).alias("u"),
        (F.substring("item_id", 2, 9).cast("int") >= 20).cast("int").alias("i"),
    )
    assert own.where("u = i").count() / own.count() > 0.8
    cut = F.lit("2024-01-01 14:00:00").cast("timestamp")
    train, test = taste.where(F.col("timestamp") < cut), taste.where(F.col("timestamp") >= cut)
    items = taste.select("item_id", F.lit("C").alias("category")).distinct()
    row = train_als(train, test, items, settings).first()
    assert 0 <= row["recall@5"] <= 1 and 0 <= row["coverage"] <= 1
    assert train_popularity(train, test, items, settings).first()["diversity"] == pytest.approx(0.2)


def test_embed_items(make):
    items = make([("1", "red ring", "Action", "t", None), ("2", "red ring", "Action", "t", None), ("3", "blue", "War", "q", "x")],
                 "item_id string, title string, category string, tags string, text_description string")
    got = {r.item_id: r.vector for r in serve.embed_items(items).collect()}
    assert got["1"] == got["2"] != got["3"]
    assert np.linalg.norm(got["3"]) == pytest.approx(1.0, abs=1e-5)

    def plugged(df):
        return df.select("item_id", F.array(F.length("text").cast("float")).alias("vector"))

    assert {r.item_id: r.vector[0] for r in serve.embed_items(items, plugged).collect()}["3"] == 12.0


# Ordering on skewed data


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds a third of all rows; partitions are left uncoalesced."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark.sql(
        "SELECT IF(id % 3 = 0, 'hot', concat('g', id % 97)) AS g, pmod(hash(id), 1000) AS v, id FROM range(30000)"
    ).repartition(8)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_group_running_total(skewed, spark):
    got = O.with_group_running_total(skewed, ["g"], ["v", "id"])
    w = Window.partitionBy("g").orderBy("v", "id")
    want = skewed.withColumn("rn", F.row_number().over(w) - 1).withColumn(
        "n", F.count("*").over(Window.partitionBy("g"))
    )
    assert got.join(want, ["g", "id"]).where("idx <> rn or total <> n").count() == 0
    assert got.count() == 30000
    # The hot group was ranged over several partitions, never gathered in one.
    rows = O._range_sorted(skewed, [F.col("g"), F.col("v"), F.col("id")])
    pids = rows.withColumn("p", F.shiftright("_pos", 33)).where("g = 'hot'").select("p").distinct().count()
    assert pids > 1


def test_global_index(skewed):
    got = O.with_global_index(skewed, ["v", "id"])
    assert got.agg(F.min("idx"), F.max("idx"), F.count_distinct("idx")).first()[:] == (0, 29999, 30000)
    w = Window.orderBy("idx")
    assert got.withColumn("p", F.lag("v").over(w)).where("p > v").count() == 0


def test_percentiles(skewed):
    pdf = skewed.toPandas()
    probs = [0.0, 0.1, 0.37, 0.5, 0.99, 1.0]
    for r in O.exact_percentiles(skewed, "v", probs, ["g"]).collect():
        assert r.value == pytest.approx(np.percentile(pdf[pdf.g == r.g].v, r.p * 100))
        assert r.n == (pdf.g == r.g).sum()


def test_long_head(skewed, monkeypatch):
    want = [r.id for r in skewed.orderBy("v", "id").limit(500).collect()]
    monkeypatch.setattr(O, "SMALL_LIMIT", 10)
    assert sorted(r.id for r in O.head_by_order(skewed, ["v", "id"], 500).collect()) == sorted(want)
