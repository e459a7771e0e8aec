"""Sources, validation, weighting and splits."""

import math

import pytest
from pyspark.sql import functions as F

from tastemill.functions.events import (
    classify_error,
    epoch_to_timestamp,
    event_weight,
    rating_to_event,
    recency_weight,
    text_to_event,
)
from tastemill.operators import split as S
from tastemill.operators import validate as V
from tastemill.operators.items import pack_metadata_json, sample_rows, top_tags_per_item
from tastemill.plans.ingest import ingest
from tastemill.schemas import BATCH_EVENTS, SERVING_EVENTS, Settings
from tastemill.sources import tables as T

INTER = "user_id string, item_id string, event_type string, timestamp timestamp"


@pytest.fixture()
def ratings_dir(tmp_path):
    # user, film, stars: one user with four films, two with one each, a rating on the threshold.
    stars = [(70, 501, 4.0), (70, 502, 0.5), (70, 503, 4.5), (70, 504, 1.5), (71, 503, 5.0), (72, 502, 3.5)]
    lines = [f"{u},{f},{s},{1_262_304_000 + 60 * k}" for k, (u, f, s) in enumerate(stars)]
    (tmp_path / "ratings.csv").write_text("\n".join(["userId,movieId,rating,timestamp", *lines]))
    films = {501: "Lantern Bay (2009)|War", 502: "Paper Orchard (2011)|Drama", 503: "Night Ferry (2008)|Mystery|Crime", 504: "Low Tide (2010)|Drama|Crime"}
    lines = [f"{k},{v.replace('|', ',', 1)}" for k, v in films.items()]
    (tmp_path / "movies.csv").write_text("\n".join(["movieId,title,genres", *lines]))
    tags = [(71, 503, "slow burn"), (70, 503, "harbour"), (72, 504, "sea")]
    lines = [f"{u},{f},{t},{k}" for k, (u, f, t) in enumerate(tags)]
    (tmp_path / "tags.csv").write_text("\n".join(["userId,movieId,tag,timestamp", *lines]))
    return str(tmp_path)


@pytest.fixture()
def retail_dir(tmp_path):
    def write(name, header, rows):
        (tmp_path / name).write_text("\n".join(",".join(r) for r in [header.split(), *rows]) + "\n")

    write(
        "transactions_train.csv", "t_dat customer_id article_id price sales_channel_id",
        [("2019-05-0%d" % k, c, a, "0.%d" % k, "2") for k, (c, a) in enumerate([("k9", "0007"), ("k4", "0008"), ("k4", "0007"), ("k9", "0009")], 1)],
    )
    # article, name, type, then look, colour and description: the rest is the same for all.
    wool, cup, mat = ("0007", "Tall wool hat", "Hat"), ("0008", "Clay cup", "Cup"), ("0009", "Reed mat", "Mat")
    write(
        "articles.csv",
        "article_id prod_name product_type_name product_group_name graphical_appearance_name colour_group_name "
        "index_group_name section_name detail_desc",
        [(*wool, "Goods", "Knit", "Green", "Home", "Hall", "Warm"), (*cup, "Goods", "Glazed", "Grey", "Home", "Kitchen", ""),
         (*mat, "Goods", "Woven", "Straw", "Home", "Floor", "For doors")],
    )
    write("customers.csv", "customer_id postal_code club_member_status", [("k4", "7781", "NONE"), ("k9", "7790", "GOLD")])
    return str(tmp_path)


def test_read_ratings(spark, ratings_dir):
    data = T.read_ratings(spark, ratings_dir)
    rows = {(r.user_id, r.item_id): r.event_type for r in data.interactions.collect()}
    assert rows == {
        ("ml_user_70", "ml_item_501"): "view",  # the threshold itself is a view
        ("ml_user_70", "ml_item_502"): "view", ("ml_user_70", "ml_item_503"): "like", ("ml_user_70", "ml_item_504"): "view",
        ("ml_user_71", "ml_item_503"): "like", ("ml_user_72", "ml_item_502"): "view",
    }
    assert data.interactions.agg(F.year(F.min("timestamp"))).first()[0] == 2010
    ferry = data.items.where("item_id = 'ml_item_503'").first()
    assert ferry.category == "Mystery" and "Crime" in ferry.tags and "Drama" not in ferry.tags
    assert ferry.user_tags == "harbour slow burn"
    assert ferry.text_description == "Night Ferry (2008) Mystery Crime harbour slow burn"
    assert {r.user_id for r in data.users.collect()} == {"ml_user_70", "ml_user_71", "ml_user_72"}
    assert T.read_ratings(spark, ratings_dir, max_rows=3).interactions.count() == 3


def test_read_retail(spark, retail_dir):
    data = T.read_retail(spark, retail_dir)
    assert {r.event_type for r in data.interactions.collect()} == {"purchase"}
    items = {r.item_id: r for r in data.items.collect()}
    assert len(items) == 3
    hat = items["hm_item_7"]
    assert (hat.title, hat.category) == ("Tall wool hat", "Hat") and "Knit" in hat.tags
    assert items["hm_item_8"].text_description.startswith("Clay cup Cup")
    meta = {r.user_id: r.metadata for r in data.users.collect()}
    assert meta["hm_user_k9"] == '{"postal_code":"7790","club_member_status":"GOLD"}'


def test_metadata_keeps_nulls(make):
    out = pack_metadata_json(make([("u", None, "x")], "user_id string, a string, b string"))
    assert out.first().metadata == '{"a":null,"b":"x"}'


def test_hints():
    found = T.map_columns(["customer_no", "prod_name", "article_id", "stars", "t_dat", "Review"])
    assert found["user_id"] == "customer_no" and found["item_id"] == "article_id"
    assert found["rating"] == "stars" and found["title"] == "prod_name"
    assert found["description"] == "Review"
    with pytest.raises(ValueError, match="could not detect"):
        T.map_columns(["a", "b"])


def test_hinted_dataset(make):
    df = make(
        [("a", "x", "BUY", None), ("a", "x", "stare", "T"), ("b", "y", "watch", "U")],
        "user string, item string, event string, title string",
    )
    data = T.map_columns_by_hint(df)
    assert sorted(r.event_type for r in data.interactions.collect()) == ["purchase", "view", "view"]
    assert {(r.item_id, r.title) for r in data.items.collect()} == {("x", "T"), ("y", "U")}
    numeric = make([("a", "x", 4.0), ("a", "y", 900.0)], "user string, item string, score double")
    kinds = [r.event_type for r in T.map_columns_by_hint(numeric).interactions.orderBy("item_id").collect()]
    assert kinds == ["view", "like"]
    plain = T.map_columns_by_hint(make([("a", "x")], "user string, item string"))
    assert plain.interactions.first().event_type == "view"


def test_vocabularies():
    assert set(SERVING_EVENTS) - set(BATCH_EVENTS) == {"rate"}


def test_event_expressions(make):
    df = make([(4.0, "Buy"), (4.1, "nope"), (5.2, None), (-1.0, "LIKE")], "r double, w string")
    got = df.select(rating_to_event("r").alias("e"), text_to_event("w").alias("t")).collect()
    assert [r.e for r in got] == ["view", "like", None, None]
    assert [r.t for r in got] == ["purchase", "view", "view", "like"]
    w = make([(e,) for e in ("view", "click", "like", "purchase", "rate")], "e string")
    assert [r[0] for r in w.select(event_weight("e")).collect()] == [1, 2, 3, 5, 1]


def test_epoch_decided_per_row(make):
    df = make([(1700000000,), (1700000000000,)], "t long")
    got = [r[0] for r in df.select(F.unix_seconds(epoch_to_timestamp("t"))).collect()]
    assert got == [1700000000, 1700000000]


def test_recency(history, spark):
    days = history(10, step="24 hours")
    w = [r.recency for r in V.apply_recency(days).orderBy("timestamp").collect()]
    assert w[0] == pytest.approx(math.exp(-0.035 * 9)) and w[-1] == pytest.approx(1.0)
    capped = Settings(recency_lambda=0.1, recency_unit="hours", recency_max_age_days=1 / 24)
    w = [r.recency for r in V.apply_recency(history(3), capped).orderBy("timestamp").collect()]
    assert w == pytest.approx([math.exp(-0.1), math.exp(-0.1), 1.0])
    with pytest.raises(ValueError, match="unsupported recency unit"):
        recency_weight("timestamp", F.current_timestamp(), unit="weeks")


def test_validate_interactions(make, spark):
    df = make(
        [("u", "i", "view", 1700000000), ("u", "i", "view", 1700000000), ("u", "i", "rate", 1700000000)],
        "user_id string, item_id string, event_type string, timestamp long",
    )
    assert V.validate_interactions(df).count() == 1
    with pytest.raises(ValueError, match="unsupported event types"):
        V.validate_interactions(df, drop_unknown=False)
    with pytest.raises(ValueError, match="missing required columns"):
        V.validate_interactions(df.drop("item_id"))
    with pytest.raises(ValueError, match="null values"):
        V.validate_interactions(df.withColumn("user_id", F.lit(None).cast("string")))


def test_validate_items_and_users(make):
    items = make(
        [("1", "T ", "C", None, None), ("2", "T", "", "t", "own")],
        "item_id string, title string, category string, tags string, text_description string",
    )
    got = {r.item_id: r.text_description for r in V.validate_items(items).collect()}
    assert got == {"1": "T C", "2": "own"}
    users = make([("u", "b", 2), ("u", "a", 1), ("v", None, 3)], "user_id string, metadata string, n int")
    got = {r.user_id: r.metadata for r in V.validate_users(users, ["n"]).collect()}
    assert got == {"u": "a", "v": None}


def test_trim(history):
    rows = V.trim_to_max_rows(history(100), 10).collect()
    ids = sorted(r.item_id for r in rows)
    assert len(ids) == 10 and ids[0] == "i0000" and ids[-1] == "i0099"
    assert sorted(r.item_id for r in V.trim_to_max_rows(history(9), 4).collect()) == [
        "i0000", "i0003", "i0005", "i0008",
    ]
    assert V.trim_to_max_rows(history(5), 1).collect()[0].item_id == "i0000"
    assert V.trim_to_max_rows(history(5), 9).count() == 5
    assert V.trim_to_max_rows(history(5), 2, "head").count() == 2
    with pytest.raises(ValueError, match="unsupported trim mode"):
        V.trim_to_max_rows(history(5), 2, "tail")


def test_low_activity(history):
    assert V.filter_low_activity_users(history(10, users=4), 3).count() == 6


def _sizes(df):
    return {r.split: r["count"] for r in df.groupBy("split").count().collect()}


def test_global_split(history):
    out = S.split_time_global(history(100))
    assert _sizes(out) == {"train": 70, "validation": 10, "test": 20}
    top = {r.split: r.m for r in out.groupBy("split").agg(F.max("item_id").alias("m")).collect()}
    assert top == {"train": "i0069", "validation": "i0079", "test": "i0099"}
    with pytest.raises(ValueError, match="sum to 1"):
        S.split_time_global(history(3), (0.5, 0.1, 0.1))


@pytest.mark.parametrize("n", [1, 2, 5, 9, 10, 33])
@pytest.mark.parametrize("step", ["0 hours", "7 minutes", "1 hour"])
def test_global_split_ties(history, n, step):
    """Rows sharing an hour, or one single time, are cut by the total order."""
    out = S.split_time_global(history(n, step=step))
    t = int(n * 0.7)
    v = int(n * 0.1)
    order = "user_id, item_id" if step == "0 hours" else "timestamp"
    got = [r.split for r in out.orderBy(*[c.strip() for c in order.split(",")]).collect()]
    assert got == ["train"] * t + ["validation"] * v + ["test"] * (n - t - v)


@pytest.mark.parametrize("n,want", [(2, (1, 1, 0)), (3, (2, 1, 0)), (4, (2, 1, 1)), (10, (7, 1, 2))])
def test_user_split(history, n, want):
    got = _sizes(S.split_per_user(history(n, users=1)))
    assert tuple(got.get(s, 0) for s in S.SPLITS) == want


def test_user_split_short_history(history):
    assert _sizes(S.split_per_user(history(2, users=1), min_history=3)) == {"train": 2}


def test_top_tags_ties(make):
    tags = make([("a", t) for t in "zzyyx"] + [("a", None)], "item_id string, tag string")
    assert top_tags_per_item(tags, 2).first().user_tags == "y z"


def test_ingest_and_reload(spark, ratings_dir, tmp_path):
    out = str(tmp_path / "out")
    summary = {r.split: r.rows for r in ingest(spark, "movielens", ratings_dir, out).collect()}
    assert sum(summary.values()) == 4  # user 70 only: the others have one interaction
    back = T.load_processed(spark, out, [s for s in summary])
    assert back["items"].count() == 4 and back["users"].count() == 3
    with pytest.raises(FileNotFoundError, match="missing processed splits"):
        T.load_processed(spark, out, ["train", "nope"])
    m = spark.read.json(f"{out}/manifest").first()
    assert m.dataset.row_count == 4 and m.dataset.dataset_version == "movielens-local"
    assert len(m.dataset.checksum) == 64
    with pytest.raises(ValueError, match="unknown dataset"):
        ingest(spark, "x", ratings_dir, out)


def test_ingest_keeps_all_rows_unless_asked(spark, ratings_dir, tmp_path):
    few = str(tmp_path / "few")
    rows = ingest(spark, "movielens", ratings_dir, few, max_rows=5, min_interactions=1).collect()
    assert sum(r.rows for r in rows) == 5
    assert Settings().max_rows is None and Settings().eval_max_users is None


def test_file_checksums(spark, tmp_path):
    import hashlib

    (tmp_path / "a.bin").write_bytes(b"hello")
    row = T.file_checksums(spark, str(tmp_path)).first()
    assert (row.name, row.sha256, row.size_bytes) == ("a.bin", hashlib.sha256(b"hello").hexdigest(), 5)


def test_mounted_files_are_not_loaded_whole(spark, tmp_path):
    """Spark's reader refuses files beyond a length (2 GB unless told otherwise); here 4 bytes."""
    import hashlib

    (tmp_path / "a.bin").write_bytes(b"hello")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "4")
    try:
        row = T.file_checksums(spark, str(tmp_path)).first()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert (row.name, row.sha256, row.size_bytes) == ("a.bin", hashlib.sha256(b"hello").hexdigest(), 5)


def test_sample_is_stable(history):
    a = sample_rows(history(50), ["item_id"], 5).collect()
    assert a == sample_rows(history(50).repartition(7), ["item_id"], 5).collect() and len(a) == 5


def test_classify_error(make):
    texts = ["Read timed out", "ConnectError", "HTTP 403", "boom", "dns timeout"]
    df = make([(t,) for t in texts], "m string")
    got = [r[0] for r in df.select(classify_error("m")).collect()]
    assert got == ["timeout", "connection", "unavailable", "other", "timeout"]


def test_experiment_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    T.record_experiment(spark, path, "als", "v1", "d", {"recall@20": 0.1})
    T.record_experiment(spark, path, "als", "v2", "d", {"recall@20": 0.2})
    T.record_experiment(spark, path, "als", "v3", "d", {})
    row = T.ablation_table(T.read_experiments(spark, path)).first()
    assert (row.version, row.recall_20, row.coverage) == ("v2", 0.2, 0.0)
    last = T.ablation_table(T.read_experiments(spark, path), require_metrics=False).first()
    assert last.version == "v3"


def test_checks_ride_on_the_one_pass_that_lands_the_rows(spark):
    """Rows are counted by a function that each pass would run again."""
    from tastemill.operators import validate as V

    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            passed.add(b.num_rows)
            yield b

    rows = spark.range(1000).selectExpr(
        "concat('u', id % 7) AS user_id", "IF(id = 500, NULL, concat('i', id % 50)) AS item_id", "'view' AS event_type",
        "timestamp'2024-01-01' + id * interval 1 hour AS timestamp",
    )
    seen = rows.mapInArrow(count, rows.schema)
    with pytest.raises(ValueError, match=r"interactions has null values in required columns: \['item_id'\]"):
        V.validate_interactions(seen)
    assert passed.value == 1000
    good = seen.where("item_id IS NOT NULL")
    out = V.validate_interactions(good)
    assert passed.value == 2000
    assert out.count() == 999 and out.distinct().count() == 999 and passed.value == 2000
    with pytest.raises(ValueError, match="unsupported event types"):
        V.validate_interactions(good.withColumn("event_type", F.lit("odd")), drop_unknown=False)
    assert V.validate_interactions(rows.limit(0)).count() == 0
    assert V.validate_interactions(spark.createDataFrame([], rows.schema)).count() == 0
    with pytest.raises(ValueError, match="missing required columns"):
        V.validate_users(rows.drop("user_id"), [])
