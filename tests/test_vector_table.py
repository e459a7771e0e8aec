"""Change sets, tombstones, replays and merges of the vector table against a dictionary."""

import random

import pytest

from tastemill.sources.vector_table import VectorTable, bucket_of

SCHEMA = "point_id string, item_id string, vector array<double>, version long, deleted boolean"


class Dictionary:
    def __init__(self):
        self.rows, self.names = {}, set()

    def apply(self, name, rows):
        if name in self.names:
            return False
        self.names.add(name)
        for p, i, v, n, gone in rows:
            if p not in self.rows or n > self.rows[p][2]:
                self.rows[p] = (i, v, n, gone)
        return True

    def read(self):
        return sorted((p, i, n, v) for p, (i, v, n, gone) in self.rows.items() if not gone)


def got(table):
    return sorted((r["point_id"], r["item_id"], r["version"], list(r["vector"])) for r in table.read().collect())


def test_against_a_dictionary(spark, tmp_path):
    rng = random.Random(3)
    table, want = VectorTable(spark, str(tmp_path / "t"), 8), Dictionary()
    assert table.read().count() == 0 and table.merge() == []
    old = []
    for step in range(9):
        points = rng.sample(range(40), 12)
        rows = [(f"p{p}", f"i{p}", [float(p), float(step)], step + rng.randrange(3) * 10 + p / 100 // 1 + p * 1000, rng.random() < 0.25) for p in points]
        rows = [(p, i, v, int(n), gone) for p, i, v, n, gone in rows]
        name, sent = (f"s{step}", rows) if step % 4 or not old else rng.choice(old)
        old.append((f"s{step}", rows))
        df = spark.createDataFrame(sent, SCHEMA)
        assert table.apply(name, df) == want.apply(name, sent)
        if step in (2, 5, 6):
            touched = table.merge()
            assert touched and table.pending() == [] and table.merge() == []
        assert got(table) == want.read()
    # Another reader of the folder sees the same.
    assert got(VectorTable(spark, str(tmp_path / "t"))) == want.read()


def test_a_merge_rewrites_touched_buckets_alone(spark, tmp_path):
    table = VectorTable(spark, str(tmp_path / "t"), 16)
    rows = spark.range(200).selectExpr("concat('p', id) AS point_id", "'i' AS item_id", "array(1.0D) AS vector", "1L AS version")
    assert table.apply("load", rows)
    assert table.merge() == list(range(16))
    before = table.head()["gens"]
    few = rows.where("point_id IN ('p3', 'p77')").selectExpr("point_id", "item_id", "vector", "2L AS version")
    table.apply("few", few)
    touched = table.merge()
    want = sorted({r[0] for r in few.select(bucket_of(few["point_id"], 16)).collect()})
    after = table.head()["gens"]
    assert touched == want and {int(b) for b in after if after[b] != before[b]} == set(want)
    assert table.read().count() == 200


def test_a_tombstone_outlives_late_older_rows(spark, tmp_path):
    table = VectorTable(spark, str(tmp_path / "t"), 4)
    row = lambda n, x: spark.createDataFrame([("p", "i", [x], n)], "point_id string, item_id string, vector array<double>, version long")
    table.apply("a", row(1, 1.0))
    table.delete("b", row(1, 1.0).select("point_id"), 2)
    table.merge()
    table.apply("c", row(1, 5.0))
    assert table.read().count() == 0
    table.apply("d", row(3, 7.0))
    assert got(table) == [("p", "i", 3, [7.0])]


def test_writers_of_one_name(spark, tmp_path):
    table = VectorTable(spark, str(tmp_path / "t"), 4)
    assert table._create("commits/x", "first") and not table._create("commits/x", "second")
    assert table._text("commits/x") == "first"
    with pytest.raises(RuntimeError):
        table.apply("y", spark.createDataFrame([("p", "i", [1.0], 1, False)], SCHEMA))
        table.pending = lambda: ["y"]
        table._create("heads/1", "{}")
        names = table._names
        table._names = lambda folder: ["0"] if folder == "heads" else names(folder)
        table.merge()
