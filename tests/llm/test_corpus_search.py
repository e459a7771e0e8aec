import math
import random

import numpy as np
import pytest
from brute import words

import corpus_pipeline
from corpora import DOCS, passage
from tastemill.llm import decontaminate, graph, nndescent


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 420)] + [(900, k) for k in range(901, 960)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(x, x) == top(x) for x in parent)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def leaks_by_hand(rows, items):
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    texts = {i: words((t or "").lower()) for i, t in items}
    distinct = {tuple(w) for w in texts.values() if w}
    df = {}
    for w in distinct:
        for s in shingles(list(w)):
            df[s] = df.get(s, 0) + 1
    weigh = {s: round(math.log1p(len(distinct) / n) * 1000) for s, n in df.items()}
    top = max(weigh.values(), default=0)
    found = {}
    for d, t in rows:
        w = words((t or "").lower())
        for i, item in texts.items():
            for at in range(-len(item) + 1, len(w)):
                window = shingles(w[max(at, 0) : at + len(item)])
                b = shingles(item)
                total = sum(weigh.get(s, top) for s in window | b)
                sim = sum(weigh.get(s, top) for s in window & b) / total if total else 0
                if sim >= 0.8:
                    found[d, i] = max(sim, found.get((d, i), 0))
    return found


def test_leaks(spark, docs):
    rng = random.Random(8)
    items = [(k, passage(rng, rng.randrange(15, 60), 3000)) for k in range(12)]
    items += [(12, items[0][1]), (13, "too short"), (14, None), (15, ""), (16, items[1][1] + " " + passage(rng, 10, 3000))]
    rows = []
    for k in range(40):
        before, after = passage(rng, rng.randrange(0, 60), 3000), passage(rng, rng.randrange(0, 60), 3000)
        item = (items[k % 12][1] if k % 3 else "").split()
        if item and k % 4 == 1:
            item[rng.randrange(len(item))] = "edited"
        if item and k % 4 == 2:
            item = item[: len(item) // 2]
        rows.append((k, f"{before} {' '.join(item).upper() if k % 2 else ' '.join(item)}\n{after}"))
    rows += [(100, None), (101, ""), (102, "too short"), (103, items[3][1]), (103, items[3][1]), (None, items[4][1]), (104, "w " * 20_000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.leaks(docs(rows), bench).collect()
    want = leaks_by_hand([r for r in rows if r[0] is not None and r[0] != 104], items)
    # By hand any window counts; the operator takes those aligned with the item.
    assert {(r["doc_id"], r["item_id"]) for r in got if r["doc_id"] is not None} == want.keys()
    assert all(0.8 <= r["similarity"] <= want[r["doc_id"], r["item_id"]] + 1e-9 for r in got if r["doc_id"] is not None)
    assert sum(r["doc_id"] == 103 and r["item_id"] == 3 for r in got) == 2
    assert {r["item_id"] for r in got if r["doc_id"] is None} == {4}
    assert decontaminate.leaks(docs(rows).limit(0), bench).count() == 0
    assert decontaminate.leaks(docs(rows), bench.limit(0)).count() == 0


def test_leaks_of_items_with_common_text(spark, docs):
    """Items that share a template and differ in one rare word, and items of fewer words than a shingle."""
    rng = random.Random(13)
    template = passage(rng, 104, 10**6)
    items = [(k, f"{template} own{k}") for k in range(60)] + [(100, "alpha beta"), (101, "gamma"), (102, "one two three four")]
    rows = [(k, f"{passage(rng, 5, 3000)} {template} other{k} {passage(rng, 5, 3000)}") for k in range(2)]
    rows += [(10, "Here Alpha beta and one two three four five"), (11, "beta alpha then gamma"), (12, "alpha beta"), (13, "one two three")]
    got = decontaminate.leaks(docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = leaks_by_hand(rows, items)
    assert {(k, j) for k in range(2) for j in range(60)} | {(10, 100), (10, 102), (11, 101), (12, 100)} == want.keys()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want.keys()


def test_radius_follows_the_similarity():
    assert [decontaminate.radius_of(s) for s in (1.0, 0.8)] == [0, 23]


def test_hamming_join_misses_nothing(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-(2**63), 2**63 - 1, 30)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(63, int(rng.integers(0, 20)), replace=False)) for b in base for _ in range(4)]
    left = spark.createDataFrame([(k, int(v)) for k, v in enumerate(near)], "w long, fp long")
    right = spark.createDataFrame([(k, int(v)) for k, v in enumerate(base)], "item long, item_fp long")
    got = {(r["w"], r["item"]) for r in decontaminate.hamming_candidates(left, right).collect()}
    want = {(i, j) for i, a in enumerate(near) for j, b in enumerate(base) if bin((a ^ int(b)) & (2**64 - 1)).count("1") <= 15}
    assert got == want


def vectors_by_hand(rows, threshold=0.9):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {i: [0, i] for i, _ in rows}
    links = [
        (a, b) for k, (a, x) in enumerate(good) for b, y in good[k + 1 :]
        if len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold
    ]
    for a, b in links:
        out[a][0] += 1
        out[b][0] += 1
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(out[a][1], out[b][1])
            changed |= out[a][1] != low or out[b][1] != low
            out[a][1] = out[b][1] = low
    return {i: (n, c, c == i) for i, (n, c) in out.items()}


def test_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [rng.normal(size=16).tolist() for _ in range(150)]
    for k in range(20):
        rows += [(np.array(rows[k]) + rng.normal(size=16) * 0.1).tolist() for _ in range(k % 4)]
    centre = rng.normal(size=16)
    rows += [(centre + rng.normal(size=16) * 0.05).tolist() for _ in range(60)]  # saturates the lists
    rows += [rows[0], rows[0], rows[5], [2 * x for x in rows[7]]]
    rows += [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    order = rng.permutation(len(rows)).tolist()
    rows = [(k, rows[j]) for k, j in enumerate(order)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS label", "2 AS node", "3 AS x").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in nndescent.near_duplicates(df).collect()}
    assert got == vectors_by_hand(rows)
    assert nndescent.near_duplicates(df.limit(0)).count() == 0


def test_vectors_of_very_large_and_very_small_numbers(spark):
    base = [0.3, -1.0, 0.7, 0.2]
    rows = [(k + 1, [x * s for x in base]) for k, s in enumerate((1e160, 1.5e160, 1e-170, 2e-170, 1.0, 2.0))]
    rows += [(9, [1e308, 1e308, -1e308, 1e308]), (10, [5e-324, 0.0, 0.0, 0.0]), (11, [1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in nndescent.near_duplicates(df).collect()}
    assert all(got[k] == (5, 1) for k in range(1, 7))
    assert got[9] == (0, 9) and got[10] == (1, 10) and got[11] == (1, 10)


def test_vectors_link_across_saturated_groups(spark):
    """Groups that fill each other's lists still link with other groups and with single vectors."""
    rng = np.random.default_rng(9)
    unit = lambda v: v / np.sqrt(v @ v)
    rows = [rng.normal(size=32) for _ in range(100)]
    for _ in range(8):
        centre = unit(rng.normal(size=32))
        for _ in range(2):  # about 0.996 inside, 0.93 between the two
            near = unit(centre + 0.2 * unit(rng.normal(size=32)))
            rows += [near + 0.05 * unit(rng.normal(size=32)) for _ in range(20)]
        rows.append(centre + 0.3 * unit(rng.normal(size=32)))
    order = rng.permutation(len(rows)).tolist()
    rows = [(k, rows[j].tolist()) for k, j in enumerate(order)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in nndescent.near_duplicates(df).collect()}
    assert got == vectors_by_hand(rows)


def test_vectors_missed_by_the_lists(spark, monkeypatch):
    """Links that the lists don't hold are found by comparing blocks, in place of a silent end."""
    rng = np.random.default_rng(10)
    rows = [rng.normal(size=24) for _ in range(400)]
    rows += [r + rng.normal(size=24) * 0.05 for r in rows[:150]]
    rows = [(k, rows[j].tolist()) for k, j in enumerate(rng.permutation(len(rows)).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(nndescent, "ROUNDS", 0)
    whole = nndescent.start_lists
    monkeypatch.setattr(nndescent, "start_lists", lambda *a: whole(*a).where("pmod(node + nbr, 3) > 0"))
    want, size = vectors_by_hand(rows), nndescent.audit

    def few(links, nodes, threshold):
        return size(links, nodes, threshold, rows=100, least=20)

    for judge in (few, size):  # a sample of the nodes, and all of them
        monkeypatch.setattr(nndescent, "audit", judge)
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in nndescent.near_duplicates(df, audits=1).collect()}
        assert got == want


def test_audit_sample_grows_until_it_holds_links(spark):
    rng = np.random.default_rng(11)
    rows = [rng.normal(size=24) for _ in range(300)]
    rows += [r + rng.normal(size=24) * 0.05 for r in rows[:4]]
    nodes = nndescent.vector_classes(spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(rows)], "vec_id long, v array<double>"))
    none = spark.createDataFrame([], "a long, b long")
    recall, true = nndescent.audit(none, nodes, 0.9, rows=5, least=4)
    assert recall == 0.0
    assert true is None or {(r["a"], r["b"]) for r in true.collect()} == {(k, 300 + k) for k in range(4)}


def test_pipeline(spark, tmp_path):
    rng = random.Random(12)
    text = lambda n: passage(rng, n, 3000)
    good = [(k, text(120)) for k in range(60)]
    bad = [(100 + k, "BUY!! NOW!! | $$$ " * 30) for k in range(30)]
    item, shared = text(40), text(80)
    rows = good + bad
    rows += [(200, good[0][1]), (201, good[1][1] + " tail")]  # an exact and a near copy
    rows += [(210 + k, f"{text(60)} {shared} {text(60)}") for k in range(3)]
    rows += [(220, f"{text(60)} {item} {text(60)}"), (230, None), (231, ""), (1, good[1][1])]
    full = [(d, t, "en", "s", None if t is None else len(t)) for d, t in rows]
    spark.createDataFrame(full, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(d, 1, 0) for d, _ in good] + [(d, 0, 0) for d, _ in bad]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").selectExpr("*", "1 AS _row", "2 AS _score", "3 AS _ranges")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.store(stage(spark, docs, str(tmp_path)), name)
        assert out.columns == docs.columns
        docs = out
        kept[name] = {r["doc_id"]: r["text"] for r in out.collect()}
        assert {(r["_row"], r["_score"], r["_ranges"]) for r in out.collect()} <= {(1, 2, 3)}
    assert not {d for d, _ in bad} & kept["quality"].keys() and {d for d, _ in good} <= kept["quality"].keys()
    assert {200, 201} & kept["near_duplicates"].keys() == set() and {0, 1} <= kept["near_duplicates"].keys()
    assert all(shared not in kept["suffix_dedup"][d] and len(kept["suffix_dedup"][d]) > 300 for d in (210, 211, 212))
    assert 220 in kept["suffix_dedup"] and 220 not in kept["decontamination"]
    assert {d for d, _ in good} | {210, 211, 212} == kept["decontamination"].keys()
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in result} == kept["decontamination"].keys() and all(r["round_trip"] for r in result)


def test_fingerprints_are_written_before_they_are_joined(spark, monkeypatch):
    """Their 64 sums stay out of the plans of the join, which the driver holds."""
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"so {text} on"), (2, "other words")], "doc_id long, text string")
    items = spark.createDataFrame([(7, text)], "item_id long, text string")
    plans, join = [], decontaminate.hamming_candidates

    def candidates(left, right, *rest):
        plans.extend(df._jdf.queryExecution().optimizedPlan().toString() for df in (left, right))
        return join(left, right, *rest)

    monkeypatch.setattr(decontaminate, "hamming_candidates", candidates)
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect()] == [(1, 7)]
    assert len(plans) == 2 and not any("Aggregate" in p for p in plans)
