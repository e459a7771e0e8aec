"""Exact vocabulary and sparse search against plain arithmetic."""

import math
import random
from collections import Counter

import pytest

from tastemill.operators.sparse_text import SparseText, catalog_texts, embed_items_sparse
from tastemill.plans import serve

ITEMS = "item_id string, title string, category string, tags string, text_description string"


def unit(text, idf):
    w = {t: n * idf[t] for t, n in Counter(text.split()).items() if idf.get(t, 0) > 0}
    length = math.sqrt(sum(x * x for x in w.values()))
    return {t: x / length for t, x in w.items()} if length else {}


def test_against_plain_arithmetic(make):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(900)] + ["every"]
    texts = {f"i{k:03d}": " ".join(["every", *rng.choices(words, k=rng.randrange(6))]) for k in range(300)}
    texts["i300"] = "every"
    asked = {f"q{k}": " ".join(rng.choices([*words, "strange"], k=4)) for k in range(40)} | {"none": "strange every", "empty": ""}
    fitted = make(list(texts.items()), "id string, text string")
    encoder = SparseText.fit(fitted)
    rows = encoder.vocabulary.collect()
    used = {t for x in texts.values() for t in x.split()}
    assert sorted(r["word_idx"] for r in rows) == list(range(len(used))) and {r["word"] for r in rows} == used
    idf = {t: math.log((len(texts) + 1) / (sum(t in x.split() for x in texts.values()) + 1)) for t in used}
    queries = encoder.encode(make(list(asked.items()), "id string, text string")).withColumnRenamed("id", "query_id")
    got = {}
    for r in encoder.search(queries, encoder.encode(fitted).withColumnRenamed("id", "item_id"), 5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["item_id"], r["score"]))
    for q, text in asked.items():
        a = unit(text, idf)
        scored = []
        for i, x in texts.items():
            s = round(sum(v * unit(x, idf).get(t, 0) for t, v in a.items()), 9)
            if s > 0:
                scored.append((-s, i))
        want = [(i, -s) for s, i in sorted(scored)[:5]]
        assert [i for i, _ in got.get(q, [])] == [i for i, _ in want]
        assert [s for _, s in got.get(q, [])] == pytest.approx([s for _, s in want], abs=1e-9)


def test_serving_with_sparse_vectors(make):
    items = make(
        [("1", "Star Wars", "Sci-Fi", "space", "space opera about rebels"), ("2", "Alien", "Horror", "space", "horror in space"),
         ("3", "Toy Story", "Animation", "toys", "toys come alive"), ("4", "Café", "Romance", "love", None)],
        ITEMS,
    )
    encoder = SparseText.fit(catalog_texts(items))
    vectors = embed_items_sparse(items, encoder)
    asked = make([("a", "toys"), ("b", "cafe love"), ("c", "ali"), ("d", "qqq")], "request_id string, q string")
    out = serve.search_with_fallback(asked, items, vectors, encoder)
    best = {r["request_id"]: (r["item_id"], r["source"]) for r in out.where("rank = 1").collect()}
    assert best == {"a": ("3", "semantic"), "b": ("4", "semantic"), "c": ("2", "keyword")}


def shuffled_rows(df):
    """Rows that the stages of a finished query sent through shuffles, and what it returned."""
    rows = df.collect()
    sent, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "ShuffleExchangeExec":
            sent += p.metrics().apply("shuffleRecordsWritten").value()
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif hasattr(p, "plan") and p.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(p.plan())
    return sent, rows


def test_search_does_not_shuffle_pairs(make):
    """60 queries share a word with 1,500 items each: 90,000 pairs, of which each query keeps 3."""
    encoder = SparseText.fit(make([(f"i{k}", f"common w{k % 50}") for k in range(1500)] + [("other", "strange")], "id string, text string"))
    items = encoder.encode(make([(f"i{k}", f"common w{k % 50}") for k in range(1500)], "id string, text string")).withColumnRenamed("id", "item_id")
    asked = encoder.encode(make([(f"q{k:02d}", f"common w{k % 50}") for k in range(60)], "id string, text string")).withColumnRenamed("id", "query_id")
    sent, rows = shuffled_rows(encoder.search(asked, items, 3))
    assert 0 < sent < 20_000
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], []).append((r["rank"], r["item_id"], r["score"]))
    assert len(got) == 60
    for q, found in got.items():
        same = sorted(f"i{k}" for k in range(1500) if k % 50 == int(q[1:]) % 50)[:3]
        assert [(n, i) for n, i, _ in sorted(found)] == [*enumerate(same, 1)] and {s for *_, s in found} == {1.0}
