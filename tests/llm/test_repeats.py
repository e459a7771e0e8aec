import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from brute import jaccard, substring, suffix

import brute
from corpora import make_corpus, passage
from tastemill.llm import ngram_join
from tastemill.llm import substring as S
from tastemill.llm import suffix as X
from tastemill.llm import repeats as R
from tastemill.llm.common import SpanHash, mix


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


SUB = ("doc_id", "n_words", "n_removed", "kept_sha256")
SUF = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("seed", [1, 2])
def test_substring(docs, seed):
    rows = make_corpus(seed)
    assert rows_of(S.remove_repeats(docs(rows)), *SUB) == sorted(substring(rows), key=repr)


def test_substring_repeated_rows_and_null_ids(docs, corpus):
    text = corpus[3][1] or ""
    long = passage(random.Random(5), 50)
    rows = [*corpus, (3, text), (None, long), (None, long), (500, long), (500, long), (500, long + " tail")]
    assert rows_of(S.remove_repeats(docs(rows)), *SUB) == sorted(substring(rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix(docs, seed):
    rows = make_corpus(seed)
    assert rows_of(X.remove_repeats(docs(rows)), *SUF) == sorted(suffix(rows), key=repr)


def test_suffix_repeated_rows_null_ids_and_frequent_names(docs, corpus):
    long = passage(random.Random(6), 80)
    rows = [*corpus, (None, long), (None, long), (7, "x" * 199), (8, "y" * 200), (9, "y" * 200)]
    want = sorted(suffix(rows), key=repr)
    assert rows_of(X.remove_repeats(docs(rows)), *SUF) == want
    # Every name counts as too frequent: all windows go by hash.
    assert rows_of(X.remove_repeats(docs(rows), hot_limit=0), *SUF) == want


def test_suffix_narrow_windows(docs, corpus):
    got = rows_of(X.remove_repeats(docs(corpus), width=24, rounds=1), *SUF)
    assert got == sorted(suffix(corpus, 24), key=repr)


def test_empty_tables(docs, spark):
    none = docs([]).limit(0)
    assert S.remove_repeats(none).count() == 0
    assert X.remove_repeats(none).count() == 0
    assert ngram_join.join_classes(none).count() == 0


def test_join(docs):
    for seed in (1, 3):
        rows = make_corpus(seed)
        got = {r["doc_id"]: (r["n_names"], r["component_id"]) for r in ngram_join.join_classes(docs(rows)).collect()}
        assert got == jaccard(rows)


def near_group(n, seed=4):
    """Many different near copies of one text, some too far from it, next to unrelated texts."""
    rng = random.Random(seed)
    base = passage(rng, 120, 5000).split()
    rows = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 5])):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        rows.append((k, " ".join(w)))
    # Shares most frequent names with the group, too little to link.
    for k in range(20):
        rows.append((n + k, " ".join(base[:60]) + " " + passage(rng, 60, 5000)))
    return rows


@pytest.mark.parametrize("block", [20_000, 16])
def test_join_large_near_group(docs, block):
    rows = near_group(120)
    found = ngram_join.join_classes(docs(rows), cells=256, block=block)
    assert {r["doc_id"]: (r["n_names"], r["component_id"]) for r in found.collect()} == jaccard(rows)


def test_near_copies_beside_dissimilar_documents_of_one_passage(docs, monkeypatch):
    """Pairs that are looked at grow with the documents, not with the square of either group."""
    rng = random.Random(12)
    seen = []
    held = ngram_join.verify
    monkeypatch.setattr(ngram_join, "verify", lambda pairs, *rest: seen.append(pairs.count()) or held(pairs, *rest))
    shared = passage(rng, 50, 5000)
    rows = near_group(350, 3)
    rows += [(10_000 + k, passage(rng, 60, 9000) + " " + shared + " " + passage(rng, 60, 9000)) for k in range(500)]
    found = ngram_join.join_classes(docs(rows))
    assert {r["doc_id"]: (r["n_names"], r["component_id"]) for r in found.collect()} == jaccard(rows)
    assert sum(seen) < 12 * len(rows)


def test_counts_of_names_are_summed_over_tasks(docs):
    rows = [(k, f"the very same four words and own{k} one{k}") for k in range(700)]
    described = ngram_join.describe(ngram_join.with_row(docs(rows)), ngram_join.Rule(), 1 << 12)
    counts = ngram_join.name_counts(described, 1 << 12)
    common, own = (ngram_join.name_sets(pa.array([t]), 4)[0] for t in ("the very same four words", "and own5 one5 x"))
    assert np.allclose(np.exp2(counts[ngram_join.cell_of(common, 1 << 12)] / ngram_join.STEPS), 700, rtol=0.1)
    assert (counts[ngram_join.cell_of(own, 1 << 12)] == 0).all()


def test_join_other_rule(docs):
    rows = make_corpus(5)
    rule = ngram_join.Rule(n=5, num=80, den=100)
    got = {r["doc_id"]: (r["n_names"], r["component_id"]) for r in ngram_join.join_classes(docs(rows), rule).collect()}
    assert got == jaccard(rows, 5, 80, 100)


def test_join_repeated_rows_and_null_ids(docs):
    text = passage(random.Random(9), 30)
    rows = [(5, text), (5, text), (None, text), (None, "alone in the world here"), (2, text + " z"), (9, None)]
    got = sorted(((r["doc_id"], r["component_id"]) for r in ngram_join.join_classes(docs(rows)).collect()), key=repr)
    assert got == sorted([(5, 2), (5, 2), (None, 2), (None, None), (2, 2), (9, 9)], key=repr)


def test_prefixes_of_similar_sets_share_enough():
    rng = np.random.default_rng(0)
    rule = ngram_join.Rule()
    for _ in range(200):
        size = int(rng.integers(2, 400))
        a = np.unique(mix(rng.integers(0, 2**63, size).astype(np.uint64)))
        b = a[rng.random(len(a)) > 0.07]
        if not len(b) or rule.den * len(b) < rule.num * len(a):
            continue
        counts = (rng.integers(2, 200, 256) * (rng.random(256) < 0.1)).astype(np.uint8)
        (x, p), (y, q) = (ngram_join.prefix(s, counts, rule) for s in (a, b))
        assert len(np.intersect1d(x, y)) >= min(p, q)


def test_equal_windows_share_their_anchor():
    rng = np.random.default_rng(1)
    common = rng.integers(0, 50, 60)
    docs_ = [np.concatenate([rng.integers(0, 50, 30), common, rng.integers(0, 50, 30)]) for _ in range(2)]
    names = mix(np.concatenate(docs_).astype(np.uint64))
    first = np.array([0, 120, 240])
    spans = SpanHash(names)
    parse = R.positions(first)
    for level in range(2):
        parse = R.recompress(parse, spans, level)
    seg = R.anchors(parse, spans, first, 13)
    of = {}
    for s, e, a in zip(seg.start, seg.stop, seg.anchor):
        for i in range(s, e):
            of[i] = seg.key[a] if a >= 0 else None
    assert all(of[30 + k] == of[150 + k] for k in range(48))
    assert brute.words(" a\x0bb ") == ["a", "b"]


def test_memory_of_induction_and_of_held_pairs():
    n, width = 4_000, 200
    suffixes = pa.array([b"%05d" % (k // 2) + b"a" * (width - 5) for k in range(n)], pa.binary())
    tracemalloc.start()
    try:
        t, x = X.induce(np.zeros(n, np.int64), suffixes, pa.array([b""] * n, pa.binary()), width)
        induced = tracemalloc.get_traced_memory()[1]
        rng = np.random.default_rng(1)
        names = ["a", "b", "need", "n", *(f"c{k}" for k in range(10))]
        held = [{c: rng.integers(0, 9, 50_000) for c in names} for _ in range(2)]
        tracemalloc.reset_peak()
        size = sum(v.nbytes for h in held for v in h.values())
        before = tracemalloc.get_traced_memory()[0]
        ngram_join._summed_pairs(ngram_join._joined_pairs(held))
        summed = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    assert sorted(t.tolist()) == list(range(n)) and not x.any()
    assert induced < 6 * n * width
    assert summed < size
