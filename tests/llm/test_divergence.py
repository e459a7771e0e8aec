"""The source audit against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tastemill.llm import divergence as D

SCHEMA = "doc_id long, text string, lang string, source string, n int, term string, value double, counts int, d int"


def words(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(rows, least, top=10):
    groups, docs = defaultdict(Counter), defaultdict(set)
    for d, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang, source].update(words(text))
        for w in words(text):
            docs[lang, w].add(d)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [w for (x, w), ds in docs.items() if x == lang and len(ds) >= least]
        mine = {s: {w: c[w] for w in kept} for (x, s), c in groups.items() if x == lang}
        whole = {w: sum(c[w] for c in mine.values()) for w in kept}

        def p(c):
            n = sum(c.values())
            return {w: 1 + 10**9 * (c[w] + 2) // (n + 2 * len(kept)) for w in kept}

        f = lambda a, b: (a - b) * (a - b) // (a + b)
        ps, q = {s: p(c) for s, c in mine.items()}, p(whole)
        for s in mine:
            pairs = [(o, sum(f(ps[s][w], ps[o][w]) for w in kept)) for o in mine if o != s]
            more = [(w, f(ps[s][w], q[w])) for w in kept if mine[s][w] > 0 and ps[s][w] > q[w]]
            for part, found in (("pair", pairs), ("term", more)):
                found = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (item, v) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "alpha,", "(alpha)", "beta", "beta-gamma", "GAMMA", "École", "école", "x1y", "naïve b", "漢字", "it's", "9", "--", " z", "Z", "\U0001f600ok"]
    out = []
    for k in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "\t\x0b", "  "]) for _ in range(rng.randrange(30)))
        out.append((k, text, rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c\"\\", None, "ü"])))
    out += [(n, None, "en", "a"), (n + 1, "", "lone", "only"), (n + 2, "few words", "fr", "a"), (n + 3, "", "fr", "b"), (n + 4, "alpha " * 30000, "de", "a")]
    out += [out[3], out[3], (None, "alpha beta", "en", "a"), (None, "alpha beta", "en", "a"), (5, "alpha again", "de", "b")]
    return out


@pytest.fixture()
def table(spark):
    def build(rows):
        return spark.createDataFrame([(*r, 1, "x", 2.0, 3, 4) for r in rows], SCHEMA).repartition(5)

    return build


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("least", [1, 10, 60])
def test_against_plain_counting(table, least):
    rows = corpus(least)
    assert got(D.audit_sources(table(rows), least)) == brute(rows, least)


def test_small_bounds_change_nothing(table, monkeypatch):
    rows = corpus(7)
    for name, bound in (("HELD_BYTES", 300), ("HELD_ROWS", 7), ("CELLS", 12), ("SOURCES", 2)):
        monkeypatch.setattr(D, name, bound)
    assert got(D.audit_sources(table(rows), 8, 3)) == brute(rows, 8, 3)


def test_a_source_with_most_rows_and_a_document_in_many_rows(table):
    rows = [(k, f"common w{k % 9}", "en", "big" if k % 10 else "small") for k in range(600)] + [(1, "rare", "en", "big")] * 40
    assert got(D.audit_sources(table(rows))) == brute(rows, 10)


def test_empty_table(table):
    assert D.audit_sources(table([])).count() == 0


def test_shares_of_very_large_counts(spark):
    counts = [0, 1, 7, 10**12 + 3, 4 * 10**15 - 5, 2**53 + 1]
    total = 8 * 10**15 + 17
    want = [1 + 10**9 * (c + 2) // total for c in counts]
    assert D.shares(np.array(counts, np.int64), np.array(total, np.int64)).tolist() == want
    df = spark.createDataFrame([(c, total) for c in counts], "n long, t long")
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(D.share(F.col("n"), F.col("t") - 4, F.lit(2).cast("long"))).collect()] == want
