"""Line dedup against a dictionary of keys."""

import hashlib
import random
from collections import defaultdict

import pytest

from tastemill.llm import lines

BLANK = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs, min_chars=1, keep_first=False):
    found, first = defaultdict(set), {}
    split = []
    for d, t in rows:
        ls = (t or "").split("\n")
        keys = [x.strip(BLANK).translate(LOWER) for x in ls]
        split.append((d, t, ls, keys))
        for k in keys:
            found[k].add(d)
    gone = {k for k, ds in found.items() if len(ds) >= min_docs and len(k) >= min_chars}
    out = []
    order = sorted(range(len(rows)), key=lambda i: -(1 << 63) if rows[i][0] is None else rows[i][0])
    for i in order:
        for at, k in enumerate(split[i][3]):
            first.setdefault(k, (i, at))
    for i, (d, _, ls, keys) in enumerate(split):
        keep = [x for at, (x, k) in enumerate(zip(ls, keys)) if k not in gone or (keep_first and first[k] == (i, at))]
        out.append((d, len(ls), len(ls) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=repr)


def texts(seed, n=120):
    rng = random.Random(seed)
    common = ["Menu", " menu\t", "Subscribe now", "ÉCOLE", "école", "École", "a ", "İ", "x"]
    rows = [(k, "\n".join(rng.choice([*common, f"line {rng.randrange(40)}", f"own {k}", "", "  "]) for _ in range(rng.randrange(1, 12)))) for k in range(n)]
    rows += [(n, ""), (n + 1, None), (n + 2, "\n\n"), (n + 3, "\r\nMenu\r\n"), (n + 4, "long " * 4000)]
    rows += [(n + 5, "\n".join(f"l{j}" if j % 67 else "Menu" for j in range(700)))]
    rng.shuffle(rows)
    return rows


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()), key=repr)


@pytest.mark.parametrize("least,keep_first", [(10, False), (3, False), (2, True), (1, False)])
def test_against_brute_force(docs, least, keep_first):
    rows = texts(least)
    assert got(lines.drop_repeated_lines(docs(rows), least, keep_first=keep_first)) == brute(rows, least, keep_first=keep_first)


@pytest.mark.parametrize("keep_first", [False, True])
def test_one_key_holds_most_lines(docs, keep_first, spark):
    rows = [(k, "Menu\n" * (k % 7) + f"own {k}\nmenu") for k in range(400)]
    hot = lines.crowded(lines.line_rows(docs(rows)), 4).collect()
    assert len(hot) == 1
    assert got(lines.drop_repeated_lines(docs(rows), 10, keep_first=keep_first)) == brute(rows, 10, keep_first=keep_first)


def test_repeated_rows_null_ids_and_short_keys(docs):
    twice = [(1, "a\nb\nown"), (1, "a\nb\nown"), (2, "a\nB"), (3, "c"), (None, "a\nz"), (None, "a")]
    out = sorted(map(tuple, lines.drop_repeated_lines(docs(twice), 3).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()), key=repr)
    want = [(1, 3, 1, "b\nown"), (1, 3, 1, "b\nown"), (2, 2, 1, "B"), (3, 1, 0, "c"), (None, 2, 1, "z"), (None, 1, 1, "")]
    assert out == sorted(want, key=repr)
    assert got(lines.drop_repeated_lines(docs([(k, "ab\n\nabc") for k in range(4)]), 2, min_chars=3)) == brute([(k, "ab\n\nabc") for k in range(4)], 2, 3)
    assert got(lines.drop_repeated_lines(docs([(k, "ab\n\nabc") for k in range(4)]), 2, min_chars=0)) == brute([(k, "ab\n\nabc") for k in range(4)], 2, 0)


def test_empty_table(docs):
    assert lines.drop_repeated_lines(docs([])).count() == 0


def test_bitmaps_list_only_words_that_lose_lines(docs):
    rows = [(k, "\n".join("Menu" if j in (3, 640) else f"{k} {j}" for j in range(1000))) for k in range(3)]
    keep = [r["keep"] for r in lines.keep_bitmaps(docs(rows), 3).collect()]
    assert [[(w["word"], w["bits"]) for w in k] for k in keep] == [[(0, ~(1 << 3)), (10, ~1)]] * 3
