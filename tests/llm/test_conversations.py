"""Conversation repair against trying all edits, and whole tables against one conversation at a time."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tastemill.llm import conversations as C
from tastemill.llm import roles as R

LAWFUL = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, conv int, at string, pid int, audit int, copy int"


def exhaustive(rows):
    """(cost, audit) over every choice of edits, with up to two roles inserted before each row and at the end."""
    adds = ["", "u", "a", "ua", "au"]
    best = (10**9, "")
    for picks in itertools.product(*([[(i, op) for i in adds for op in "KuaD"]] * len(rows)), adds):
        cost, audit, made = 0, "", ""
        for (added, op), (initial, fault) in zip(picks, rows):
            cost, audit, made = cost + 3 * len(added), audit + "I" * len(added), made + added
            if op == "D":
                cost, audit = cost + 4, audit + "D"
                continue
            if fault in ("b", "d"):
                cost = 10**9
            cost += 3 * (fault == "t") + (0 if op == "K" else 3)
            audit += "K" if op == "K" else "R"
            made += (initial or "?") if op == "K" else op
        cost, audit, made = cost + 3 * len(picks[-1]), audit + "I" * len(picks[-1]), made + picks[-1]
        if LAWFUL.fullmatch(made):
            best = min(best, (cost, audit))
    return best


def search(rows):
    """The same by cheapest-first search over (rows done, last role)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, k, last = heapq.heappop(heap)
        if k == len(rows) and last in ("", "a"):
            return cost, audit
        if (k, last) in done:
            continue
        done.add((k, last))
        can = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        for r in can.replace("s", ""):
            heapq.heappush(heap, (cost + 3, audit + "I", k, r))
        if k < len(rows):
            initial, fault = rows[k]
            heapq.heappush(heap, (cost + 4, audit + "D", k + 1, last))
            if fault not in ("b", "d"):
                more = 3 * (fault == "t")
                if initial and initial in can:
                    heapq.heappush(heap, (cost + more, audit + "K", k + 1, initial))
                for r in can.replace("s", ""):
                    heapq.heappush(heap, (cost + more + 3, audit + "R", k + 1, r))


def draw(rng, n):
    return [(rng.choice("ssuuuaaax "), rng.choice(["", "", "", "t", "b", "d"])) for _ in range(n)]


def test_repair_against_all_edits():
    rng = random.Random(5)
    for n in (0, 1, 2, 3):
        for _ in range(60 if n < 3 else 40):
            rows = draw(rng, n)
            assert R.finish(R.paths(rows)) == exhaustive(rows), rows


def test_repair_of_long_sequences_and_of_pieces():
    rng = random.Random(6)
    for n in (4, 9, 30, 120):
        for _ in range(60):
            rows = draw(rng, n)
            whole = R.finish(R.paths(rows))
            assert whole[0] == search(rows)[0]
            front, at = {R.START: (0, "")}, 0
            while at < n:
                step = rng.randrange(1, 8)
                part = rows[at : at + step]
                at += step
                ways = {s: R.paths(part, s) for s in front}
                front = R.merge([(t, c + d, a + b) for s, (c, a) in front.items() for t, (d, b) in ways[s].items()])
            assert R.finish(front) == whole


def test_short_sequences_take_the_least_audit():
    rng = random.Random(8)
    for _ in range(25):
        rows = draw(rng, 4)
        best = R.finish(R.paths(rows))
        assert best[0] == search(rows)[0]
    assert R.finish(R.paths([("u", ""), ("u", ""), ("a", "")])) == (3, "KIKK")
    assert R.finish(R.paths([("a", "")])) == (3, "IK")
    assert R.finish(R.paths([("s", "b")])) == (4, "D")
    assert R.finish(R.paths([])) == (0, "")
    assert R.finish(R.paths([("s", "")])) == (4, "D")


def whole_table(rows):
    """Contract by hand: damage, then every conversation by itself."""
    convs = defaultdict(list)
    for c, t, role, text in rows:
        text, role = " " if text is None else text, " " if role is None else role
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        convs[c]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[c] += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for c, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in held:
            body = text.strip(" \t\n\x0b\x0c\r")
            faults.append("b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t")
            seen.add((role, text))
        turns = {t for t, _, _ in held if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[:1] for _, r, _ in held]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = R.finish(R.paths(list(zip(initials, faults))))
        made, k, last = [], 0, ""
        for e in audit:
            nxt = "assistant" if last == "u" else "user"
            _, role, text = held[k] if e != "I" else (None, None, None)
            k += e != "I"
            if e != "D":
                made.append(f"{role}:{text}" if e == "K" else f"{nxt}:{text}" if e == "R" else f"{nxt}:")
                last = made[-1][0]
        assert LAWFUL.fullmatch("".join(m[0] for m in made))
        digest = hashlib.sha256("\n".join(made).encode()).hexdigest()
        out.append((c, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def table(spark):
    def build(rows, parts=5):
        return spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], SCHEMA).repartition(parts)

    return build


def talk(rng, c, n):
    texts = ["Yes.", "No", "Why?", "", " \n", "été", "Ok!\n", "same.", " same.", "x" * 50 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    out = []
    for k in range(n):
        role = roles[0] if k == 0 and rng.random() < 0.3 else rng.choice(roles[1:5] if rng.random() < 0.9 else roles)
        out.append((c, rng.choice([k, k, k, k + 1, None]), role, rng.choice([*texts, f"text {rng.randrange(99)}.", None])))
    return out


def test_tables_by_hand(table):
    rng = random.Random(9)
    rows = [r for c in range(150) for r in talk(rng, c, rng.randrange(1, 9))]
    rows += talk(rng, None, 30) + rows[:7] + [(1000, 5, "user", "long " * 100_000 + ".")] + [(c, None, None, None) for c in range(2000, 2030)]
    assert got(C.repair_conversations(table(rows))) == whole_table(rows)


@pytest.mark.parametrize("share", [900, 4000])
def test_one_conversation_over_many_partitions(table, spark, share, monkeypatch):
    rng = random.Random(share)
    rows = talk(rng, 77, share) + [r for c in range(40) for r in talk(rng, c * 5, 4)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = table(rows)
        spread = C.judge(C.damage(df)).where("at IS NOT NULL AND conv = 77").select("pid").distinct().count()
        assert spread > 1
        assert got(C.repair_conversations(df)) == whole_table(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_table_and_conversations_without_rows(table):
    assert C.repair_conversations(table([])).count() == 0
    c = next(k for k in range(500) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    none = hashlib.sha256(b"").hexdigest()
    assert got(C.repair_conversations(table([(c, 0, "user", "gone.")]))) == [(c, 0, 0, 0, 0, 0, 0, "", none)]
