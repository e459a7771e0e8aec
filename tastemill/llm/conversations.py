"""Conversation structure repair: faults, and the cheapest edits to a lawful role sequence (``roles``).

Rows are range-partitioned and sorted by conversation and turn. A conversation that lies inside a partition is
judged there. The first and the last one of a partition may go on in its neighbours: their rows are kept as
pieces, one for each partition, so that a conversation with a large share of all rows is the work of many tasks. A
piece gives, for every stack it may start from, the cheapest way to every stack it may end with; the pieces of a
conversation are then chained by these small tables. Its digest alone, a running hash, needs the rows in one
task; they stream through it.

Faults (the first one counts): ``b`` blank, ``d`` role and text seen earlier in the conversation, ``t`` truncated (the
last character that is no white space is not one of ``.!?``).

Defined cases: a null role or text is one space; rows without a conv_id are one conversation; rows of
the same turn are ordered by role and text, rows without a turn come first; repeated rows are duplicates; a conversation
without rows has zeros, an empty audit and the hash of the empty string; extra columns are left out; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemill.llm import roles as R
from tastemill.llm.common import partitions, store

#: Leading characters of a text that take part in the choice of partition bounds.
BOUND_CHARS = 32
_DARK = re.compile(r"[^\x20\x09-\x0D]")
_KEY = ["no_conv", "conv"]
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]
_LAWFUL = {"su", "ua", "au"}
_STACKS = [
    (0, None), (1, (0, None)), (2, (0, None)), (3, (0, None)), (3, (2, (0, None))),
    (4, (1, (0, None))), (5, (2, (0, None))), (4, (5, (2, (0, None)))),
]


def _keyed(rows: DataFrame) -> list[Column]:
    key = F.col("conv_id").cast("long")
    return [key.isNull().alias("no_conv"), F.coalesce(key, F.lit(0)).alias("conv")]


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copy: rows with the damage that crc32(conv_id:turn) % 20 asks for.

    0 drops a row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes it the user's; a null counts as one space.
    """
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    name = F.concat(conv, F.lit(":"), turn)
    kind = F.crc32(name.cast("binary")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), kind.alias("kind"),
    ).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def fault(text: str, again: bool) -> str:
    dark = _DARK.search(text)
    if dark is None:
        return "b"
    if again:
        return "d"
    return "" if text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")[-1] in ".!?" else "t"


class Piece:
    """Counts and symbols of consecutive rows; pieces add up in order."""

    def __init__(self) -> None:
        self.symbols: list[tuple[str, str]] = []
        self.faults = {"b": 0, "d": 0, "t": 0, "": 0}
        self.illegal = self.turns = 0
        self.first = self.last = None
        self.low = self.high = None

    def row(self, turn: int | None, role: str, text: str, again: bool) -> None:
        found, initial = fault(text, again), role[:1]
        self.faults[found] += 1
        self.symbols.append((initial, found))
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in _LAWFUL
        self.last = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn

    def summary(self) -> dict:
        """What a later piece and the whole need to know, without symbols."""
        return {k: getattr(self, k) for k in ("faults", "illegal", "turns", "first", "last", "low", "high")}

    def add(self, s: dict) -> None:
        """Append a later piece by its summary."""
        for k, n in s["faults"].items():
            self.faults[k] += n
        self.illegal += s["illegal"] + (self.last is not None and s["first"] is not None and self.last + s["first"] not in _LAWFUL)
        self.turns += s["turns"] - (s["low"] is not None and s["low"] == self.high)
        self.first = s["first"] if self.first is None else self.first
        self.last = s["last"] if s["last"] is not None else self.last
        self.low = s["low"] if self.low is None else self.low
        self.high = s["high"] if s["high"] is not None else self.high

    def counts(self) -> list[int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return [gaps, self.faults["b"], self.faults["d"], self.faults["t"], self.illegal]


class Digest:
    """sha256 of lines joined by newlines."""

    def __init__(self) -> None:
        self.hash, self.any = hashlib.sha256(), False

    def add(self, lines: Iterable[str]) -> None:
        for line in lines:
            self.hash.update((("\n" if self.any else "") + line).encode())
            self.any = True


def repair(rows: list[tuple[int | None, str, str]]) -> list:
    """Values of ``_RESULT`` for a whole conversation of (turn, role, text) in order."""
    piece, seen = Piece(), set()
    for turn, role, text in rows:
        piece.row(turn, role, text, (role, text) in seen)
        seen.add((role, text))
    cost, audit = R.finish(R.paths(piece.symbols))
    replay, digest = R.Replay(audit), Digest()
    for _, role, text in rows:
        digest.add(replay.row(role, text))
    digest.add(replay.rest())
    return [*piece.counts(), cost, audit, digest.hash.hexdigest()]


def _rows(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


_KEYS = [("no_conv", pa.bool_()), ("conv", pa.int64())]
_VALUES = [(c, pa.string() if c in ("audit", "repaired_sha256") else pa.int64()) for c in _NAMES]
_ROW = [("at", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]
_JUDGED = pa.schema([*_KEYS, *_VALUES, *_ROW])
_JUDGED_DDL = f"no_conv boolean, conv long, {_RESULT}, at long, turn long, role string, text string"


def judge(damaged: DataFrame) -> DataFrame:
    """Results of conversations inside a partition; rows (with ``at`` and ``pid``) of those at its ends."""
    rows = damaged.select(*_keyed(damaged), "turn", "role", "text", "copy")
    bounds = [*_KEY, "turn", "role", F.substring("text", 1, BOUND_CHARS)]
    ranged = rows.repartitionByRange(*bounds).sortWithinPartitions(*_KEY, "turn", "role", "text", "copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key, first, at, done = None, True, 0, []

        def opened() -> Iterator[pa.RecordBatch]:
            nonlocal at
            for k in range(0, len(held), 1000):
                part = held[k : k + 1000]
                yield _batch([(*key, *[None] * len(_NAMES), at + k + j, *r) for j, r in enumerate(part)], _JUDGED)
            at += len(held)

        for no_conv, conv, *row in _rows(batches, [*_KEY, "turn", "role", "text"]):
            if (no_conv, conv) != key:
                if key is not None:
                    if first:
                        yield from opened()
                    else:
                        done.append((*key, *repair(held), None, None, None, None))
                    first = False
                key, held = (no_conv, conv), []
                if len(done) >= 1000:
                    yield _batch(done, _JUDGED)
                    done = []
            held.append(tuple(row))
        yield _batch(done, _JUDGED)
        if key is not None:
            yield from opened()

    columns = ranged.select(*_KEY, "turn", "role", "text").mapInArrow(run, _JUDGED_DDL)
    return store(columns.withColumn("pid", F.spark_partition_id()), "judged")


def _grouped(batches: Iterator[pa.RecordBatch], columns: list[str], n: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows with equal first ``n`` columns; rows stream."""
    for key, rows in groupby(_rows(batches, columns), key=lambda r: r[:n]):
        yield key, (r[n:] for r in rows)


def _stack_name(stack: R.Stack) -> int:
    return _STACKS.index(stack)


def piece_tables(rows: DataFrame) -> DataFrame:
    """no_conv, conv, pid, piece: JSON of the summary and, per starting stack, the ways to the others."""
    digest = [F.xxhash64("role", "text"), F.xxhash64("text", F.lit(1), "role")]
    again = F.row_number().over(Window.partitionBy(*_KEY, *digest).orderBy("pid", "at")) > 1
    marked = rows.withColumn("again", again)
    n = partitions(rows.sparkSession)
    pieces = marked.repartition(n, *_KEY, "pid").sortWithinPartitions(*_KEY, "pid", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*_KEYS, ("pid", pa.int32()), ("piece", pa.string())])
        for key, group in _grouped(batches, [*_KEY, "pid", "turn", "role", "text", "again"], 3):
            piece = Piece()
            for row in group:
                piece.row(*row)
            ways = [[[_stack_name(s), c, a] for s, (c, a) in R.paths(piece.symbols, start).items()] for start in _STACKS]
            yield _batch([(*key, json.dumps({"summary": piece.summary(), "ways": ways}))], schema)

    chosen = pieces.select(*_KEY, "pid", "turn", "role", "text", "again")
    return chosen.mapInArrow(run, "no_conv boolean, conv long, pid int, piece string")


def chain(tables: DataFrame) -> DataFrame:
    """no_conv, conv and the values of ``_RESULT`` but the digest, from the pieces of each conversation in order."""
    n = partitions(tables.sparkSession)
    ordered = tables.repartition(n, *_KEY).sortWithinPartitions(*_KEY, "pid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*_KEYS, *_VALUES[:-1]])
        for key, group in _grouped(batches, [*_KEY, "pid", "piece"], 2):
            whole, front = Piece(), {R.START: (0, "")}
            for _, text in group:
                piece = json.loads(text)
                whole.add(piece["summary"])
                found = [
                    (_STACKS[to], cost + price, audit + edits)
                    for stack, (cost, audit) in front.items()
                    for to, price, edits in piece["ways"][_stack_name(stack)]
                ]
                front = R.merge(found)
            yield _batch([(*key, *whole.counts(), *R.finish(front))], schema)

    ddl = "no_conv boolean, conv long, " + _RESULT.rpartition(", ")[0]
    return ordered.select(*_KEY, "pid", "piece").mapInArrow(run, ddl)


def digests(rows: DataFrame, chained: DataFrame) -> DataFrame:
    """no_conv, conv, repaired_sha256: the audit heads the rows of its conversation, which stream after it."""
    head = chained.select(*_KEY, F.lit(-1).alias("pid"), F.lit(0).cast("long").alias("at"), "audit", F.lit("").alias("text"))
    body = rows.select(*_KEY, "pid", "at", F.col("role").alias("audit"), "text")
    n = partitions(rows.sparkSession)
    ordered = head.unionByName(body).repartition(n, *_KEY).sortWithinPartitions(*_KEY, "pid", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*_KEYS, ("repaired_sha256", pa.string())])
        for key, group in _grouped(batches, [*_KEY, "audit", "text"], 2):
            replay, digest = R.Replay(next(group)[0]), Digest()
            for role, text in group:
                digest.add(replay.row(role, text))
            digest.add(replay.rest())
            yield _batch([(*key, digest.hash.hexdigest())], schema)

    return ordered.select(*_KEY, "audit", "text").mapInArrow(run, "no_conv boolean, conv long, repaired_sha256 string")


def repair_conversations(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conv_id.

    ``rows`` (conv_id, turn, role, text, copy) are judged, by default the damaged ``conversations``.
    """
    judged = judge(damage(conversations) if rows is None else rows)
    inside = judged.where("at IS NULL").select(*_KEY, *_NAMES)
    ends = judged.where("at IS NOT NULL").select(*_KEY, "pid", "at", "turn", "role", "text")
    chained = store(chain(piece_tables(ends)), "chained")
    across = chained.join(digests(ends, chained), _KEY).select(*_KEY, *_NAMES)
    found = inside.unionByName(across)
    every = conversations.select(*_keyed(conversations)).distinct()
    none = hashlib.sha256(b"").hexdigest()
    out = every.join(found, _KEY, "left").fillna(0, _NAMES[:6]).fillna({"audit": "", "repaired_sha256": none})
    return out.select(F.when(~F.col("no_conv"), F.col("conv")).alias("conv_id"), *_NAMES)
