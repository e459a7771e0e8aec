"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of word n-gram names. Sets are ordered by one global order: names that are not crowded by
their hash, then the crowded ones by count. Counts are estimates of a sketch over all names of all documents; any order
keeps the join exact. Two sets with Jaccard at least t
share l names among the first |x| - ceil(t|x|) + l of each, for any l. Each document picks the l of
least estimated cost: a longer prefix means more postings, but a candidate must then share l of
them. A pair is a candidate when it shares at least the smaller l of the two.

Equal sets are one class and meet by signature, without pairs. Links are found in two passes.
Stars: each class against the members with the fewest rare names of the groups it is in, as far as it shares most names
with them. Then, over components of the verified stars, the pairs of different
components only, with size and position filters. So large groups of near copies cost a pass, not their square. Groups of
frequent names are cut into blocks by salt; each pair of blocks is a group of its own.

Defined cases: a text without words (or null) has the empty set and links with nothing; fewer words
than n give one name, the whole sequence; repeated rows are one class; a null doc_id keeps its row
but is nobody's component id unless all ids of the class are null; extra columns are left out; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemill.llm import graph
from tastemill.llm.common import SpanHash, as_bytes, chunks, mix, partitions, split_words, store, tidy, word_names
from tastemill.llm.repeats import SPREAD, bucketed, unpack, with_row
from tastemill.operators.ordering import top_k_per_group

#: Cells of the sketch of name counts, whatever the number of names.
CELLS = 1 << 20
#: Steps of a count's code for each doubling.
STEPS = 8
#: Members of one block of a name's group.
BLOCK = 20_000
#: Rounds of stars before pairs; a second one found almost nothing in trials.
STARS = 1
#: Hubs that a class is compared with in a round: those it shares most names with.
HUBS = 4
_LENGTHS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64])
_POSTING = ("<u8", "<i8", "<i4", "<i4", "<i4")


@dataclass(frozen=True)
class Rule:
    """n words a name; link when ``den * intersection >= num * union``."""

    n: int = 4
    num: int = 85
    den: int = 100

    def least(self, size: np.ndarray) -> np.ndarray:
        """Smallest intersection of a linked pair whose larger or equal partner has ``size`` names."""
        return -(-self.num * size // self.den)

    def overlap(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return -(-self.num * (a + b) // (self.num + self.den))


def name_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram names of each text."""
    data, offsets = as_bytes(column)
    starts, _, first = split_words(data, offsets)
    spans = SpanHash(word_names(data, starts, lower=True))
    words = np.diff(first)
    size = np.where(words >= n, words - n + 1, np.minimum(words, 1))
    width = np.where(words >= n, n, words)
    ends = np.cumsum(size)
    lo = np.arange(size.sum()) - np.repeat(ends - size, size) + np.repeat(first[:-1], size)
    names = spans(lo, lo + np.repeat(width, size))
    out = []
    for a, b in zip((ends - size).tolist(), ends.tolist()):
        one = np.sort(names[a:b])
        out.append(one[np.append(True, one[1:] != one[:-1])] if b - a > 1 else one)
    return out


def signature(names: np.ndarray) -> int:
    """64-bit name of a set; empty sets have none (0)."""
    if not len(names):
        return 0
    one = np.add.reduce(mix(names), keepdims=True)
    two = np.add.reduce(mix(names ^ np.uint64(0xA5A5A5A5DEADBEEF)), keepdims=True)
    total = mix((one ^ (two * np.uint64(0x9E3779B97F4A7C15))) + np.uint64(len(names)))
    return int(total.view(np.int64)[0]) or 1


class _Counts:
    """How many documents have a name of each cell; a name's cell is given by its leading bits."""

    def __init__(self, cells: int) -> None:
        self.cells, self.total = np.zeros(cells, np.uint32), 0

    def add(self, names: np.ndarray) -> None:
        self.total += len(names)
        at, n = np.unique(cell_of(names, len(self.cells)), return_counts=True)
        self.cells[at] += n.astype(np.uint32)

    def blobs(self, parts: int) -> Iterator[tuple[int, bytes]]:
        """Ranges of cells, one byte each, compressed; 255 stands for a number that follows at the end."""
        for k, part in enumerate(np.array_split(self.cells, parts)):
            large = part[part >= 255]
            yield k, zlib.compress(np.minimum(part, 255).astype(np.uint8).tobytes() + large.astype("<u4").tobytes(), 1)


def cell_of(names: np.ndarray, cells: int) -> np.ndarray:
    return (names >> np.uint64(64 - (cells.bit_length() - 1))).astype(np.int64)


def describe(docs: DataFrame, rule: Rule, cells: int = CELLS) -> DataFrame:
    """One row per document (kind 0: doc_id, n_names, sig, row) and per task its counts (kind 1: range of cells, blob)."""
    parts = partitions(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Counts(cells)
        fields = ["kind", "doc_id", "n_names", "sig", "row", "blob"]
        for table in chunks(batches):
            sets = name_sets(table["text"], rule.n)
            size = np.array([len(s) for s in sets], np.int64)
            seen.add(np.concatenate([np.zeros(0, np.uint64), *sets]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(len(sets), np.int32)), table["doc_id"].combine_chunks(), pa.array(size),
                    pa.array([signature(s) for s in sets], pa.int64()), table["_row"].combine_chunks(),
                    pa.nulls(len(sets), pa.binary()),
                ],
                fields,
            )
        if not seen.total:
            return
        for k, blob in seen.blobs(parts):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([1], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([k], pa.int64()),
                    pa.nulls(1, pa.int64()), pa.array([blob], pa.binary()),
                ],
                fields,
            )

    return store(docs.mapInArrow(tidy(run), "kind int, doc_id long, n_names long, sig long, row long, blob binary"), "name-sets")


def name_counts(described: DataFrame, cells: int = CELLS) -> np.ndarray:
    """How crowded each cell is, from the sum of all tasks' counts: one byte per cell, an array of fixed size.

    0 stands for what the names that share a cell by chance explain; c for 2 ** (c / STEPS) documents beyond that.
    """
    parts = partitions(described.sparkSession)
    sizes = [len(x) for x in np.array_split(np.zeros(cells, np.uint8), parts)]
    chance = (described.where("kind = 0").agg(F.sum("n_names")).first()[0] or 0) / cells
    least = chance + 4 * math.sqrt(chance) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, blob in zip(batch.column("sig").to_pylist(), batch.column("blob")):
                raw = np.frombuffer(zlib.decompress(blob.as_buffer()), np.uint8)
                part = raw[: sizes[k]].astype(np.uint32)
                part[part == 255] = raw[sizes[k] :].view("<u4") if raw.nbytes > sizes[k] else 0
                sums[k] = sums[k] + part if k in sums else part
        for k, part in sums.items():
            code = np.clip(np.round(STEPS * np.log2(np.maximum(part - chance, 1.0))), 1, 255)
            code = np.where(part > least, code, 0).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([code.tobytes()], pa.binary())], ["sig", "blob"])

    blobs = described.where("kind = 1").select("sig", "blob").repartition(parts, "sig")
    out = np.zeros(cells, np.uint8)
    starts = np.cumsum([0, *sizes])
    for r in blobs.mapInArrow(tidy(run), "sig long, blob binary").collect():
        out[starts[r["sig"]] : starts[r["sig"] + 1]] = np.frombuffer(r["blob"], np.uint8)
    return out


def prefix(names: np.ndarray, counts: np.ndarray, rule: Rule) -> tuple[np.ndarray, int]:
    """The document's prefix in the global order, and the number l of names it must share."""
    size = len(names)
    base = size - int(rule.least(np.array(size))) + 1
    n = counts[cell_of(names, len(counts))]
    # Crowded names come last, the fewer the sooner; the others stand by name.
    order = np.argsort(n, kind="stable")
    ordered, cost = names[order], np.where(n[order] > 0, np.exp2(n[order] / STEPS), 0.05)
    lengths = _LENGTHS[base + _LENGTHS - 1 <= size]
    if len(lengths) == 0:
        return ordered[:base], 1
    sums = np.cumsum(cost)[base + lengths - 2]
    # Postings to read, and candidates (at most their number / l) to verify at about |x| steps each,
    # plus the postings to write.
    best = int(np.argmin(sums + size * sums / lengths + 8 * (base + lengths)))
    return ordered[: base + int(lengths[best]) - 1], int(lengths[best])


def postings(docs: DataFrame, counts: np.ndarray, rule: Rule) -> DataFrame:
    """Groups of names that at least two classes have in their prefixes: name, sig, size, at (place in
    the prefix), before (shared names among the places before it), need, many (size of the group) and
    lead (the member with the earliest place)."""
    spark = docs.sparkSession
    n = partitions(spark)
    shared = spark.sparkContext.broadcast(counts)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for table in chunks(batches):
            done: set[int] = set()
            names, sigs, sizes, ats, needs = [], [], [], [], []
            for one in name_sets(table["text"], rule.n):
                sig = signature(one)
                if not len(one) or sig in done:
                    continue
                done.add(sig)
                head, need = prefix(one, counts, rule)
                k = len(head)
                names.append(head)
                sigs.append(np.full(k, sig, np.int64))
                sizes.append(np.full(k, len(one), np.int32))
                ats.append(np.arange(k, dtype=np.int32))
                needs.append(np.full(k, need, np.int32))
            if not names:
                continue
            name = np.concatenate(names)
            out = list(
                bucketed((name % np.uint64(n * SPREAD)).astype(np.int64), name, np.concatenate(sigs), np.concatenate(sizes), np.concatenate(ats), np.concatenate(needs))
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["bucket", "blob"]
            )

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [x for b in batches for x in b.column("blob").to_pylist()]
        name, sig, size, at, need = unpack(blobs, _POSTING)
        del blobs
        order = np.lexsort((sig, name)) if len(name) else np.zeros(0, np.int64)
        name, sig, size, at, need = (x[order] for x in (name, sig, size, at, need))
        fresh = np.append(True, (name[1:] != name[:-1]) | (sig[1:] != sig[:-1]))[: len(name)]
        name, sig, size, at, need = (x[fresh] for x in (name, sig, size, at, need))
        new = np.append(True, name[1:] != name[:-1])[: len(name)]
        many = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] if len(name) else np.zeros(0, int)
        lead = sig
        if len(name):
            by = np.lexsort((sig, at, name))
            lead = sig[by][np.flatnonzero(new)][np.cumsum(new) - 1]
        some = many > 1
        for k in range(0, int(some.sum()), 50_000):
            pick = np.flatnonzero(some)[k : k + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(name[pick].view(np.int64)), pa.array(sig[pick]), pa.array(size[pick]), pa.array(at[pick]),
                    pa.array(need[pick]), pa.array(many[pick].astype(np.int64)), pa.array(lead[pick]),
                ],
                ["name", "sig", "size", "at", "need", "many", "lead"],
            )

    met = docs.select("text").mapInArrow(tidy(emit), "bucket int, blob binary").repartition(n, "bucket")
    found = met.mapInArrow(tidy(group), "name long, sig long, size int, at int, need int, many long, lead long")
    # At most one row per name of a prefix.
    places = Window.partitionBy("sig").orderBy("at")
    found = found.withColumn("before", F.row_number().over(places) - 1)
    return store(found.withColumn("named", F.count("*").over(Window.partitionBy("sig"))), "postings")


_PAIRS = "a long, b long, need int, n long, at_a int, at_b int, size_a int, size_b int"
_PAIR_TYPES = {"a": pa.int64(), "b": pa.int64(), "need": pa.int32(), "n": pa.int64()} | {
    c: pa.int32() for c in ("at_a", "at_b", "size_a", "size_b")
}
#: Pairs that a task counts up before it passes them on.
HELD_PAIRS = 500_000


def _counted(g: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, more: tuple[str, ...] = ()) -> dict[str, np.ndarray]:
    """Pairs of rows as pairs of classes: shared names, the last place of one in each prefix, sizes; also ``more``
    columns of the last rows."""
    out = {"a": g["sig"][i], "b": g["sig"][j], "need": np.minimum(g["need"][i], g["need"][j]), "n": np.ones(len(i), np.int64)}
    for c in ("at", "size", *more):
        out[f"{c}_a"], out[f"{c}_b"] = g[c][i], g[c][j]
    return _summed_pairs(out)


def _summed_pairs(pairs: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """One row per (a, b): the sum of n, the largest value of the others (they grow with the place)."""
    order = np.lexsort((pairs["b"], pairs["a"]))
    a, b = pairs["a"][order], pairs["b"][order]
    new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)])
    if not len(new):
        return pairs
    out = {"a": a[new], "b": b[new]}
    # One sorted column at a time.
    return out | {c: (np.add if c == "n" else np.maximum).reduceat(v[order], new) for c, v in pairs.items() if c not in out}


def _joined_pairs(held: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """The rows of all of ``held``, which is emptied: a column goes as soon as it is joined."""
    out = {c: np.concatenate([h.pop(c) for h in held]) for c in list(held[0])}
    held.clear()
    return out


def _pair_batch(pairs: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[c], t) for c, t in _PAIR_TYPES.items()], list(_PAIR_TYPES))


def _sorted_groups(rows: DataFrame) -> DataFrame:
    """Whole (name, block) groups, those of one leader together: their pairs are mostly the same and
    are counted before they leave the task. Blocks of large groups are dealt one by one."""
    where = F.when(F.col("salts") > 1, F.xxhash64("name", "block")).otherwise(F.col("lead"))
    placed = rows.withColumn("part", where).repartition(partitions(rows.sparkSession), "part")
    return placed.sortWithinPartitions("part", "name", "block")


def _whole_groups(batches: Iterator[pa.RecordBatch], least: int = 100_000) -> Iterator[dict[str, np.ndarray]]:
    """Columns of consecutive whole (name, block) groups, at least ``least`` rows at a time."""
    held: list[pa.RecordBatch] = []

    def columns(t):
        return {c: t[c].to_numpy() for c in t.column_names}

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < least:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        name, block = t["name"].to_numpy(), t["block"].to_numpy()
        cut = np.flatnonzero((name != name[-1]) | (block != block[-1]))
        cut = int(cut[-1]) + 1 if len(cut) else 0
        if cut:
            yield columns(t.slice(0, cut).combine_chunks())
        held = t.slice(cut).combine_chunks().to_batches()
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        if t.num_rows:
            yield columns(t)


def _salts(block: int):
    return F.ceil(F.col("many") / block).cast("int")


def star_candidates(groups: DataFrame, labels: DataFrame | None, rule: Rule, block: int = BLOCK) -> DataFrame:
    """Each class against a few hubs (a: class, b: hub). The hub of a (salted) group is its member whose
    place of the name is earliest: it has the fewest rarer names, so it is the least changed copy. With ``labels`` it is
    the nearest earlier member of another component. Of the hubs of its groups a class takes those it shares most names with."""
    named = _labelled(groups, labels)
    salted = named.withColumn("salts", _salts(block)).withColumn("block", F.pmod(F.xxhash64("sig"), F.col("salts")).cast("int"))
    again = labels is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _whole_groups(batches):
            order = np.lexsort((g["sig"], g["at"], g["block"], g["name"]))
            g = {c: v[order] for c, v in g.items()}
            new = np.append(True, (g["name"][1:] != g["name"][:-1]) | (g["block"][1:] != g["block"][:-1]))
            hub = np.flatnonzero(new)[np.cumsum(new) - 1]
            if again:
                # The nearest earlier member of another component: the last row of the run of equal labels before one's own.
                turn = new | np.append(True, g["label"][1:] != g["label"][:-1])
                run_start = np.flatnonzero(turn)[np.cumsum(turn) - 1]
                hub = np.where(new[run_start], hub, run_start - 1)
            k = np.flatnonzero(~new & (g["label"] != g["label"][hub]))
            h = hub[k]
            fit = _filter(g, k, h, rule)
            k, h = k[fit], h[fit]
            yield _pair_batch(_counted(g, k, h))

    counted = _sorted_groups(salted).mapInArrow(tidy(run), _PAIRS)
    shared = counted.groupBy("a", "b").agg(F.sum("n").alias("n"))
    return top_k_per_group(shared, ["a"], [F.desc("n"), F.desc("b")], HUBS).select("a", "b")


def _labelled(groups: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return groups.withColumn("label", F.col("sig"))
    named = groups.join(labels.withColumnRenamed("node", "sig"), "sig", "left")
    return named.withColumn("label", F.coalesce("component", "sig")).drop("component")


def _filter(g: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, rule: Rule) -> np.ndarray:
    """Size and position filter: can the pair still reach the overlap it needs?

    Names before this one that no other prefix has are in neither partner: a name that is smaller
    than one of the partner's prefix would stand in that prefix too.
    """
    a, b = g["size"][i].astype(np.int64), g["size"][j].astype(np.int64)
    p, q = g["at"][i].astype(np.int64), g["at"][j].astype(np.int64)
    most = np.minimum(g["before"][i], g["before"][j]) + 1 + np.minimum(a - p - 1, b - q - 1)
    return most >= rule.overlap(a, b)


def _hopeful(g: dict[str, np.ndarray], rule: Rule) -> np.ndarray:
    """Rows that could reach the overlap with the smallest member of their group."""
    start = np.flatnonzero(np.append(True, (g["name"][1:] != g["name"][:-1]) | (g["block"][1:] != g["block"][:-1])))
    least = np.repeat(np.minimum.reduceat(g["size"], start), np.diff(np.append(start, len(g["name"]))))
    size = g["size"].astype(np.int64)
    return size - g["at"] + g["before"] >= rule.overlap(size, least.astype(np.int64))


def cross_candidates(groups: DataFrame, labels: DataFrame, rule: Rule, block: int = BLOCK) -> DataFrame:
    """Pairs of one group whose components differ. Groups larger than a block are dealt as pairs of
    blocks: a member goes to every pair that its block is part of."""
    named = _labelled(groups, labels)
    salt = F.pmod(F.xxhash64("sig"), F.col("salts")).cast("int")
    dealt = (
        named.withColumn("salts", _salts(block)).withColumn("own", salt)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .withColumn("block", F.least("own", "other") * F.col("salts") + F.greatest("own", "other"))
        .select("name", "block", "salts", "lead", "sig", "size", "at", "before", "named", "need", "label", "own", "other")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _whole_groups(batches):
            g |= _places_here(g)
            order = np.lexsort((g["size"], g["label"], g["block"], g["name"]))
            g = {c: v[order] for c, v in g.items()}
            fit = _hopeful(g, rule)
            g = {c: v[fit] for c, v in g.items()}
            order = order[fit]
            if not len(order):
                continue
            same = (g["name"][1:] == g["name"][:-1]) & (g["block"][1:] == g["block"][:-1])
            cuts = np.flatnonzero(np.append(True, ~same))
            ends = np.append(cuts[1:], len(order))
            mixed = g["label"][cuts] != g["label"][ends - 1]
            held: list[dict[str, np.ndarray]] = []
            size, whole = 0, True
            for a, b in zip(cuts[mixed].tolist(), ends[mixed].tolist()):
                for i, j in _cross(g, a, b, rule):
                    turn = g["sig"][i] > g["sig"][j]
                    held.append(_counted(g, np.where(turn, j, i), np.where(turn, i, j), _HERE))
                    size += len(held[-1]["a"])
                    if size > HELD_PAIRS:
                        held = [_summed_pairs(_joined_pairs(held))]
                        size = len(held[0]["a"])
                        if size > HELD_PAIRS // 2:
                            # Too many pairs to hold: their counts go on as they are and are summed by Spark.
                            yield _pair_batch(held[0])
                            held, size, whole = [], 0, False
            if held:
                pairs = _summed_pairs(_joined_pairs(held))
                if whole:
                    fit = _possible(pairs, rule)
                    pairs = {c: v[fit] for c, v in pairs.items()}
                yield _pair_batch(pairs)

    return _sorted_groups(dealt).mapInArrow(tidy(run), _PAIRS)


_HERE = ("before", "here", "away")


def _places_here(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Of each row's class: names of its prefix up to this place that are among the rows at hand (here), and names
    of the whole prefix that others share and that are not (away). Names in salted groups may be anywhere."""
    one = (g["salts"] == 1).astype(np.int64)
    order = np.lexsort((g["at"], g["sig"]))
    sig, total = g["sig"][order], np.cumsum(one[order])
    first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])[: len(sig)])
    sizes = np.diff(np.append(first, len(sig)))
    start = np.repeat((total - one[order])[first], sizes) if len(first) else total
    held = np.repeat(total[first + sizes - 1], sizes) - start if len(first) else total
    here, away = np.empty(len(sig), np.int64), np.empty(len(sig), np.int64)
    here[order] = total - start
    away[order] = g["named"][order] - held
    return {"here": here, "away": away}


def _possible(pairs: dict[str, np.ndarray], rule: Rule) -> np.ndarray:
    """Pairs that may share enough, wherever their other names are: all they share among the rows at hand is counted.

    Up to the last shared place a class has ``before + 1`` names that others share, ``here`` of them at hand: those at
    hand that the pair doesn't share are lost. Names behind that place may all be shared.
    """
    n = pairs["n"]
    fit = n + np.minimum(pairs["away_a"], pairs["away_b"]) >= pairs["need"]
    need = rule.overlap(pairs["size_a"].astype(np.int64), pairs["size_b"].astype(np.int64))
    for side in ("a", "b"):
        elsewhere = pairs[f"before_{side}"].astype(np.int64) + 1 - pairs[f"here_{side}"]
        fit &= n + elsewhere + pairs[f"size_{side}"] - pairs[f"at_{side}"] - 1 >= need
    return fit


def _cross(g: dict[str, np.ndarray], a: int, b: int, rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows a..b-1 (sorted by label) with different labels that pass the filters."""
    label = g["label"][a:b]
    stop = np.searchsorted(label, label, side="right") + a  # first row of a larger label
    size = b - stop
    step = 200_000
    sums = np.cumsum(size)
    first = 0
    while first < b - a:
        base = sums[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sums, base + step, side="right")))
        rows = np.arange(first, last)
        i = np.repeat(rows + a, size[rows])
        ends = np.cumsum(size[rows])
        j = np.arange(len(i)) - np.repeat(ends - size[rows], size[rows]) + np.repeat(stop[rows], size[rows])
        # In a pair of blocks, rows of one block meet only when the block is paired with itself.
        own, other = g["own"], g["other"]
        fit = (own[i] != own[j]) | (own[i] == other[i])
        fit &= _filter(g, i, j, rule)
        yield i[fit], j[fit]
        first = last


def candidates(counted: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b, n) that share enough names of their prefixes and may still reach the overlap they need.

    All common names up to the last shared one stand in both prefixes and are counted; later ones stand behind its
    place in both sets.
    """
    pairs = counted.groupBy("a", "b").agg(
        F.sum("n").alias("n"), F.max("need").alias("need"), F.max("at_a").alias("at_a"), F.max("at_b").alias("at_b"),
        F.max("size_a").alias("size_a"), F.max("size_b").alias("size_b"),
    )
    most = F.col("n") + F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b")) - 1
    reach = most * (rule.num + rule.den) >= (F.col("size_a") + F.col("size_b")) * rule.num
    return pairs.where(F.col("n") >= F.col("need")).where(reach).select("a", "b", "n")


def verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b: signatures) that meet the rule, by the sets of their whole texts."""
    ends = pairs.select(F.col("a").alias("sig")).unionAll(pairs.select(F.col("b").alias("sig"))).distinct()
    wanted = store(ends.join(classes, "sig").select("sig", F.col("row").alias("_row")), "ends")
    texts = graph.maybe_in(docs.select("_row", "text"), "_row", wanted, "_row")
    sets = texts.join(wanted, "_row").select("sig", "text").dropDuplicates(["sig"])
    left = pairs.join(sets.select(F.col("sig").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(sets.select(F.col("sig").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for table in chunks(batches, "text_a"):
            x = name_sets(table["text_a"], rule.n)
            b = table["b"].to_pylist()
            new = [k for k in range(len(b)) if b[k] not in held and (k == 0 or b[k] != b[k - 1])]
            if len(held) > 2_000:
                held = {}
                new = list({v: k for k, v in enumerate(b)}.values())
            held |= dict(zip((b[k] for k in new), name_sets(table["text_b"].take(pa.array(new, pa.int64())), rule.n)))
            good = []
            for k, one in enumerate(x):
                two = held[b[k]]
                common = len(one) + len(two) - len(np.unique(np.concatenate([one, two])))
                good.append(rule.den * common >= rule.num * (len(one) + len(two) - common))
            yield from table.select(["a", "b"]).filter(pa.array(good, pa.bool_())).to_batches()

    return both.select("a", "b", "text_a", "text_b").mapInArrow(tidy(run), "a long, b long")


def join_classes(docs: DataFrame, rule: Rule = Rule(), cells: int = CELLS, block: int = BLOCK) -> DataFrame:
    """doc_id, n_names, sig (class of equal sets, 0 for the empty set), component_id."""
    docs = with_row(docs)
    described = describe(docs, rule, cells)
    rows = described.where("kind = 0").select("doc_id", "n_names", "sig")
    classes = store(described.where("kind = 0").where("sig <> 0").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.min("row").alias("row")), "classes")
    groups = postings(docs, name_counts(described, cells), rule)
    found, labels = None, None
    for _ in range(STARS):
        stars = store(star_candidates(groups, labels, rule, block), "stars")
        links = store(verify(stars, docs, classes, rule), "star-links")
        found = links if found is None else found.unionAll(links)
        labels = store(graph.components(found), "star-components")
    crossed = store(candidates(cross_candidates(groups, labels, rule, block), rule).select("a", "b"), "crossed")
    more = store(verify(crossed, docs, classes, rule), "cross-links")
    nodes = graph.components(found.unionAll(more))
    joined = classes.join(nodes, classes["sig"] == nodes["node"], "left").select(
        "sig", "rep", F.coalesce("component", "sig").alias("component")
    )
    joined = store(joined, "class-components")
    least = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = joined.join(least, "component").select("sig", "component_id")
    return rows.join(named, "sig", "left").select(
        "doc_id", "n_names", "sig", F.coalesce("component_id", "doc_id").alias("component_id")
    )
