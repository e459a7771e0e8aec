"""How the sources of a language differ in their words, by chunk factorization.

1. Whitespace chunks are counted per document; a task sums them by language, source and chunk before
   anything is shuffled, together with the documents a chunk stands in.
2. Chunks meet by content: each globally distinct chunk is split into terms once, and its counts and
   documents go over to its terms.
3. Terms meet by language; those in ``min_docs`` documents or more are kept, with a count per source.
4. Smoothed shares of the kept terms in billionths give a distance of two sources and the terms that a
   source has more of than its language. Integers throughout.

A term is a run of letters A-Z, a-z or of characters beyond ASCII; only A-Z are lower-cased. White space never is
part of a term, so chunks lose none. Documents are listed per term only up to ``min_docs`` of them, which is all that
decides whether a term is kept.

Defined cases: null text, lang and source are ''; rows that share a doc_id are one document, rows without a
doc_id together are one as well, and each row adds its occurrences; a group without terms still has its pairs; a language
without kept terms has pairs of value 0 and no term rows; equal values rank by item in UTF-8 order; extra columns are left
out; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemill.llm.common import partitions, ranges, store
from tastemill.operators.ordering import top_k_per_group

MIN_DOCS = 10
TOP_TERMS = 10
#: Bytes of text that a task factors at once, and rows that it sums at once.
HELD_BYTES = 8 << 20
HELD_ROWS = 50_000
#: Cells (source, term) of a block of the pair sums, and sources compared with all others by one task.
CELLS = 1 << 21
SOURCES = 256
#: Tables with a row per language or source are sent to all tasks up to this many counted rows.
SMALL_ROWS = 200_000
UNIT = 1_000_000_000
_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: A name within a language (hash l), and packed 64-bit numbers: how many groups, their hashes (of language and
#: source), the occurrences in each of them, and documents.
_SUMS = "l long, name binary, sums binary"
_NO_ID = -(1 << 63)


def _firsts(sorted_values: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    return np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1])[: len(sorted_values)])


def _place(owner: np.ndarray) -> np.ndarray:
    """Position of each entry among those of its owner; they are sorted by owner."""
    first = _firsts(owner)
    return np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))


def _packed(row_g: np.ndarray, g: np.ndarray, n: np.ndarray, row_doc: np.ndarray, docs: np.ndarray, rows: int) -> pa.Array:
    """One binary of packed numbers per row, from entries sorted by row."""
    groups, held = np.bincount(row_g, minlength=rows), np.bincount(row_doc, minlength=rows)
    ends = np.cumsum(1 + 2 * groups + held)
    start = ends - (1 + 2 * groups + held)
    flat = np.empty(ends[-1] if rows else 0, "<i8")
    flat[start] = groups
    at = start[row_g] + 1 + _place(row_g)
    flat[at] = g
    flat[at + groups[row_g]] = n
    flat[(start + 1 + 2 * groups)[row_doc] + _place(row_doc)] = docs
    offsets = np.append(0, ends * 8).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _unpacked(sums: pa.Array) -> tuple[np.ndarray, ...]:
    """Row, group and occurrences of every entry, and row and document of every document."""
    offsets = np.frombuffer(sums.buffers()[1], np.int32)[sums.offset : sums.offset + len(sums) + 1].astype(np.int64)
    flat = np.frombuffer(sums.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view("<i8") if len(sums) else np.zeros(0, "<i8")
    start, end = (offsets[:-1] - offsets[0]) // 8, (offsets[1:] - offsets[0]) // 8
    groups = flat[start]
    at, row_g = ranges(start + 1, start + 1 + groups)
    held, row_doc = ranges(start + 1 + 2 * groups, end)
    return row_g, flat[at], flat[at + groups[row_g]], row_doc, flat[held]


def _summed(
    names: pa.Array, langs: np.ndarray, entries: tuple[np.ndarray, ...], docs: tuple[np.ndarray, ...], least: int
) -> pa.RecordBatch:
    """Rows of ``_SUMS``, one per (name, lang), in the order of names and language hashes.

    ``entries`` are (name and language as one index, g, n), ``docs`` (the same index, document); both have the same
    names and languages. Of more than ``least`` documents the first ones are kept.
    """
    at, g, n = entries
    kinds, g = np.unique(g, return_inverse=True)
    key = at * max(1, len(kinds)) + g
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = _firsts(key)
    total = np.add.reduceat(n[order], first) if len(first) else n[:0]
    del order, at, n
    owner, g = np.divmod(key[first], max(1, len(kinds)))
    del key
    rows = owner[_firsts(owner)]

    at, doc = docs
    ids, doc = np.unique(doc, return_inverse=True)
    seen = at * max(1, len(ids)) + doc
    seen.sort()
    holder, doc = np.divmod(seen[_firsts(seen)], max(1, len(ids)))
    del seen
    few = _place(holder) < least
    holder, doc = holder[few], doc[few]
    columns = [
        pa.array(langs[rows % max(1, len(langs))] if len(rows) else rows, pa.int64()),
        names.take(pa.array(rows // max(1, len(langs)))).cast(pa.binary()),
        _packed(np.searchsorted(rows, owner), kinds[g], total, np.searchsorted(rows, holder), ids[doc], len(rows)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["l", "name", "sums"])


def _slices(batch: pa.RecordBatch, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    for k in range(0, batch.num_rows, size):
        yield batch.slice(k, size)


def chunk_sums(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """What a task found of each whitespace chunk, as rows of ``_SUMS``."""
    empty = F.lit("")
    lang, source = F.coalesce("lang", empty), F.coalesce("source", empty)
    rows = docs.select(
        F.xxhash64(lang).alias("l"), F.xxhash64(lang, source).alias("g"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"), F.coalesce("text", empty).alias("text"),
    )

    def factor(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        langs, lang = np.unique(table["l"].to_numpy(), return_inverse=True)
        groups, group = np.unique(table["g"].to_numpy(), return_inverse=True)
        doc = table["doc"].to_numpy()
        # ASCII white space alone separates chunks.
        chunks = pc.ascii_split_whitespace(table["text"].combine_chunks())
        words, row = chunks.flatten(), pc.list_parent_indices(chunks).to_numpy().astype(np.int64)
        del chunks
        filled = pc.not_equal(words, "")
        row, words = row[filled.to_numpy(zero_copy_only=False)], pc.filter(words, filled)
        coded = words.dictionary_encode()
        del words, filled
        # Counts per document first: a word of a document is one entry from here on.
        pair = coded.indices.to_numpy().astype(np.int64) * table.num_rows + row
        names = coded.dictionary
        del coded, row
        pair.sort()
        first = _firsts(pair)
        times = np.diff(np.append(first, len(pair)))
        word, row = np.divmod(pair[first], table.num_rows)
        del pair, first
        at = word * len(langs) + lang[row]
        del word
        return _summed(names, langs, (at, groups[group[row]], times), (at, doc[row]), min_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            # A batch may be large: it is taken in bounded steps, a longer single text being a step of its own.
            ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64))
            first = 0
            while first < batch.num_rows:
                base = ends[first - 1] if first else 0
                stop = max(first + 1, int(np.searchsorted(ends, base + HELD_BYTES - size, side="right")))
                held.append(batch.slice(first, stop - first))
                size += int(ends[stop - 1] - base)
                first = stop
                if size >= HELD_BYTES or first < batch.num_rows:
                    yield from _slices(factor(held))
                    held, size = [], 0
        if held:
            yield from _slices(factor(held))

    return rows.mapInArrow(run, _SUMS)


def _merged(sums: DataFrame, by: list[str], min_docs: int, names_of: Callable[[bytes], dict[bytes, int]], whole: bool) -> DataFrame:
    """Rows of ``_SUMS`` that meet by ``by``, sorted by name, with names replaced by ``names_of(name)`` (name: times).

    Rows are summed as far as they are held at once. With ``whole`` a name and language gives one row, of which l, name, g
    and n are returned if it has ``min_docs`` documents.
    """

    def resolve(held: list[pa.RecordBatch], known: dict) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        coded = table["name"].combine_chunks().dictionary_encode()
        chunk = coded.indices.to_numpy()
        # Each distinct name is resolved once; equal names are adjacent, so one is remembered from step to step.
        terms, owner, times = [], [], []
        for k, name in enumerate(coded.dictionary.to_pylist()):
            found = known.get(name)
            found = names_of(name) if found is None else found
            known.clear()
            known[name] = found
            for term, n in found.items():
                terms.append(term)
                owner.append(k)
                times.append(n)
        named = pa.array(terms, pa.binary()).dictionary_encode()
        langs, lang = np.unique(table["l"].to_numpy(), return_inverse=True)
        at, times = named.indices.to_numpy().astype(np.int64) * len(langs), np.array(times, np.int64)
        span = np.searchsorted(np.array(owner, np.int64), np.arange(len(coded.dictionary) + 1))
        row_g, g, n, row_doc, doc = _unpacked(table["sums"].combine_chunks())
        # Every entry once for each term of its row.
        pick, which = ranges(span[chunk[row_g]], span[chunk[row_g] + 1])
        entries = (at[pick] + lang[row_g[which]], g[which], n[which] * times[pick])
        pick, which = ranges(span[chunk[row_doc]], span[chunk[row_doc] + 1])
        return _summed(named.dictionary, langs, entries, (at[pick] + lang[row_doc[which]], doc[which]), min_docs)

    def finished(out: pa.RecordBatch) -> pa.RecordBatch:
        if not whole:
            return out
        row_g, g, n, row_doc, _ = _unpacked(out.column("sums"))
        keep = np.flatnonzero(np.bincount(row_doc, minlength=out.num_rows) >= min_docs)
        mine = np.isin(row_g, keep)
        offsets = pa.array(np.searchsorted(row_g[mine], np.append(keep, out.num_rows)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[mine], pa.int64())) for x in (g, n)]
        kept = out.take(pa.array(keep))
        return pa.RecordBatch.from_arrays([kept.column("l"), kept.column("name"), *lists], ["l", "name", "g", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, known = [], 0, {}
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= HELD_ROWS:
                out = resolve(held, known)
                # The last name may go on in the next rows: its sum is carried over.
                last = out.num_rows - 1 if whole else out.num_rows
                yield from _slices(finished(out.slice(0, last)))
                held, size = ([out.slice(last)], 1) if whole and out.num_rows else ([], 0)
        if held:
            yield from _slices(finished(resolve(held, known)))

    met = sums.repartition(partitions(sums.sparkSession), *by).sortWithinPartitions("name", "l")
    return met.mapInArrow(run, "l long, name binary, g array<long>, n array<long>" if whole else _SUMS)


def terms_of(chunk: bytes) -> dict[bytes, int]:
    return Counter(_TERM.findall(chunk.lower()))


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """l, term, g, n (occurrences in each group) of terms in ``min_docs`` documents of the language."""
    terms = _merged(chunk_sums(docs, min_docs), ["name"], min_docs, terms_of, False)
    whole = _merged(terms, ["l", "name"], min_docs, lambda name: {name: 1}, True)
    return whole.select("l", F.col("name").cast("string").alias("term"), "g", "n")


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it is counted to be small; otherwise Spark shuffles both sides."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def share(count: Column, total: Column, n_terms: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (total + 2 * n_terms)), exact beyond 64 bits."""
    wide = ((count + 2).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")).cast("decimal(30,0)")
    return 1 + F.call_function("div", wide, (total + 2 * n_terms).cast("decimal(30,0)"))


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """As ``share`` on arrays, by long division in steps of a thousand; totals up to 9e15."""
    rest = counts + 2
    out, rest = rest // total, rest % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def pair_sums(kept: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """l, i, j, value: distance of the i-th and j-th source of a language, summed over its kept terms.

    ``groups`` is (l, g, total, i), ``langs`` (l, v, sources). Blocks of terms meet slices of the sources; a block is a
    matrix of bounded size, and only its sums leave a task.
    """
    blocks = F.ceil(F.col("v") * F.col("sources") / CELLS)
    sized = langs.where("v > 0").select("l", "v", blocks.alias("blocks"), F.expr(f"cast((sources - 1) div {SOURCES} as int)").alias("last"))
    placed = kept.join(_small(sized.select("l", "blocks")), "l").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
    blocked = placed.groupBy("l", "block").agg(F.collect_list(F.struct("g", "n")).alias("rows"))
    listed = groups.groupBy("l").agg(F.array_sort(F.collect_list(F.struct("i", "g", "total"))).alias("of")).join(sized, "l")
    listed = listed.select("l", "of", "v", F.explode(F.sequence(F.lit(0), "last")).alias("slice"))
    listed = F.broadcast(listed) if groups.count() <= SMALL_ROWS else listed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                lang, v, part = (batch.column(c)[k].as_py() for c in ("l", "v", "slice"))
                of, rows = batch.column("of")[k].values, batch.column("rows")[k].values
                names, totals = of.field("g").to_numpy(), of.field("total").to_numpy()
                order = np.argsort(names)
                g, n = (rows.field(c).flatten().to_numpy() for c in ("g", "n"))
                term = np.repeat(np.arange(len(rows)), rows.field("g").value_lengths().to_numpy())
                table = np.zeros((len(names), len(rows)), np.int64)
                table[order[np.searchsorted(names[order], g)], term] = n
                p = shares(table, (totals + 2 * v)[:, None])
                for i in range(part * SOURCES, min(len(names), (part + 1) * SOURCES)):
                    d = p - p[i]
                    value = (d * d // (p + p[i])).sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(names), lang), pa.int64()), pa.array(np.full(len(names), i), pa.int32()),
                            pa.array(np.arange(len(names)), pa.int32()), pa.array(value),
                        ],
                        ["l", "i", "j", "value"],
                    )

    found = blocked.join(listed, "l").select("l", "v", "slice", "of", "rows").mapInArrow(run, "l long, i int, j int, value long")
    return found.groupBy("l", "i", "j").agg(F.sum("value").alias("value"))


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: distances to the other sources, and the terms a source has more of."""
    kept = store(kept_terms(docs, min_docs), "kept-terms")
    counted = kept.select("l", "term", F.explode(F.arrays_zip("g", "n")).alias("x")).select("l", "term", "x.g", "x.n")
    empty = F.lit("")
    occurring = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source")).distinct()
    occurring = occurring.withColumn("l", F.xxhash64("lang")).withColumn("g", F.xxhash64("lang", "source"))
    groups = occurring.join(counted.groupBy("g").agg(F.sum("n").alias("total")), "g", "left").fillna(0, ["total"])
    # The position of a source among those of its language; they are as many rows of the result anyway.
    groups = store(groups.withColumn("i", F.row_number().over(Window.partitionBy("l").orderBy("source")) - 1), "groups")
    sizes = kept.groupBy("l").agg(F.count("*").alias("v"))
    langs = groups.groupBy("l").agg(F.count("*").alias("sources"), F.sum("total").alias("all_total")).join(sizes, "l", "left")
    langs = store(langs.fillna(0, ["v"]), "languages")

    sums = pair_sums(kept, groups.select("l", "g", "total", "i"), langs)
    one, other = groups.select("l", "lang", "source", "i"), groups.select("l", F.col("source").alias("item"), F.col("i").alias("j"))
    pairs = one.join(other, "l").where(F.col("i") != F.col("j")).join(sums, ["l", "i", "j"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    order = [F.desc("value"), F.asc("item")]
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))

    of_lang = F.aggregate("n", F.lit(0).cast("long"), lambda s, x: s + x).alias("all_n")
    found = kept.select("l", "term", of_lang, F.explode(F.arrays_zip("g", "n")).alias("x")).select("l", "term", "all_n", "x.g", "x.n")
    found = found.join(_small(langs.select("l", "v", "all_total")), "l")
    found = found.join(_small(groups.select("g", "lang", "source", "total")), "g")
    found = found.withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))
    found = found.withColumn("q", share(F.col("all_n"), F.col("all_total"), F.col("v"))).where("n > 0 AND p > q")
    found = found.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value")
    )
    top = top_k_per_group(found, ["lang", "source"], order, top_terms)
    return pairs.unionByName(top)
