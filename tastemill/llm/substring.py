"""Substring dedup by recompression: words of long repeats are removed from later documents.

Rounds of recompression (runs, then pairs of a left and a right block) cut each text into blocks
whose names depend on content alone, so that equal passages consist of the same blocks but for
their ends. Boundaries that a window certifies are its anchors; windows around anchors that occur
twice are compared by the hash of their words.

Rule: a window is ``width`` consecutive words; a word is removed if a window that covers it also
starts in a document with a smaller doc_id. Windows are judged on the input.

Defined cases: a null or empty text has no words; a text shorter than a window keeps all; a null
doc_id counts as larger than every number; rows that share a doc_id do not remove from each
other; extra columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tastemill.llm import repeats as R
from tastemill.llm.common import SpanHash, as_bytes, chunks, partitions, ranges, split_words, word_names

WIDTH = 13
ROUNDS = 2
_LAST = (1 << 63) - 1


def _scan(width: int, rounds: int) -> R.Scan:
    def scan(table: pa.Table):
        data, offsets = as_bytes(table["text"])
        starts, _, first = split_words(data, offsets)
        spans = SpanHash(word_names(data, starts))
        parse = R.positions(first)
        for level in range(rounds):
            parse = R.recompress(parse, spans, level)
        return first, R.anchors(parse, spans, first, width), spans

    return scan


def repeated_words(docs: DataFrame, width: int = WIDTH, rounds: int = ROUNDS) -> DataFrame:
    """_row, ranges: packed [start, stop) pairs of window starts that a smaller doc_id has too."""
    spark = docs.sparkSession
    n = partitions(spark)
    found = R.repeated_anchors(docs, _scan(width, rounds), width, hot=1 << 62)
    joined = docs.repartition(n, "_row").join(R.pairs_by_row(found, "spans"), "_row", "left")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = (b.filter(b.column("spans").is_valid()) for b in batches)
        for table in chunks(some):
            data, offsets = as_bytes(table["text"])
            starts, _, first = split_words(data, offsets)
            names = word_names(data, starts)
            spans = SpanHash(names)
            at, _ = ranges(*R.windows_around(table, first, width))
            row = np.searchsorted(first, at, side="right") - 1
            rank = table["doc_id"].fill_null(_LAST).to_numpy()[row]
            out = R.window_blobs(
                spans(at, at + width), R.check_names(names, at, at + width), table["_row"].to_numpy()[row], rank,
                at - first[row], n * R.SPREAD,
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["bucket", "blob"]
            )

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, start = R.resolve_windows([x for b in batches for x in b.column("blob").to_pylist()], True)
        yield R.pair_blobs(*R.runs(row, start), n * R.SPREAD)

    met = joined.mapInArrow(emit, "bucket int, blob binary").repartition(n, "bucket")
    return R.pairs_by_row(met.mapInArrow(resolve, "bucket int, blob binary"), "ranges")


def remove_repeats(docs: DataFrame, width: int = WIDTH, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space), kept_sha256."""
    rows = R.with_row(docs)
    n = partitions(docs.sparkSession)
    joined = rows.repartition(n, "_row").join(repeated_words(rows, width, rounds), "_row", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept_texts, digests = [], [], [], []
            for text, blob in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
                words = (text or "").encode().split()
                a, b = R.covered(blob, width)
                kept, last = [], 0
                for x, y in zip(a.tolist(), b.tolist()):
                    kept += words[last:x]
                    last = y
                kept += words[last:]
                out = b" ".join(kept)
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                kept_texts.append(out.decode())
                digests.append(hashlib.sha256(out).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(kept_texts, pa.string()), pa.array(digests, pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
            )

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string")
