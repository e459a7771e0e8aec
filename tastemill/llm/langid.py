"""Language identification of spans: script ranges, per-word scores, Viterbi with a switch penalty.

A word's score for a language is the log probability of its byte trigrams (hashed, padded with a
space) and of the whole word, learned from labelled documents. The script of a word leaves only
the languages that were seen in that script. Viterbi over the words of a text, where a change of
language costs a penalty, labels runs of words; the label of a text is the language with most
letters in its runs.

Defined cases: null text or text without a letter: `und`, score 0, no spans; ties go to the
language that comes first in name order; repeated rows get equal results; extra columns are left
out; an empty table gives an empty result; with nothing to learn from, every text is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemill.llm.common import LOWER, SPACE, as_bytes, chunks, mix, split_words, word_names

#: Labelled documents per language that the model may be learned from.
MAX_PER_LANGUAGE = 3_000
BITS = 15
SWITCH_PENALTY = 12.0
CHUNK = 4 << 20

# First bytes of UTF-8 sequences and the script they mostly start.
_SCRIPT = np.zeros(256, np.uint8)
_SCRIPT[65:91] = _SCRIPT[97:123] = _SCRIPT[0xC3:0xCA] = 1  # Latin
_SCRIPT[0xCE:0xD0] = 2  # Greek
_SCRIPT[0xD0:0xD4] = 3  # Cyrillic
_SCRIPT[0xD6:0xD8] = 4  # Hebrew
_SCRIPT[0xD8:0xDC] = 5  # Arabic
_SCRIPT[0xE0] = 6  # Indic, Thai and neighbours
_SCRIPT[0xE3] = 7  # Kana
_SCRIPT[0xE4:0xEA] = 8  # Han
_SCRIPT[0xEA:0xEE] = 9  # Hangul
_OTHER = 10  # letters of any other script
_SCRIPT[[0xD4, 0xD5, 0xDC, 0xDD, 0xDE, 0xDF, 0xE1]] = _OTHER
# Second bytes from which on a first byte starts letters; before them are signs.
_LETTERS_FROM = {0xE2: (0xB0, 0xB8), 0xEF: (0xAC, 0xBE), 0xF0: (0x90, 0x9F)}
SCRIPTS = 11


def _script_codes(data: np.ndarray) -> np.ndarray:
    """Script of the letter that each byte begins, 0 for all other bytes."""
    codes = _SCRIPT[data]
    for first, (low, high) in _LETTERS_FROM.items():
        at = np.flatnonzero(data[:-1] == first)
        codes[at[(data[at + 1] >= low) & (data[at + 1] < high)]] = _OTHER
    at = np.flatnonzero(data[:-1] == 0xF0)
    codes[at[data[at + 1] >= 0xA0]] = 8  # Han beyond the first plane
    return codes


def _trigrams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram around each byte of a word, and the first trigram of each word."""
    inside = ~SPACE[data]
    low = np.where(inside, LOWER[data], 32).astype(np.uint64)
    before = np.concatenate([[np.uint64(32)], low[:-1]])
    after = np.concatenate([low[1:], [np.uint64(32)]])
    before[starts] = 32
    after[ends - 1] = 32
    codes = ((before << np.uint64(16)) | (low << np.uint64(8)) | after)[inside]
    buckets = (mix(codes) >> np.uint64(64 - BITS)).astype(np.int32)
    sizes = ends - starts
    return buckets, np.cumsum(sizes) - sizes


def _word_buckets(names: np.ndarray) -> np.ndarray:
    return (mix(names + np.uint64(1)) >> np.uint64(64 - BITS)).astype(np.int32) + (1 << BITS)


def _scripts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Script of a word: that of most of its letters' first bytes, 0 for none."""
    if len(starts) == 0:
        return np.zeros(0, np.uint8)
    codes = _script_codes(data)
    best, most = np.zeros(len(starts), np.uint8), np.zeros(len(starts), np.int64)
    for s in range(1, SCRIPTS):
        if s > 1 and not (codes == s).any():
            continue
        n = np.add.reduceat((codes == s).astype(np.int32), starts)
        more = n > most
        best[more], most[more] = s, n[more]
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    scores: np.ndarray  # (buckets, languages), log probabilities
    scripts: np.ndarray  # (scripts, languages), True where seen
    penalty: float

    def word_scores(self, data, starts, ends) -> np.ndarray:
        n = len(self.languages)
        out = np.zeros((len(starts), n), np.float32)
        if len(starts) == 0:
            return out
        buckets, first = _trigrams(data, starts, ends)
        whole = _word_buckets(word_names(data, starts, lower=True))
        script = _scripts(data, starts, ends)
        for k in range(n):
            column = self.scores[:, k]
            out[:, k] = np.add.reduceat(column[buckets], first) + column[whole]
        allowed = self.scripts[script]
        out[~allowed & allowed.any(1)[:, None]] -= 1e4
        out[script == 0] = 0  # numbers and signs say nothing
        return out


def fit_language_model(
    docs: DataFrame, usable: Column, max_per_language: int = MAX_PER_LANGUAGE, penalty: float = SWITCH_PENALTY
) -> LanguageModel:
    """Learn from at most ``max_per_language`` usable documents of each language, whole texts."""
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = (
        docs.where(usable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
        .select("doc_id", "lang")
        .withColumn("n", F.row_number().over(w))
        .where(F.col("n") <= max_per_language)
        .select("doc_id", "lang")
        .distinct()
    )
    sample = docs.select("doc_id", "lang", "text").join(F.broadcast(picked), ["doc_id", "lang"]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches):
            langs = np.array(table["lang"].to_pylist(), object)
            for lang in sorted(set(langs)):
                data, offsets = as_bytes(table["text"].combine_chunks().filter(pa.array(langs == lang)))
                starts, ends, _ = split_words(data, offsets)
                if not len(starts):
                    continue
                buckets, _ = _trigrams(data, starts, ends)
                whole = _word_buckets(word_names(data, starts, lower=True))
                script = np.bincount(_scripts(data, starts, ends), minlength=SCRIPTS)
                n = np.concatenate([np.bincount(np.concatenate([buckets, whole]), minlength=2 << BITS), script])
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                    ["lang", "bucket", "n"],
                )

    counts = (
        sample.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    ).toArrow()
    languages = sorted(set(counts["lang"].to_pylist()))
    size = (2 << BITS) + SCRIPTS
    n = np.zeros((size, max(1, len(languages))))
    if languages:
        column = np.searchsorted(np.array(languages, object), np.array(counts["lang"].to_pylist(), object))
        n[counts["bucket"].to_numpy(), column] = counts["n"].to_numpy()
    grams, words, script = n[: 1 << BITS], n[1 << BITS : 2 << BITS], n[2 << BITS :]
    share = lambda x: np.log((x + 0.2) / (x.sum(0) + 0.2 * len(x)))
    seen = script > 0.001 * np.maximum(script.sum(0), 1)
    return LanguageModel(languages, np.vstack([share(grams), share(words)]).astype(np.float32), seen, penalty)


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word, for all texts at once: step t handles the t-th word of each."""
    n_words, n = scores.shape
    labels = np.zeros(n_words, np.int16)
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    base, sizes = first[:-1][order], sizes[order]
    if n_words == 0 or n == 1:
        return labels
    switched = np.zeros((n_words, n), bool)
    came = np.zeros(n_words, np.int16)
    steps = int(sizes[0])
    # alive[t]: texts with more than t words; they come first in the order.
    alive = np.searchsorted(-sizes, -np.arange(steps), side="left")
    state = np.zeros((len(base), n), np.float32)
    last = np.zeros(len(base), np.int16)
    for t in range(steps):
        k = alive[t]
        at = base[:k] + t
        now = state[:k]
        if t:
            top = now.argmax(1)
            jump = now[np.arange(k), top] - penalty
            came[at] = top
            switched[at] = jump[:, None] > now
            now = np.maximum(now, jump[:, None])
        state[:k] = now + scores[at]
    last[:] = state.argmax(1)
    for t in range(steps - 1, -1, -1):
        k = alive[t]
        at = base[:k] + t
        here = last[:k]
        labels[at] = here
        if t:
            last[:k] = np.where(switched[at, here], came[at], here)
    return labels


def label_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score (share of letters in that language) and the runs: spans of byte
    positions [start, end) with their language."""
    names = np.array([*model.languages, "und"], object)
    n = len(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, size=CHUNK):
            data, offsets = as_bytes(table["text"])
            rows = table.num_rows
            starts, ends, first = split_words(data, offsets)
            row = np.repeat(np.arange(rows), np.diff(first))
            ascii_letter = (_SCRIPT[data] == 1) & (data < 128)
            sums = np.concatenate([[0], np.cumsum(ascii_letter)])
            letters = (sums[offsets[1:]] - sums[offsets[:-1]]) > 0
            texts = table["text"]
            for k in np.flatnonzero(~letters & (np.diff(offsets) > 0)):
                letters[k] = any(ch.isalpha() for ch in texts[int(k)].as_py())
            if n == 0:
                letters[:] = False
            labels = viterbi(model.word_scores(data, starts, ends), first, model.penalty) if n else np.zeros(len(starts), np.uint8)
            script = _scripts(data, starts, ends)
            weight = np.where(script > 0, ends - starts, 0.01)
            share = np.bincount(row * (n + 1) + labels, weight, rows * (n + 1)).reshape(rows, n + 1)
            best = share[:, :n].argmax(1) if n else np.zeros(rows, int)
            score = np.where(letters, share[np.arange(rows), best] / np.maximum(share.sum(1), 1e-9), 0.0)
            pred = np.where(letters, best, n)
            keep = letters[row] if len(row) else np.zeros(0, bool)
            new = np.ones(len(labels), bool)
            new[1:] = (labels[1:] != labels[:-1]) | (row[1:] != row[:-1])
            at = np.flatnonzero(new)
            stop = np.append(at[1:], len(labels)) - 1
            held = keep[at]
            at, stop = at[held], stop[held]
            spans = pa.StructArray.from_arrays(
                [
                    pa.array(names[labels[at]].tolist(), pa.string()),
                    pa.array(starts[at] - offsets[row[at]], pa.int64()),
                    pa.array(ends[stop] - offsets[row[at]], pa.int64()),
                ],
                ["lang", "start", "end"],
            )
            bounds = np.searchsorted(row[at], np.arange(rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    table["doc_id"].combine_chunks().cast(pa.int64()),
                    pa.array(names[pred].tolist(), pa.string()),
                    pa.array(np.clip(score, 0, 1)),
                    pa.ListArray.from_arrays(pa.array(bounds), spans),
                ],
                ["doc_id", "lang_pred", "score", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, spans array<struct<lang: string, start: long, end: long>>"
    )
