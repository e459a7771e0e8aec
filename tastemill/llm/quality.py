"""Quality score by pairwise ranking (Bradley-Terry).

Preference pairs (a document marked good, one marked bad) are drawn from a bounded sample of
labelled rows; weights come from the logistic loss on the difference of their feature vectors.
A monotone calibration on the same rows turns the ranking score into 0..1. Scoring is one pass
over whole texts without a shuffle; the model that travels with it has a few dozen numbers.

Defined cases: a null or empty text has the features of an empty text and gets a score; repeated
rows are scored alike; other columns are kept out of the features and passed through untouched;
an empty table gives an empty result; without both kinds of labelled rows every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import SPACE, as_bytes, chunks, split_words, tidy, word_names

#: Labelled rows and preference pairs that the fit may use.
MAX_LABELLED = 20_000
MAX_PAIRS = 200_000

_CLASSES: list[np.ndarray] = []
for _members in (
    range(65, 91), range(97, 123), range(48, 58), range(128, 256), b" ", b"\n", b".,;:", b"!", b"?",
    b"|", b"#$%&*", b"+=<>[]{}\\/_^~@", b"\"'()-`",
):
    _row = np.zeros(256, bool)
    _row[list(_members)] = True
    _CLASSES.append(_row)


def features(column: pa.Array) -> np.ndarray:
    """One row of numbers per text: shares of character classes, word and line statistics."""
    data, offsets = as_bytes(column)
    rows = len(offsets) - 1
    size = np.diff(offsets).astype(float)

    def per_row(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    out = [np.log1p(size)]
    for members in _CLASSES:
        n = per_row(members[data])
        out += [n / np.maximum(size, 1), np.log((n + 0.5) / (size + 1))]
    starts, ends, first = split_words(data, offsets)
    words = np.diff(first).astype(float)
    row = np.repeat(np.arange(rows), np.diff(first))

    def of_words(values: np.ndarray) -> np.ndarray:
        return np.bincount(row, values, rows)

    names = word_names(data, starts, lower=True)
    length = (ends - starts).astype(float)
    some = np.maximum(words, 1)
    mean = of_words(length) / some
    out += [np.log1p(words), mean, np.sqrt(np.maximum(of_words(length**2) / some - mean**2, 0))]
    again = np.zeros(len(names))
    again[1:] = (names[1:] == names[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((names, row))
    fresh = np.ones(len(names), bool)
    fresh[1:] = (names[order][1:] != names[order][:-1]) | (row[order][1:] != row[order][:-1])
    distinct = np.bincount(row[order][fresh], minlength=rows).astype(float)
    upper = _CLASSES[0]
    both = np.zeros(len(starts))
    if len(starts):
        second = np.minimum(starts + 1, len(data) - 1)
        both = (upper[data[starts]] & upper[data[second]] & (ends - starts > 1)).astype(float)
        odd = np.add.reduceat((_CLASSES[7] | _CLASSES[9] | _CLASSES[10] | _CLASSES[11])[data].astype(np.int64), starts)
    else:
        odd = np.zeros(0)
    marked = (odd > 0).astype(float)
    for v in (again, both, marked):
        n = of_words(v)
        out += [n / some, np.log((n + 0.5) / (words + 1))]
    out += [distinct / some, np.log((words - distinct + 0.5) / (words + 1))]
    lines = per_row(_CLASSES[5][data]) + 1
    out += [np.log(words / lines + 1)]
    return np.column_stack(out) if rows else np.zeros((0, len(out)))


@dataclass
class Ranker:
    """Bradley-Terry weights over standardized features, and the calibration of the score."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float
    shift: float

    def rank(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.rank(x) + self.shift, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 25) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_ranker(x: np.ndarray, good: np.ndarray, max_pairs: int = MAX_PAIRS, seed: int = 7) -> Ranker:
    """Fit on pairs (good row, bad row); ``good`` holds 0 or 1 for each row of ``x``."""
    if len(x) == 0 or good.min() == good.max():
        d = x.shape[1]
        return Ranker(np.zeros(d), np.ones(d), np.zeros(d), 0.0, 0.0)
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.clip((x - centre) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    plus, minus = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    n = min(max_pairs, len(plus) * len(minus))
    apart = z[rng.choice(plus, n)] - z[rng.choice(minus, n)]
    # Every pair says "first beats second": the loss is log(1 + exp(-w . difference)).
    w = _logistic(apart, np.ones(n), ridge=1e-3 * n)
    s = z @ w
    slope, shift = _logistic(np.column_stack([s, np.ones(len(s))]), good.astype(float), ridge=1e-3)
    return Ranker(centre, scale, w, max(float(slope), 0.0), float(shift))


def labelled_features(
    docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int = MAX_LABELLED
) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``max_rows`` labelled documents, in an order set by a hash of the id."""
    picked = (
        labels.where(usable & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    joined = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches):
            x = features(table["text"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), pa.list_(pa.float64())), table["quality"].combine_chunks().cast(pa.int32())],
                ["x", "quality"],
            )

    got = joined.mapInArrow(tidy(run), "x array<double>, quality int").toArrow()
    wide = features(pa.array([""])).shape[1]
    x = np.array(got["x"].to_pylist(), float).reshape(-1, wide)
    y = got["quality"].to_numpy().astype(int)
    order = np.lexsort(np.vstack([x.T, y]))  # the fit doesn't depend on the order of arrival
    return x[order], y[order]


def score_quality(docs: DataFrame, ranker: Ranker, name: str = "score") -> DataFrame:
    """Every column of ``docs`` and a score between 0 and 1, higher where good is likelier."""
    fields = [f for f in docs.schema.fields if f.name != name]
    kept = [f.name for f in fields]
    schema = docs.select(*[f"`{c}`" for c in kept]).withColumn(name, F.lit(0.5)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches):
            score = ranker.score(features(table["text"]))
            yield from table.append_column(name, pa.array(score)).to_batches()

    return docs.select(*[f"`{c}`" for c in kept]).mapInArrow(tidy(run), schema)


def threshold_at(scored: DataFrame, share: float, name: str = "score") -> float:
    """Score below which about ``share`` of all rows lie, for callers who reject a fixed share."""
    got = scored.agg(F.percentile_approx(name, share, 10_000).alias("t")).first()
    return got["t"] if got["t"] is not None else 0.0


def train_ranker(docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int = MAX_LABELLED) -> Ranker:
    return fit_ranker(*labelled_features(docs, labels, usable, max_rows))
