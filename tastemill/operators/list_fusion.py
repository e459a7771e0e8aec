"""Blends of intent and personal lists that are kept once for each text and each user.

A request is one thin row until its first items are known: tiles of text lists and of user lists meet on a grid, each
request goes to the cell of its text and its user, and only the blended items leave the task. What is shuffled follows the
requests and the lists, not the requests times the length of their lists.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.operators.search import FUSION_STRONG, fuse_rankings, fusion_weight, minmax, preset_weight, without
from tastemill.operators.tiles import grid_of, tile_of
from tastemill.session import materialize, shuffled

TEXT, USER, REQUEST = 0, 1, 2
#: Requests that are worth a cell of their own.
CELL_REQUESTS = 1 << 17
#: Cells that the requests of one user and one text are dealt to.
SHARES = 4
#: Numbers of eight bytes that an entry of a list, with its title and category, is reckoned at.
ENTRY = 12
_SHOWN = "array<struct<title:string,category:string>>"


def catalog_rows(catalog: DataFrame) -> DataFrame:
    """``(item_id, shown)``: title and category of each of an item's rows in the catalog."""
    return catalog.where("item_id IS NOT NULL").groupBy("item_id").agg(F.collect_list(F.struct("title", "category")).alias("shown"))


def _lists(rows: DataFrame, key: str, shown: DataFrame) -> DataFrame:
    """``(key, items, norms, shown)``, one row for each key of ``(key, item_id, score)``."""
    known = minmax(rows.select(key, "item_id", "score"), by=key).join(shuffled(shown), "item_id")
    entries = F.collect_list(F.struct("item_id", "norm", "shown"))
    grouped = known.groupBy(key).agg(entries.alias("e"))
    return grouped.select(key, F.col("e.item_id").alias("items"), F.col("e.norm").alias("norms"), F.col("e.shown").alias("shown"))


def fuse_lists(
    requests: DataFrame, by_text: DataFrame, by_user: DataFrame, catalog: DataFrame, k: int = 10, depth: int = 20
) -> DataFrame:
    """``(request_id, rank, item_id, title, category, score)``: ``fuse_rankings`` of each request's two lists, and the
    catalog head for a request without any.

    ``requests`` are ``(request_id, user_id, q, preset)``, lists ``(q, item_id, score)`` and ``(user_id, item_id, score)`` of about
    ``depth`` items. An id that several requests share has all their lists together, which is left to ``fuse_rankings``.
    """
    shown = materialize(catalog_rows(catalog), "shown")
    counts = requests.where("request_id IS NOT NULL").groupBy("request_id").agg(F.count("*").alias("n"))
    shared = materialize(counts.where("n > 1").select("request_id"), "shared")
    if shared.isEmpty():
        return _in_cells(requests, by_text, by_user, catalog, shown, k, depth)
    alone = _in_cells(without(requests, shared), by_text, by_user, catalog, shown, k, depth)
    together = _by_rows(requests.join(shuffled(shared), "request_id", "left_semi"), by_text, by_user, catalog, shown, k)
    return alone.unionByName(together)


def _head(catalog: DataFrame, shown: DataFrame, k: int) -> Column:
    """The first ``k`` items of the catalog as ``(items, scores, shown)``: k entries."""
    first = catalog.select("item_id").orderBy("item_id").limit(k).join(shown, "item_id")
    entries = F.collect_list(F.struct(F.col("item_id").alias("items"), F.lit(1.0).alias("scores"), "shown"))
    return first.agg(F.array_sort(entries).alias("e")).scalar()


def _shown_rows(entries: DataFrame) -> DataFrame:
    """One row for each catalog row of the items in ``(request_id, e)``."""
    rows = entries.select("request_id", F.posexplode("e").alias("p", "x"))
    rows = rows.select("request_id", (F.col("p") + 1).alias("rank"), "x.items", F.round("x.scores", 4).alias("score"), F.explode("x.shown").alias("s"))
    return rows.select("request_id", "rank", F.col("items").alias("item_id"), "s.title", "s.category", "score")


def _by_rows(requests: DataFrame, by_text: DataFrame, by_user: DataFrame, catalog: DataFrame, shown: DataFrame, k: int) -> DataFrame:
    """The same from one row for each item of each request, whatever the ids."""
    requests = materialize(requests, "requests")
    sem = materialize(requests.join(by_text, "q").select("request_id", "item_id", "score"), "intent")
    per = materialize(requests.join(by_user, "user_id").select("request_id", "item_id", "score"), "personal")
    weights = requests.select("request_id", fusion_weight(F.col("preset"), F.col("q")).alias("w_sem"))
    fused = materialize(fuse_rankings(sem, per, weights, k), "fused")
    default = _shown_rows(without(requests.select("request_id"), fused).select("request_id", _head(catalog, shown, k).alias("e")))
    named = fused.join(shown, "item_id").select("request_id", "rank", "item_id", F.explode("shown").alias("s"), "score")
    return named.select("request_id", "rank", "item_id", "s.title", "s.category", "score").unionByName(default)


def _in_cells(
    requests: DataFrame, by_text: DataFrame, by_user: DataFrame, catalog: DataFrame, shown: DataFrame, k: int, depth: int
) -> DataFrame:
    """Blends of requests whose ids are their own; a null id has no lists."""
    texts = requests.where("q IS NOT NULL").select("q").distinct()
    texts = texts.withColumn("w", fusion_weight(F.lit(None).cast("string"), F.col("q")))
    texts = materialize(shuffled(texts).join(_lists(by_text, "q", shown), "q", "left"), "text-lists")
    users = materialize(_lists(by_user, "user_id", shown).where("user_id IS NOT NULL"), "user-lists")
    n_texts, n_users, n_requests = texts.count(), users.count(), requests.count()
    cells = math.ceil(n_requests / CELL_REQUESTS)
    shares = min(SHARES, cells)
    grid = grid_of(n_users, n_texts, ENTRY * depth, 0, math.ceil(cells / shares))
    kinds = {"request_id": requests.schema["request_id"].dataType, "user_id": requests.schema["user_id"].dataType, "q": "string", "w": "double"}
    kinds |= {"items": "array<string>", "norms": "array<double>", "shown": f"array<{_SHOWN}>"}

    def sent(df: DataFrame, kind: int, part: Column) -> DataFrame:
        columns = [F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in kinds.items()]
        return df.select(part.alias("part"), F.lit(kind).alias("kind"), *columns)

    def copied(df: DataFrame, across: int) -> DataFrame:
        for name, n in (("_c", across), ("_s", shares)):
            df = df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        return df

    def cell(user: Column, text: Column, share: Column) -> Column:
        return ((user * grid.down + text) * shares + share).cast("int")

    user_tile, text_tile = tile_of(F.col("user_id"), grid.across), tile_of(F.col("q"), grid.down)
    asked = requests.select("request_id", "user_id", "q", preset_weight(F.col("preset")).alias("w"))
    rows = sent(copied(texts, grid.across), TEXT, cell(F.col("_c"), text_tile, F.col("_s")))
    rows = rows.unionByName(sent(copied(users, grid.down), USER, cell(user_tile, F.col("_c"), F.col("_s"))))
    rows = rows.unionByName(sent(asked, REQUEST, cell(user_tile, text_tile, tile_of(F.col("request_id"), shares))))
    laid = rows.repartitionById(grid.across * grid.down * shares, "part").sortWithinPartitions("kind")
    request_id = kinds["request_id"].simpleString()
    blended = laid.drop("part").mapInArrow(_blend(k), f"request_id {request_id}, items array<string>, scores array<double>, shown array<{_SHOWN}>")
    entries = F.when(F.size("items") > 0, F.arrays_zip("items", "scores", "shown")).otherwise(_head(catalog, shown, k))
    return _shown_rows(blended.select("request_id", entries.alias("e")))


class _Side:
    """Lists of one side of a cell by key, each in the order of its items' codes."""

    def __init__(self, keys: pa.Array, sizes: np.ndarray, codes: np.ndarray, norms: np.ndarray) -> None:
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((codes, owner))
        self.keys, self.sizes, self.starts = keys, sizes, np.cumsum(sizes) - sizes
        self.codes, self.norms = codes[order], norms[order]
        self.twice = bool(((owner[1:] == owner[:-1]) & (self.codes[1:] == self.codes[:-1])).any())

    def find(self, keys: pa.Array) -> np.ndarray:
        """The list of each key, -1 where it has none."""
        return pc.index_in(keys, value_set=self.keys, skip_nulls=True).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    def entries(self, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, code and norm of every entry of the list that each row has."""
        rows = np.flatnonzero(lists >= 0)
        sizes, starts = self.sizes[lists[rows]], self.starts[lists[rows]]
        at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return np.repeat(rows, sizes), self.codes[at], self.norms[at]


class _Cell:
    """Both sides of one cell; codes number the items in the order of their ids."""

    def __init__(self, texts: pa.Table, users: pa.Table) -> None:
        both = pa.concat_tables([texts, users])
        whole = {c: both[c].combine_chunks() for c in ("items", "norms", "shown")}
        sizes = pc.fill_null(pc.list_value_length(whole["items"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        names, norms, shown = (whole[c].flatten() for c in ("items", "norms", "shown"))
        found = pc.unique(names)
        self.names = found.take(pc.sort_indices(found))
        codes = pc.index_in(names, value_set=self.names).to_numpy(zero_copy_only=False).astype(np.int64)
        self.shown = shown.take(pa.array(np.unique(codes, return_index=True)[1]))
        norms = norms.to_numpy(zero_copy_only=False)
        n, cut = len(texts), int(sizes[: len(texts)].sum())
        self.texts = _Side(texts["q"].combine_chunks(), sizes[:n], codes[:cut], norms[:cut])
        self.users = _Side(users["user_id"].combine_chunks(), sizes[n:], codes[cut:], norms[cut:])
        self.weight = np.append(texts["w"].to_numpy(), FUSION_STRONG)  # the last one is that of a null text

    def blend(self, asked: pa.RecordBatch, k: int) -> pa.RecordBatch:
        """The first ``k`` items of each request."""
        ids = asked.column("request_id")
        named = ids.is_valid().to_numpy(zero_copy_only=False)
        text, user = self.texts.find(asked.column("q")), self.users.find(asked.column("user_id"))
        w = asked.column("w").to_numpy(zero_copy_only=False)
        w = np.where(np.isnan(w), self.weight[text], w)
        (row_s, code_s, sem), (row_p, code_p, per) = (side.entries(np.where(named, at, -1)) for side, at in ((self.texts, text), (self.users, user)))
        n = max(1, len(self.names))
        key_s, key_p = row_s * n + code_s, row_p * n + code_p
        if self.texts.twice or self.users.twice:
            met = pd.DataFrame({"key": key_s, "sem": sem}).merge(pd.DataFrame({"key": key_p, "per": per}), on="key", how="outer")
            key, from_sem = met["key"].to_numpy(), met["sem"].notna().to_numpy()
            sem, per = met["sem"].fillna(0.0).to_numpy(), met["per"].fillna(0.0).to_numpy()
        else:
            at = np.searchsorted(key_s, key_p)
            also = np.append(key_s, -1)[at] == key_p
            beside = np.zeros(len(key_s))
            beside[at[also]] = per[also]
            key, from_sem = np.concatenate([key_s, key_p[~also]]), np.repeat([True, False], [len(key_s), (~also).sum()])
            sem, per = np.concatenate([sem, np.zeros((~also).sum())]), np.concatenate([beside, per[~also]])
        row, code = key // n, key % n
        fused = w[row] * sem + (1.0 - w[row]) * per
        # Blends of the same parts must tie whichever way they were added up.
        order = np.lexsort((code + n * ~from_sem, -np.floor(fused * 1e12 + 0.5), row))
        row = row[order]
        first = np.arange(len(row)) - np.searchsorted(row, np.arange(len(ids)))[row] < k
        picked, row = order[first], row[first]
        ends = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=len(ids)))), pa.int32())
        taken = pa.array(code[picked])
        parts = [self.names.take(taken), pa.array(fused[picked], pa.float64()), self.shown.take(taken)]
        return pa.RecordBatch.from_arrays([ids, *(pa.ListArray.from_arrays(ends, p) for p in parts)], ["request_id", "items", "scores", "shown"])


def _blend(k: int):
    """Arrow function over one cell, lists first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {TEXT: [], USER: []}
        cell, schema = None, None
        for batch in batches:
            schema = batch.schema
            kind = batch.column("kind").to_numpy()
            a, b = (int(x) for x in np.searchsorted(kind, (USER, REQUEST)))
            for side, part in ((TEXT, batch.slice(0, a)), (USER, batch.slice(a, b - a))):
                if part.num_rows:
                    held[side].append(part)
            asked = batch.slice(b)
            if asked.num_rows:
                cell = cell or _Cell(*(pa.Table.from_batches(held[side], schema) for side in (TEXT, USER)))
                yield cell.blend(asked, k)

    return run
