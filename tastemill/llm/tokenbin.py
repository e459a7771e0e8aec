"""Token ids as raw shard files, with a minimal perfect hash index for access by document key.

A shard file is a 16-byte header (magic `TKID`, bytes per id, version, zeros) and the ids of its
documents one after the other, each document closed by the end id. Shards hold ascending ranges
of doc_id. The index is cut into buckets by a hash of the key; a bucket file holds a minimal
perfect hash (levels of bit arrays with ranks) and for each slot the key's 64-bit fingerprint and
its shard, offset and length, so a lookup is a few array reads whatever the number of keys.

Writers name files by attempt; the directory table lists the files of the tasks that succeeded,
so a lost executor leaves at most files that nothing refers to.

Defined cases: a null or empty text is the end id alone; a null doc_id sorts first; rows that
share a doc_id are all written, and their keys count up (copy 0, 1, ...) in the order of the
shard; extra columns are left out; an empty table has an empty directory.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastemill.llm.bpe import PieceEncoder
from tastemill.llm.common import chunks, mix, partitions, store
from tastemill.session import scratch_path

HEADER = 16
END_ID = 0
#: Keys in one bucket of the index, about.
BUCKET_KEYS = 100_000
_NULL_KEY = -(1 << 63)


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a folder named by URI or by local path."""
    if ":" in path.split("/", 1)[0]:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def key_names(doc_id: np.ndarray, copy: np.ndarray) -> np.ndarray:
    """64-bit name of a key; distinct for distinct doc_id of copy 0."""
    return mix(mix(doc_id.astype(np.int64).view(np.uint64)) + copy.astype(np.uint64))


# ---- minimal perfect hash -------------------------------------------------------------------


def _level_hash(names: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(names + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    """Keys that are alone at their place of a level stay there; the others go to the next level.

    A key's slot is the number of set bits before its bit. Keys left after the last level are
    kept in a sorted list and numbered behind the bits.
    """

    sizes: np.ndarray
    bits: np.ndarray  # all levels, packed
    ranks: np.ndarray  # set bits before each 64-bit block
    left: np.ndarray  # sorted names without a place

    @classmethod
    def build(cls, names: np.ndarray, gamma: float = 2.0, levels: int = 24) -> PerfectHash:
        todo, sizes, flags = names, [], []
        for level in range(levels):
            if not len(todo):
                break
            size = max(64, int(np.ceil(gamma * len(todo) / 64)) * 64)
            place = _level_hash(todo, level, size)
            n = np.bincount(place, minlength=size)
            sizes.append(size)
            flags.append(n == 1)
            todo = todo[n[place] != 1]
        bits = np.concatenate([np.zeros(0, bool), *flags])
        blocks = bits.reshape(-1, 64).sum(1) if len(bits) else np.zeros(0, np.int64)
        ranks = np.concatenate([[0], np.cumsum(blocks)]).astype(np.int64)
        return cls(np.array(sizes, np.int64), np.packbits(bits, bitorder="little"), ranks, np.sort(todo))

    def slots(self, names: np.ndarray) -> np.ndarray:
        """Slot of each name; a name that was not built in gets any slot or -1."""
        words = self.bits.view("<u8") if len(self.bits) else np.zeros(0, np.uint64)
        out = np.full(len(names), -1, np.int64)
        todo, base = np.arange(len(names)), 0
        for level, size in enumerate(self.sizes):
            at = base + _level_hash(names[todo], level, int(size))
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[here]] = self.ranks[at[here] >> 6] + np.bitwise_count(below[here])
            todo, base = todo[~here], base + int(size)
        if len(todo) and len(self.left):
            k = np.minimum(np.searchsorted(self.left, names[todo]), len(self.left) - 1)
            out[todo] = np.where(self.left[k] == names[todo], self.ranks[-1] + k, -1)
        return out


# ---- writing --------------------------------------------------------------------------------


def write_shards(docs: DataFrame, root: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the ids of ``docs`` below ``root``; returns one row per document: doc_id, copy,
    file, place (of the document in its file), first (id position in the file), n (ids)."""
    fs, inner = open_fs(root)
    fs.create_dir(inner, recursive=True)
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(partitions(docs.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.of_worker(tokenizer)
        end = np.array([end_id], encoder.kind).tobytes()
        name = f"shard-{uuid.uuid4().hex}.bin"
        out, place, first, last, copy = None, 0, 0, None, 0
        for table in chunks(batches):
            if out is None:
                fs, inner = open_fs(root)
                out = fs.open_output_stream(f"{inner}/{name}")
                out.write(b"TKID" + bytes([encoder.kind.itemsize, 1]) + bytes(10))
            ids = encoder.encode("" if t is None else t for t in table["text"].to_pylist())
            out.write(b"".join(x for one in ids for x in (one, end)))
            n = np.array([len(x) // encoder.kind.itemsize + 1 for x in ids], np.int64)
            keys = [_NULL_KEY if d is None else d for d in table["doc_id"].to_pylist()]
            copies = []
            for key in keys:
                copy = copy + 1 if key == last else 0
                last = key
                copies.append(copy)
            yield pa.RecordBatch.from_arrays(
                [
                    table["doc_id"].combine_chunks(),
                    pa.array(copies, pa.int64()),
                    pa.array([name] * len(n)),
                    pa.array(np.arange(place, place + len(n))),
                    pa.array(first + np.cumsum(n) - n),
                    pa.array(n),
                ],
                ["doc_id", "copy", "file", "place", "first", "n"],
            )
            place, first = place + len(n), first + int(n.sum())
        if out is not None:
            out.close()

    rows = ordered.mapInArrow(run, "doc_id long, copy long, file string, place long, first long, n long")
    return store(rows, "token-directory")


def shard_table(directory: DataFrame) -> DataFrame:
    """One row per shard file: file, base (ids in all shards before it), total."""
    sums = directory.groupBy("file").agg(
        F.min(F.coalesce("doc_id", F.lit(_NULL_KEY))).alias("low"), F.sum("n").alias("total")
    )
    # One row per shard file, so the window's size is the number of partitions written.
    before = Window.orderBy("low", "file").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("file", "total", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def _bucket(n: int):
    return F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(_NULL_KEY)), "copy"), F.lit(n)).cast("int")


def _by_bucket(df: DataFrame, column: str) -> DataFrame:
    return df.repartition(partitions(df.sparkSession), column).sortWithinPartitions(column)


def _groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Whole groups of rows sorted by ``column``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch.column(column).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if held and held[-1].column(column)[0].as_py() != values[a]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def build_index(directory: DataFrame, root: str, buckets: int) -> DataFrame:
    """Write one index file per bucket of keys; returns bucket, index_file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "bucket"):
            fs, inner = open_fs(root)
            ids = group["doc_id"].fill_null(_NULL_KEY).to_numpy()
            names = key_names(ids, group["copy"].to_numpy())
            table = PerfectHash.build(names)
            order = np.argsort(table.slots(names))
            files, code = np.unique(np.array(group["file"].to_pylist()), return_inverse=True)
            held = io.BytesIO()
            np.savez(
                held, sizes=table.sizes, bits=table.bits, ranks=table.ranks, left=table.left, files=files,
                fingerprint=mix(names ^ np.uint64(0x5851F42D4C957F2D))[order], shard=code[order],
                first=group["first"].to_numpy()[order], n=group["n"].to_numpy()[order],
            )
            name = f"index-{uuid.uuid4().hex}.npz"
            with fs.open_output_stream(f"{inner}/{name}") as out:
                out.write(held.getvalue())
            yield pa.RecordBatch.from_arrays(
                [pa.array([group["bucket"][0].as_py()], pa.int32()), pa.array([name])], ["bucket", "index_file"]
            )

    rows = _by_bucket(directory.withColumn("bucket", _bucket(buckets)), "bucket")
    return store(rows.mapInArrow(run, "bucket int, index_file string"), "token-index")


@dataclass
class TokenStore:
    root: str
    directory: DataFrame
    index: DataFrame
    buckets: int


def write_tokens(docs: DataFrame, tokenizer: str, root: str | None = None, end_id: int = END_ID) -> TokenStore:
    root = root or scratch_path(docs.sparkSession, "tokens")
    directory = write_shards(docs, root, tokenizer, end_id)
    buckets = max(1, directory.count() // BUCKET_KEYS)
    return TokenStore(root, directory, build_index(directory, root, buckets), buckets)


# ---- reading --------------------------------------------------------------------------------


def locate(keys: DataFrame, tokens: TokenStore) -> DataFrame:
    """doc_id, copy, file, first, n for each key found through the index; unknown keys are left out."""
    root = tokens.root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = open_fs(root)
        for group in _groups(batches, "bucket"):
            with fs.open_input_file(f"{inner}/{group['index_file'][0].as_py()}") as f:
                held = np.load(io.BytesIO(f.read()))
            table = PerfectHash(held["sizes"], held["bits"], held["ranks"], held["left"])
            ids = group["doc_id"].fill_null(_NULL_KEY).to_numpy()
            names = key_names(ids, group["copy"].to_numpy())
            slot = table.slots(names)
            found = (slot >= 0) & (held["fingerprint"][slot] == mix(names ^ np.uint64(0x5851F42D4C957F2D)))
            slot = slot[found]
            yield pa.RecordBatch.from_arrays(
                [
                    group["doc_id"].combine_chunks().filter(pa.array(found)),
                    group["copy"].combine_chunks().filter(pa.array(found)),
                    pa.array(held["files"][held["shard"][slot]].tolist(), pa.string()),
                    pa.array(held["first"][slot]),
                    pa.array(held["n"][slot]),
                ],
                ["doc_id", "copy", "file", "first", "n"],
            )

    rows = keys.select("doc_id", "copy").withColumn("bucket", _bucket(tokens.buckets)).join(tokens.index, "bucket")
    return _by_bucket(rows, "bucket").mapInArrow(run, "doc_id long, copy long, file string, first long, n long")


def read_payloads(places: DataFrame, root: str, payload: bool = True) -> DataFrame:
    """Adds ids_crc32 (of the ids as little-endian 32-bit numbers) and, if asked, the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = open_fs(root)
        name, f, kind = None, None, None
        for batch in batches:
            crc, ids = [], []
            for file, first, n in zip(*(batch.column(c).to_pylist() for c in ("file", "first", "n"))):
                if file != name:
                    if f is not None:
                        f.close()
                    name, f = file, fs.open_input_file(f"{inner}/{file}")
                    head = f.read_at(HEADER, 0)
                    if head[:4] != b"TKID":
                        raise ValueError(f"{file} is no token shard")
                    kind = np.dtype(f"<u{head[4]}")
                got = np.frombuffer(f.read_at(n * kind.itemsize, HEADER + first * kind.itemsize), kind)
                crc.append(zlib.crc32(got.astype("<u4").tobytes()))
                if payload:
                    ids.append(got.astype(np.int32))
            out = [*batch.columns, pa.array(crc, pa.int64())]
            if payload:
                out.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(out, [*batch.schema.names, "ids_crc32", *["ids"] * payload])
        if f is not None:
            f.close()

    schema = "doc_id long, copy long, file string, first long, n long, ids_crc32 long" + ", ids array<int>" * payload
    n = partitions(places.sparkSession)
    return places.repartition(n, "file").sortWithinPartitions("file", "first").mapInArrow(run, schema)


def read_all(tokens: TokenStore, payload: bool = False) -> DataFrame:
    """Every document through the index and its shard, with its start in the whole sequence."""
    keys = tokens.directory.select("doc_id", "copy")
    rows = read_payloads(locate(keys, tokens), tokens.root, payload)
    return rows.join(shard_table(tokens.directory), "file").withColumn("start", F.col("base") + F.col("first"))


def lookup(spark: SparkSession, tokens: TokenStore, keys: DataFrame) -> DataFrame:
    """Ids of the documents named by the doc_id of ``keys`` (copy 0 unless a copy is given)."""
    if "copy" not in keys.columns:
        keys = keys.withColumn("copy", F.lit(0).cast("long"))
    return read_payloads(locate(keys, tokens), tokens.root)
