"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

A batch is a set of signed rows (documents put in, taken out, or counted anew: the old count with
sign -1 and the new one with +1). Committing a batch adds its sums to the rollup under the
batch's name; a batch that is already there is left alone, so a replay after a failure changes
nothing. Totals are the sum over all committed batches and never need the documents again; batches can be merged, so that
totals don't read every batch there ever was.

Defined cases: null source or language is a key of its own; null and empty texts count as a
document of no tokens; repeated rows count each; a key whose documents all went away keeps no row;
an empty batch commits and changes nothing; extra columns are left out.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm.bpe import PieceEncoder
from tastemill.llm.common import as_bytes, chunks, split_words
from tastemill.session import scratch_path

KEYS = ("source", "lang", "tokenizer")
_DELTA = "source string, lang string, tokenizer string, docs long, tokens long"


class Rollup:
    """Additive totals in a folder.

    ``sums/<id>`` holds the delta sums of a batch or of merged batches, ``batches/<name>`` is the marker of a committed batch
    and names its sums, ``heads/<n>`` says which sums stand for which batches. Markers and heads are created only if absent.
    """

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        self.spark = spark
        self.root = root or scratch_path(spark, "rollup")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._io = jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for folder in ("sums", "batches", "heads"):
            self._fs.mkdirs(self._path(f"{self.root}/{folder}"))

    def _names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/{folder}")))

    def _create(self, name: str, text: str) -> bool:
        path = self._path(f"{self.root}/{name}")
        if self._fs.exists(path):
            return False
        try:
            out = self._fs.create(path, False)
        except Exception as e:  # another writer was first
            if self._fs.exists(path):
                return False
            raise e
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _text(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.root}/{name}"))
        try:
            return bytes(self._io.toByteArray(stream)).decode()
        finally:
            stream.close()

    def committed(self) -> list[str]:
        return self._names("batches")

    def _head(self) -> tuple[int, dict]:
        numbers = [int(n) for n in self._names("heads")]
        return (max(numbers), json.loads(self._text(f"heads/{max(numbers)}"))) if numbers else (-1, {"sums": None, "merged": []})

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add signed rows (source, lang, tokenizer, tokens, sign); False if the batch is known.

        Sums are written aside and count from the moment their marker is there: a batch is there whole or not, and of two
        writers of one name one alone succeeds.
        """
        if batch in self.committed():
            return False
        folder = uuid.uuid4().hex
        (
            changes.groupBy(*KEYS)
            .agg(F.sum("sign").cast("long").alias("docs"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens"))
            .where("docs != 0 OR tokens != 0")
            .write.parquet(f"{self.root}/sums/{folder}")
        )
        if self._create(f"batches/{batch}", folder):
            return True
        self._fs.delete(self._path(f"{self.root}/sums/{folder}"), True)
        return False

    def _rows(self, head: dict, names: list[str]) -> DataFrame:
        folders = ([head["sums"]] if head["sums"] else []) + [self._text(f"batches/{n}") for n in names]
        if not folders:
            return self.spark.createDataFrame([], _DELTA)
        rows = self.spark.read.schema(_DELTA).parquet(*(f"{self.root}/sums/{f}" for f in folders))
        sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs != 0 OR tokens != 0")

    def totals(self) -> DataFrame:
        """The merged sums and those of the batches after them."""
        _, head = self._head()
        return self._rows(head, [n for n in self.committed() if n not in set(head["merged"])])

    def merge(self) -> int:
        """Add the batches that are not merged into one table of sums; their number."""
        number, head = self._head()
        names = [n for n in self.committed() if n not in set(head["merged"])]
        if names:
            folder = uuid.uuid4().hex
            self._rows(head, names).write.parquet(f"{self.root}/sums/{folder}")
            after = {"sums": folder, "merged": sorted([*head["merged"], *names])}
            if not self._create(f"heads/{number + 1}", json.dumps(after)):
                self._fs.delete(self._path(f"{self.root}/sums/{folder}"), True)
                raise RuntimeError("another merge was first; run merge again")
        return len(names)


def count_tokens(docs: DataFrame, tokenizers: dict[str, str | None]) -> DataFrame:
    """doc_id, source, lang, text_hash, n_bytes and one column per tokenizer version.

    ``tokenizers`` maps a version name to a byte-level BPE file, or to None for words.
    """
    names = list(tokenizers)
    rows = docs.select(
        F.col("doc_id").cast("long"), "source", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_hash"), "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches):
            data, offsets = as_bytes(table["text"])
            _, _, first = split_words(data, offsets)
            out = [table[c].combine_chunks() for c in ("doc_id", "source", "lang", "text_hash")]
            out.append(pa.array(np.diff(offsets)))
            for name in names:
                if tokenizers[name] is None:
                    n = np.diff(first)
                else:
                    encoder = PieceEncoder.of_worker(tokenizers[name])
                    ids = encoder.encode(t or "" for t in table["text"].to_pylist())
                    n = np.array([len(x) // encoder.kind.itemsize for x in ids], np.int64)
                out.append(pa.array(n, pa.int64()))
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "source", "lang", "text_hash", "n_bytes", *names])

    schema = "doc_id long, source string, lang string, text_hash string, n_bytes long" + "".join(
        f", `{n}` long" for n in names
    )
    return rows.mapInArrow(run, schema)


def signed(counts: DataFrame, tokenizers: Sequence[str], sign: int, tokens=None) -> DataFrame:
    """Long form of per-document counts with a sign; ``tokens`` may replace the counted value."""
    pairs = F.array(
        *(
            F.struct(F.lit(n).alias("tokenizer"), (F.col(f"`{n}`") if tokens is None else tokens).cast("long").alias("tokens"))
            for n in tokenizers
        )
    )
    return counts.select("source", "lang", F.explode(pairs).alias("p"), F.lit(sign).alias("sign")).select(
        "source", "lang", "p.tokenizer", "p.tokens", "sign"
    )


def first_copies(counts: DataFrame, tokenizers: Sequence[str]) -> DataFrame:
    """For each distinct text the row with the smallest doc_id; equal texts meet pre-aggregated."""
    cols = ["source", "lang", "n_bytes", *tokenizers]
    order = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)), F.xxhash64("source", "lang"))
    return (
        counts.groupBy("text_hash").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in cols]), order).alias("r")).select("r.*")
    )
