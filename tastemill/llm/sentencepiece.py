"""SentencePiece encoding and decoding over a lattice of pieces.

The pieces and scores of a SentencePiece model are a table. A word (its spaces and what follows up
to the next space; no piece crosses that border) is cut into all substrings of bounded length,
those that are pieces become edges with the piece's score, and the path with the highest sum is
the encoding. A character that is no piece is an edge of its own at a penalty and comes out as its
byte pieces. Ties go to the path whose last piece is longest.

The lattice is built twice, with equal results. ``encode_words`` is relational: substrings are
exploded and joined to the piece table, edges grouped by word, and Spark's ``aggregate`` folds each
group. ``PieceLattice`` does the same steps on arrays inside an Arrow task. Documents use the
relational encodings of the most frequent words, a table of bounded size sent to all tasks, and
the array lattice for all others: a relational join of every word of every document would shuffle
several times the input.

Defined cases: a null or empty text has no pieces and decodes to an empty text; very long words are
one lattice like others; repeated rows are encoded alike; extra columns are left out; the
character U+2581 is encoded as a space, as the format has it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm.common import BYTE_NAMES, SpanHash, chunks, ranges, store, tidy

#: Frequent words that are encoded beforehand, at most.
FREQUENT_WORDS = 1 << 16
#: Words that a worker keeps encodings of, in each of two generations.
CACHE_WORDS = 200_000
UNKNOWN_PENALTY = 10.0


@dataclass
class PieceTable:
    """Pieces of a model: text (with a space for the mark), id, score; byte pieces apart."""

    texts: list[str]
    ids: list[int]
    scores: list[float]
    byte_ids: list[int]
    controls: set[int]

    @classmethod
    def load(cls, path: str) -> PieceTable:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts, ids, scores, controls = [], [], [], set()
        byte_ids = [0] * 256
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                controls.add(i)
            else:
                texts.append(piece.replace("▁", " "))
                ids.append(i)
                scores.append(model.get_score(i))
        return cls(texts, ids, scores, byte_ids, controls)

    @property
    def unknown(self) -> float:
        return min(self.scores) - UNKNOWN_PENALTY

    def longest(self) -> int:
        return max(map(len, self.texts))


# ---- relational lattice ---------------------------------------------------------------------


def encode_words(words: DataFrame, pieces: PieceTable) -> DataFrame:
    """word, ids for a table of distinct words."""
    spark = words.sparkSession
    table = spark.createDataFrame(
        pa.table({"part": pieces.texts, "id": pa.array(pieces.ids, pa.int32()), "score": pieces.scores})
    )
    size = F.length("word")
    starts = words.where(size > 0).select("word", F.explode(F.sequence(F.lit(0), size - 1)).alias("s"))
    spans = starts.select("word", "s", F.explode(F.sequence(F.lit(1), F.least(F.lit(pieces.longest()), size - F.col("s")))).alias("n"))
    parts = spans.withColumn("part", F.substring("word", F.col("s") + 1, F.col("n")))
    edges = (
        parts.join(F.broadcast(table), "part", "left").where(F.col("id").isNotNull() | (F.col("n") == 1))
        .select(
            "word", "s", (F.col("s") + F.col("n")).alias("e"), F.coalesce("id", F.lit(-1)).alias("id"),
            F.coalesce("score", F.lit(pieces.unknown)).alias("score"),
        )
    )
    lattice = edges.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("s", "e", "id", "score"))).alias("edges"))
    # Edges come by start, so the best path to an edge's start is final when the edge is met.
    best = """aggregate(edges,
        transform(sequence(0, length(word)), i -> named_struct(
            'score', if(i = 0, 0D, CAST('-Infinity' AS DOUBLE)), 'prev', -1, 'id', -2)),
        (b, x) -> transform(b, (y, i) -> if(i = x.e AND b[x.s].score + x.score > y.score,
            named_struct('score', b[x.s].score + x.score, 'prev', x.s, 'id', x.id), y)))"""
    path = """aggregate(sequence(length(word), 1, -1),
        named_struct('at', length(word), 'steps', CAST(array() AS array<struct<s:int,id:int>>)),
        (p, i) -> if(i = p.at, named_struct('at', b[i].prev,
            'steps', array_prepend(p.steps, named_struct('s', b[i].prev, 'id', b[i].id))), p)).steps"""
    byte_ids = f"array({', '.join(map(str, pieces.byte_ids))})"
    ids = f"""flatten(transform(steps, x -> if(x.id >= 0, array(x.id),
        transform(sequence(1, length(hex(encode(substring(word, x.s + 1, 1), 'UTF-8'))), 2), k ->
            {byte_ids}[CAST(conv(substring(hex(encode(substring(word, x.s + 1, 1), 'UTF-8')), k, 2), 16, 10) AS INT)]))))"""
    folded = lattice.select("word", F.expr(best).alias("b")).select("word", F.expr(path).alias("steps"))
    return folded.select("word", F.expr(ids).alias("ids"))


def frequent_words(docs: DataFrame, most: int = FREQUENT_WORDS) -> DataFrame:
    """word, n of at most ``most`` words, among them all with more than total / most occurrences
    in their task (each task forgets rare words when its list is full)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for table in chunks(batches):
            for text in table["text"].to_pylist():
                if text:
                    seen.update(words_of(text))
            if len(seen) > 4 * most:
                least = sorted(seen.values(), reverse=True)[most]
                seen = Counter({w: n - least for w, n in seen.items() if n > least})
        top = seen.most_common(most)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["word", "n"]
        )

    counted = docs.select("text").mapInArrow(tidy(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = store(counted, "word-counts")
    total = counted.agg(F.sum("n")).first()[0] or 0
    # At most 8 * most words have more than their share: what one task sorts has a bound, whatever the number of partitions.
    return counted.where(F.col("n") > total // (8 * most)).orderBy(F.desc("n"), "word").limit(most)


# ---- array lattice --------------------------------------------------------------------------


def words_of(text: str) -> list[str]:
    """Words with their leading spaces; the text gets one space in front."""
    parts = (" " + text.replace("▁", " ")).split(" ")
    out, gap = [], ""
    for p in parts[1:]:
        gap += " "
        if p:
            out.append(gap + p)
            gap = ""
    if gap:
        out.append(gap)
    return out


class PieceLattice:
    """Best paths of many words at once; all words advance together, one byte at a time."""

    def __init__(self, pieces: PieceTable) -> None:
        self.unknown = pieces.unknown
        self.byte_ids = np.array(pieces.byte_ids, np.int32)
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        texts = [t.encode() for t in pieces.texts]
        for size in sorted({len(t) for t in texts}):
            pick = [k for k, t in enumerate(texts) if len(t) == size]
            data = np.frombuffer(b"".join(texts[k] for k in pick), np.uint8)
            at = np.arange(len(pick), dtype=np.int64) * size
            names = SpanHash(BYTE_NAMES[data])(at, at + size)
            order = np.argsort(names)
            seen = np.zeros(1 << 18, bool)
            seen[(names >> np.uint64(46)).astype(np.int64)] = True
            ids = np.array([pieces.ids[k] for k in pick], np.int32)[order]
            self.by_size[size] = names[order], ids, np.array([pieces.scores[k] for k in pick])[order], seen

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit numbers."""
        raw = [w.encode() for w in words]
        raw_size = np.array([len(r) for r in raw], np.int64)
        order = np.argsort(-raw_size, kind="stable")
        data = np.frombuffer(b"".join(raw[k] for k in order), np.uint8)
        size = raw_size[order]
        first = np.cumsum(size) - size
        n = len(data)
        spans = SpanHash(BYTE_NAMES[data])
        word_end = np.repeat(first + size, size)
        lead = (data & 0xC0) != 0x80
        # Edges by length: score and id for each start byte.
        edges: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length, (names, ids, scores, seen) in self.by_size.items():
            at = np.flatnonzero(lead & (np.arange(n) + length <= word_end))
            have = spans(at, at + length)
            some = seen[(have >> np.uint64(46)).astype(np.int64)]
            at, have = at[some], have[some]
            k = np.minimum(np.searchsorted(names, have), len(names) - 1)
            hit = names[k] == have
            if hit.any():
                score = np.full(n, -np.inf)
                which = np.full(n, -1, np.int32)
                score[at[hit]], which[at[hit]] = scores[k[hit]], ids[k[hit]]
                edges[length] = score, which
        char = np.ones(n, np.int64)
        starts = np.flatnonzero(lead)
        char[starts] = np.diff(np.append(starts, n))
        for length in np.unique(char[starts]).tolist():
            score, which = edges.setdefault(length, (np.full(n, -np.inf), np.full(n, -1, np.int32)))
            alone = lead & (char == length) & (which < 0)
            score[alone] = self.unknown
        # best[p]: best score of a path from the word's start to the end of byte p.
        best = np.full(n, -np.inf)
        back = np.zeros(n, np.int16)
        lengths = sorted(edges, reverse=True)
        steps = int(size[0]) if len(size) else 0
        alive = np.searchsorted(-size, -np.arange(1, steps + 1), side="right")
        for e in range(1, steps + 1):
            k = alive[e - 1]
            base = first[:k]
            top, how = np.full(k, -np.inf), np.zeros(k, np.int16)
            for length in lengths:
                if length > e:
                    continue
                s = base + (e - length)
                gain = edges[length][0][s]
                if length < e:
                    gain = gain + best[s - 1]
                better = gain > top
                top[better], how[better] = gain[better], length
            best[base + e - 1], back[base + e - 1] = top, how
        # Walk all words back together.
        out_pos, out_len, out_word = [], [], []
        at = first + size
        word = np.arange(len(size))
        alive_words = word[size > 0]
        while len(alive_words):
            end = at[alive_words]
            length = back[end - 1].astype(np.int64)
            at[alive_words] = end - length
            out_pos.append(end - length)
            out_len.append(length)
            out_word.append(alive_words)
            alive_words = alive_words[at[alive_words] > first[alive_words]]
        if not out_pos:
            return [b""] * len(words)
        pos, length, owner = np.concatenate(out_pos), np.concatenate(out_len), np.concatenate(out_word)
        by = np.argsort(pos, kind="stable")
        pos, length, owner = pos[by], length[by], owner[by]
        ids = np.full(len(pos), -1, np.int32)
        for k in np.unique(length).tolist():
            sel = length == k
            ids[sel] = edges[k][1][pos[sel]]
        n_out = np.where(ids < 0, length, 1)
        flat, src = ranges(np.zeros(len(pos), np.int64), n_out)
        values = np.where(ids[src] < 0, self.byte_ids[data[pos[src] + flat]], ids[src]).astype("<i4")
        counts = np.bincount(owner, n_out, len(words)).astype(np.int64)
        ends = np.cumsum(counts) * 4
        buffer = values.tobytes()
        result: list[bytes] = [b""] * len(words)
        for k, a, b in zip(order.tolist(), (ends - counts * 4).tolist(), ends.tolist()):
            result[k] = buffer[a:b]
        return result


class WordEncoder:
    """Ids of texts: known words from memory, new words of a chunk through one lattice."""

    def __init__(self, pieces: PieceTable, known: dict[str, bytes] | None = None) -> None:
        self.lattice = PieceLattice(pieces)
        self.known = known or {}
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.new) > CACHE_WORDS:
            self.old, self.new = self.new, {}
        cut = [words_of(t) if t else [] for t in texts]
        wanted = set().union(*cut) - self.new.keys()
        for source in (self.known, self.old):
            for w in wanted & source.keys():
                self.new[w] = source[w]
        missing = sorted(wanted - self.new.keys())
        self.new |= zip(missing, self.lattice.encode(missing))
        get = self.new.__getitem__
        return [b"".join(map(get, words)) for words in cut]


def decoder(pieces: PieceTable) -> list[bytes]:
    """Bytes of each id."""
    size = max([*pieces.ids, *pieces.byte_ids, *pieces.controls, 0]) + 1
    out = [b""] * size
    for i, t in zip(pieces.ids, pieces.texts):
        out[i] = t.encode()
    for b, i in enumerate(pieces.byte_ids):
        out[i] = bytes([b])
    return out


def decode_ids(table: list[bytes], ids: np.ndarray) -> str:
    """The text of ids, without the one space that encoding put in front."""
    text = b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


# ---- documents ------------------------------------------------------------------------------


def relational_vocabulary(docs: DataFrame, pieces: PieceTable, most: int = FREQUENT_WORDS) -> dict[str, bytes]:
    """Encodings of at most ``most`` frequent words, made by the relational lattice."""
    words = store(frequent_words(docs, most), "frequent-words")
    spread = words.select("word").where(F.length("word") <= 64).repartition("word")
    got = encode_words(spread, pieces).toArrow()
    ids = got["ids"].combine_chunks()
    flat, ends = ids.values.to_numpy(zero_copy_only=False).astype("<i4"), ids.offsets.to_numpy()
    return {w: flat[a:b].tobytes() for w, a, b in zip(got["word"].to_pylist(), ends.tolist(), ends[1:].tolist())}


class Vocabulary:
    """Encodings of frequent words, and what a worker builds from them. Spark drops a broadcast value from its workers when
    another job's tasks come, so none of this stays in them beyond its job."""

    def __init__(self, known: dict[str, bytes]) -> None:
        self.known = known
        self.built: tuple[WordEncoder, list[bytes]] | None = None

    def coders(self, model: str) -> tuple[WordEncoder, list[bytes]]:
        if self.built is None:
            pieces = PieceTable.load(model)
            self.built = WordEncoder(pieces, self.known), decoder(pieces)
        return self.built


def encode_documents(docs: DataFrame, model: str, most: int = FREQUENT_WORDS, with_ids: bool = True) -> DataFrame:
    """doc_id, n_chars, n_pieces, ids_crc32 (little-endian 32-bit ids), round_trip, and the ids."""
    spark: SparkSession = docs.sparkSession
    pieces = PieceTable.load(model)
    known = spark.sparkContext.broadcast(Vocabulary(relational_vocabulary(docs, pieces, most) if most else {}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = known.value.coders(model)
        for chunk in chunks(batches):
            texts = chunk["text"].to_pylist()
            coded = encoder.encode(texts)
            arrays = [np.frombuffer(c, "<i4") for c in coded]
            same = [decode_ids(table, a) == (t or "").replace("▁", " ") for a, t in zip(arrays, texts)]
            columns = [
                chunk["doc_id"].combine_chunks(), pa.array([len(t or "") for t in texts], pa.int64()),
                pa.array([len(a) for a in arrays], pa.int64()), pa.array([zlib.crc32(c) for c in coded], pa.int64()),
                pa.array(same),
            ]
            names = ["doc_id", "n_chars", "n_pieces", "ids_crc32", "round_trip"]
            if with_ids:
                columns.append(pa.array(arrays, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_chars long, n_pieces long, ids_crc32 long, round_trip boolean" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), schema)


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, text of encoded documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoder(PieceTable.load(model))
        for batch in batches:
            texts = [decode_ids(table, np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
