"""Embedding near-dedup by NN-descent.

Equal vectors are one class (least vec_id). A neighbour graph over the classes starts from sorted
hyperplane signs and is refined by local joins: the neighbours (and reverse neighbours) of a node
are compared with each other, and pairs better than a node's worst neighbour go into its list.
Lists rank by vectors rounded to 8 bits; every link is decided by the cosine in double precision.
A list whose worst neighbour is still a link is saturated: its whole component is dense and compared
block by block with itself, with all other dense components and with all other nodes, less the
blocks whose angles rule out a link; only counts and merged components leave the tasks. Links among
the other nodes come from the lists. Their recall is audited against brute force over a
sample that holds enough true links; while it is below the target, the graph gets twice as many more
start tables, and after the last attempt all pairs of these nodes are compared in blocks.

Defined cases: null, empty or zero vectors and such with null or non-finite components link with
nothing; vectors of different lengths never link; repeated rows of one vec_id count as vectors of
their own; extra columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemill.llm import graph
from tastemill.llm.common import partitions, store

LIST = 8
TABLES = 4
ROUNDS = 3
BLOCK = 256
#: How far an 8-bit cosine may be off; pairs above the threshold less this are decided exactly.
SLACK = 0.03
AUDIT_ROWS = 1_000
AUDIT_RECALL = 0.98
#: So many true links a sample holds at least before its share counts.
AUDIT_LINKS = 100


def valid_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, v (array<double>) of the usable vectors."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(fine & some)


def vector_classes(vectors: DataFrame) -> DataFrame:
    """node (least vec_id of equal vectors), size, dim, x (raw doubles), q (rounded unit vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, rounded = [], []
            for v in batch.column("v"):
                x = np.asarray(v.values, np.float64)
                top = np.abs(x).max()
                u = x / top
                u /= np.sqrt(u @ u)
                raw.append(x.astype("<f8").tobytes())
                rounded.append(np.clip(np.round(u * 127), -127, 127).astype(np.int8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(raw, pa.binary()), pa.array(rounded, pa.binary())], ["vec_id", "x", "q"]
            )

    packed = vectors.mapInArrow(run, "vec_id long, x binary, q binary")
    classes = packed.groupBy("x").agg(F.min("vec_id").alias("node"), F.count("*").alias("size"), F.first("q").alias("q"))
    return classes.select("node", "size", (F.length("x") / 8).cast("int").alias("dim"), "x", "q")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(-1, dim).astype(np.float32) / np.float32(127)


def start_lists(nodes: DataFrame, tables: range, k: int) -> DataFrame:
    """node, nbr, sim from windows over nodes sorted by the signs of random projections."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                m = _matrix(rows.column("q"), int(dim))
                for t in tables:
                    planes = np.random.default_rng([t, int(dim)]).standard_normal((int(dim), 62)).astype(np.float32)
                    bits = (m @ planes > 0).astype(np.int64)
                    key = (bits << np.arange(62)).sum(1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(m), t * 100_000 + dim), pa.int64()), pa.array(key), rows.column("node"), rows.column("q")],
                        ["part", "key", "node", "q"],
                    )

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            while held.num_rows >= BLOCK:
                yield from window(held.slice(0, BLOCK))
                held = held.slice(BLOCK // 2)
        if held is not None and held.num_rows > 1:
            yield from window(held)

    def window(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        part = rows["part"].to_numpy()
        for p in np.unique(part):
            own = rows.filter(pa.array(part == p))
            if own.num_rows > 1:
                m = _matrix(own["q"].combine_chunks(), int(p % 100_000))
                yield _best(own["node"].to_numpy(), m, np.full(len(m), -2, np.float32), None, k)

    n = partitions(nodes.sparkSession)
    signs = nodes.mapInArrow(sign, "part long, key long, node long, q binary")
    ordered = signs.repartitionByRange(n, "part", "key", "node").sortWithinPartitions("part", "key", "node")
    return ordered.mapInArrow(near, "node long, nbr long, sim float")


def _best(ids: np.ndarray, m: np.ndarray, worst: np.ndarray, fresh: np.ndarray | None, k: int) -> pa.RecordBatch:
    """The k best partners of each row above its bound; without a fresh side a pair is known."""
    sims = m @ m.T
    sims[ids[:, None] == ids[None, :]] = -2
    if fresh is not None:
        sims[~(fresh[:, None] | fresh[None, :])] = -2
    sims[sims <= worst[:, None]] = -2
    k = min(k, len(ids))
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    value = np.take_along_axis(sims, top, 1)
    i, j = np.nonzero(value > -1.5)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[i]), pa.array(ids[top[i, j]]), pa.array(value[i, j].astype(np.float32))], ["node", "nbr", "sim"]
    )


def keep_best(rows: DataFrame, k: int) -> DataFrame:
    """The k best neighbours of each node; a neighbour that was not there before is fresh."""
    one = rows.groupBy("node", "nbr").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    w = Window.partitionBy("node").orderBy(F.desc("sim"), "nbr")
    return one.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k).drop("n")


def refine(lists: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """One round: neighbours of a common node are compared with each other."""
    bound = lists.groupBy("node").agg(F.min("sim").alias("low"), F.count("*").alias("have"))
    known = nodes.select("node", "q", "dim").join(
        bound.select("node", F.when(F.col("have") >= k, F.col("low")).otherwise(-1.0).cast("float").alias("worst")), "node"
    )
    fan = lists.select(F.col("node").alias("mid"), F.col("nbr").alias("node"), "fresh").unionAll(
        lists.select(F.col("nbr").alias("mid"), "node", "fresh")
    )
    fan = fan.groupBy("mid", "node").agg(F.max("fresh").alias("fresh"))
    rows = fan.join(known, "node").select("mid", "node", "fresh", "q", "dim", "worst")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            mid = held["mid"].to_numpy()
            cuts = np.flatnonzero(np.append(True, mid[1:] != mid[:-1])) if len(mid) else np.zeros(0, int)
            yield from groups(held, cuts[:-1], cuts[1:])
            if len(cuts):
                held = held.slice(int(cuts[-1]))
                while held.num_rows >= 2 * BLOCK:  # a node with many reverse neighbours: in blocks
                    yield from groups(held.slice(0, BLOCK), np.array([0]), np.array([BLOCK]))
                    held = held.slice(BLOCK)
        if held is not None and held.num_rows > 1:
            yield from groups(held, np.array([0]), np.array([held.num_rows]))

    def groups(table: pa.Table, start: np.ndarray, stop: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(start):
            return
        table = table.combine_chunks()
        ids, fresh = table["node"].to_numpy(), table["fresh"].to_numpy(zero_copy_only=False).astype(bool)
        worst, dims = table["worst"].to_numpy(), table["dim"].to_numpy()
        q = table["q"].combine_chunks()
        out = []
        for a, b in zip(start.tolist(), stop.tolist()):
            if b - a > 1 and fresh[a:b].any() and (dims[a:b] == dims[a]).all():
                got = _best(ids[a:b], _matrix(q.slice(a, b - a), int(dims[a])), worst[a:b], fresh[a:b], k)
                if got.num_rows:
                    out.append(got)
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    n = partitions(lists.sparkSession)
    found = rows.repartition(n, "mid").sortWithinPartitions("mid").mapInArrow(run, "node long, nbr long, sim float")
    old = lists.withColumn("fresh", F.lit(False))
    return keep_best(old.unionAll(found.withColumn("fresh", F.lit(True))), k)


def exact_links(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose cosine in double precision reaches the threshold."""
    x = nodes.select("node", "x")
    both = pairs.join(x.select(F.col("node").alias("a"), F.col("x").alias("x")), "a").join(
        x.select(F.col("node").alias("b"), F.col("x").alias("y")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                cosines(np.frombuffer(x)[None, :], np.frombuffer(y)[None, :])[0, 0] >= threshold
                for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest component near 1: squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x, y = _scaled(x), _scaled(y)
    return (x @ y.T) / np.outer(np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1)))


def all_links(some: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """a, b: every link of a node of ``some`` (part of ``nodes``) with one of ``nodes``, by all pairs of blocks."""
    none = nodes.sparkSession.createDataFrame([], "node long, component long")
    theirs = in_blocks(nodes, none).select(F.col("dim").alias("d"), F.col("rows").alias("theirs"))
    pairs = in_blocks(some, none).select("dim", F.col("rows").alias("mine")).crossJoin(theirs).where("d = dim")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, mine, theirs in zip(batch.column("dim").to_pylist(), batch.column("mine"), batch.column("theirs")):
                x, y = mine.values, theirs.values
                i, j = np.nonzero(cosines(_doubles(x.field("x"), dim), _doubles(y.field("x"), dim)) >= threshold)
                a, b = x.field("node").to_numpy()[i], y.field("node").to_numpy()[j]
                a, b = a[a != b], b[a != b]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    found = pairs.select("dim", "mine", "theirs").mapInArrow(run, "a long, b long")
    return store(found.distinct(), "true-links")


def audit(
    links: DataFrame, nodes: DataFrame, threshold: float, rows: int = AUDIT_ROWS, least: int = AUDIT_LINKS
) -> tuple[float, DataFrame | None]:
    """Share of the true links of a sample that ``links`` holds; all true links, if the sample became the whole.

    The sample has about ``rows`` nodes and grows until it holds ``least`` true links.
    """
    total = nodes.count()
    while True:
        share = min(1.0, rows / max(total, 1))
        place = F.pmod(F.xxhash64(F.lit("audit"), "node"), F.lit(1 << 30))
        true = all_links(nodes if share == 1 else nodes.where(place < int(share * (1 << 30))), nodes, threshold)
        n = true.count()
        if n >= least or share == 1:
            break
        rows *= 8
    hit = true.join(links.select("a", "b"), ["a", "b"], "left_semi").count()
    return (hit / n if n else 1.0), (true if share == 1 else None)


def in_blocks(nodes: DataFrame, inside: DataFrame) -> DataFrame:
    """id, component, dim, rows (node, size, x) of blocks of about BLOCK nodes, written.

    Members of a dense component share its blocks; the blocks of all other nodes have no component.
    """
    rows = nodes.join(inside, "node").select("component", "dim", "node", "size", "x")
    rest = nodes.join(inside, "node", "left_anti").select(F.lit(None).cast("long").alias("component"), "dim", "node", "size", "x")
    blocks = F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")
    dealt = rows.join(rows.groupBy("component").agg(blocks), "component").unionByName(
        rest.join(F.broadcast(rest.groupBy("dim").agg(blocks)), "dim")
    )
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    packed = dealt.groupBy("component", "dim", "block").agg(F.collect_list(F.struct("node", "size", "x")).alias("rows"))
    return store(packed.select(F.monotonically_increasing_id().alias("id"), "component", "dim", "rows"), "blocks")


def _doubles(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist())).reshape(-1, dim)


def _units(column: pa.Array, dim: int) -> np.ndarray:
    x = _doubles(column, dim)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def block_balls(blocks: DataFrame) -> DataFrame:
    """id, dim, dense, c, r: a centre and the largest angle to it of each dense block; each other node with angle 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, dense, dim, rows in zip(*(batch.column(c).to_pylist() for c in ("id", "dense", "dim")), batch.column("rows")):
                c = _units(rows.values.field("x"), dim)
                r = np.zeros(len(c))
                if dense:
                    mean = c.sum(0)
                    length = np.sqrt(mean @ mean)
                    mean = mean / length if length > 1e-9 else c[0]
                    c, r = mean[None, :], np.arccos(np.clip(c @ mean, -1, 1)).max(keepdims=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(c), key), pa.int64()), pa.array(np.full(len(c), dim), pa.int32()), pa.array([dense] * len(c)),
                        pa.array([v.tobytes() for v in c], pa.binary()), pa.array(r),
                    ],
                    ["id", "dim", "dense", "c", "r"],
                )

    return blocks.select("id", F.col("component").isNotNull().alias("dense"), "dim", "rows").mapInArrow(
        run, "id long, dim int, dense boolean, c binary, r double"
    )


def near_blocks(blocks: DataFrame, threshold: float) -> DataFrame:
    """id (a dense block), other (any block): pairs that the angles between their balls don't rule out.

    Two vectors can only link if the angle of their centres is at most that of the threshold and both
    radii. Balls are compared in sheets by all pairs; only ids leave the tasks.
    """
    balls = store(block_balls(blocks), "balls")
    sheets = F.broadcast(balls.groupBy("dim", "dense").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("sheets")))
    dealt = balls.join(sheets, ["dim", "dense"]).withColumn("sheet", F.pmod(F.xxhash64("c"), F.col("sheets")).cast("int"))
    packed = store(dealt.groupBy("dim", "dense", "sheet").agg(F.collect_list(F.struct("id", "c", "r")).alias("rows")), "sheets")
    left = packed.where("dense").select(F.col("dim").alias("d"), F.col("rows").alias("mine"))
    limit = float(np.arccos(np.clip(threshold, -1, 1))) + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, mine, theirs in zip(batch.column("dim").to_pylist(), batch.column("mine"), batch.column("rows")):
                a, b = mine.values, theirs.values
                angle = np.arccos(np.clip(_doubles(a.field("c"), dim) @ _doubles(b.field("c"), dim).T, -1, 1))
                i, j = np.nonzero(angle <= limit + a.field("r").to_numpy()[:, None] + b.field("r").to_numpy()[None, :])
                met = np.unique(np.stack([a.field("id").to_numpy()[i], b.field("id").to_numpy()[j]]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(met[0]), pa.array(met[1])], ["id", "other"])

    pairs = left.crossJoin(packed).where("d = dim").select("dim", "mine", "rows")
    return store(pairs.mapInArrow(run, "id long, other long").distinct(), "near-blocks")


def dense_counts(blocks: DataFrame, threshold: float) -> DataFrame:
    """node, n, meets: vectors linked to a node in one pair of blocks of which one is dense, and a
    component that the node is thereby linked to, if it is in another one or in none that is dense.

    Tasks hold two blocks and give one count a row.
    """
    n = partitions(blocks.sparkSession)
    pairs = near_blocks(blocks, threshold).repartition(n, "id", "other")
    left = blocks.select("id", "dim", "component", F.col("rows").alias("mine"))
    right = blocks.select(F.col("id").alias("other"), F.col("component").alias("their"), F.col("rows").alias("theirs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = (batch.column(c).to_pylist() for c in ("dim", "component", "their"))
            for dim, component, their, mine, theirs in zip(*known, batch.column("mine"), batch.column("theirs")):
                a, b = mine.values, theirs.values
                ids, others = a.field("node").to_numpy(), b.field("node").to_numpy()
                linked = cosines(_doubles(a.field("x"), dim), _doubles(b.field("x"), dim)) >= threshold
                linked &= ids[:, None] != others[None, :]
                yield some(ids, linked @ b.field("size").to_numpy(), None if their == component else their)
                if their is None:  # the other side's pair is not listed
                    yield some(others, linked.T @ a.field("size").to_numpy(), component)

    def some(ids: np.ndarray, count: np.ndarray, meets: int | None) -> pa.RecordBatch:
        ids, count = ids[count > 0], count[count > 0]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(count, pa.int64()), pa.array([meets] * len(ids), pa.int64())], ["node", "n", "meets"]
        )

    both = pairs.join(left, "id").join(right, "other").select("dim", "component", "their", "mine", "theirs")
    return store(both.mapInArrow(run, "node long, n long, meets long"), "dense")


def joined(member: DataFrame, counted: DataFrame) -> DataFrame:
    """component, top: the least node of what each component is part of, where that is another one."""
    met = counted.where("meets IS NOT NULL").select("node", "meets").distinct().join(member, "node", "left")
    met = met.select(F.coalesce("component", "node").alias("a"), F.col("meets").alias("b")).distinct()
    return graph.components(met).select(F.col("node").alias("component"), F.col("component").alias("top"))


def near_duplicates(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = 0.9, k: int = LIST, audits: int = 3
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``df``."""
    vectors = valid_vectors(df, vec_id, vector)
    nodes = store(vector_classes(vectors), "vector-classes")
    lists, links, tables = None, None, 0
    for attempt in range(audits):
        more = range(tables, tables + (TABLES << attempt))
        start = start_lists(nodes, more, k).withColumn("fresh", F.lit(True))
        tables = more.stop
        lists = store(keep_best(start if lists is None else lists.withColumn("fresh", F.lit(False)).unionAll(start), k), "lists")
        for _ in range(ROUNDS):
            lists = store(refine(lists, nodes, k), "lists")
        pairs = lists.where(F.col("sim") >= threshold - SLACK).select(F.least("node", "nbr").alias("a"), F.greatest("node", "nbr").alias("b")).distinct()
        links = store(exact_links(pairs, nodes, threshold), "vector-links")
        full = lists.groupBy("node").agg(F.count("*").alias("have"), F.min("sim").alias("low"))
        full = full.where((F.col("have") >= k) & (F.col("low") >= threshold - SLACK)).select("node")
        member = store(graph.components(links), "vector-components")
        dense = member.join(full, "node").select("component").distinct()
        # All links of a component with a saturated list are counted in full below: audit the others.
        open_nodes = nodes.join(member.join(dense, "component").select("node"), "node", "left_anti")
        recall, true = audit(links, open_nodes, threshold)
        if true is not None or recall >= AUDIT_RECALL:
            break
    if true is None and recall < AUDIT_RECALL:
        true = all_links(open_nodes, open_nodes, threshold)
    if true is not None:
        links = store(links.unionAll(true).distinct(), "vector-links")
        member = store(graph.components(links), "vector-components")
        dense = member.join(full, "node").select("component").distinct()
    inside = member.join(dense, "component").select("node", "component")
    counted = dense_counts(in_blocks(nodes, inside), threshold)
    both = links.select(F.col("a").alias("node"), F.col("b").alias("nbr")).unionAll(links.select(F.col("b").alias("node"), F.col("a").alias("nbr")))
    listed = (
        both.join(inside.select("node"), "node", "left_anti")
        .join(nodes.select(F.col("node").alias("nbr"), "size"), "nbr").select("node", F.col("size").alias("n"))
    )
    count = counted.select("node", "n").unionAll(listed).groupBy("node").agg(F.sum("n").alias("n"))
    per_node = nodes.select("node", "size", "x").join(count, "node", "left").join(member, "node", "left")
    per_node = per_node.withColumn("component", F.coalesce("component", "node")).join(joined(member, counted), "component", "left")
    per_node = per_node.select(
        "x", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("top", "component").alias("component_id")
    )
    pack = valid_vectors(df, vec_id, vector)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [np.asarray(v.values, np.float64).astype("<f8").tobytes() for v in batch.column("v")]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(x, pa.binary())], ["vec_id", "x"])

    known = pack.mapInArrow(raw, "vec_id long, x binary").join(per_node, "x").drop("x")
    fine = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = F.coalesce(
        F.forall(fine, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(fine, lambda x: x != 0),
        F.lit(False),
    ) & F.col(vec_id).isNotNull()
    rest = df.where(~usable).select(F.col(vec_id).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col(vec_id).cast("long").alias("component_id"))
    out = known.select("vec_id", "n_links", "component_id").unionAll(rest)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
