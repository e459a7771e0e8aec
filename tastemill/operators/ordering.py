"""Row positions and per-group top-k that never gather a table or a hot group in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemill.session import materialize

# Up to this many rows a plain ORDER BY .. LIMIT is cheaper than indexing the table.
SMALL_LIMIT = 10_000
_LOW_BITS = (1 << 33) - 1


def _range_sorted(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Range-partition and sort by ``keys``, number the rows, and write the result once.

    Range bounds are sampled, so a second evaluation could cut elsewhere; writing the numbered
    rows fixes one cut. Ids are (partition << 33) + row, hence increasing in key order.
    """
    numbered = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    return materialize(numbered, "sorted").withColumn("_pid", F.shiftright("_pos", 33))


def with_global_index(df: DataFrame, keys: Sequence[str], name: str = "idx") -> DataFrame:
    """0-based position of each row in the order of ``keys``: one range shuffle, no global window."""
    rows = _range_sorted(df, [F.col(k) for k in keys])
    sizes = rows.groupBy("_pid").agg(F.count("*").alias("_n"))
    # One row per partition: bounded by the partition count, whatever the data size.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    return (
        rows.join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_before") + F.col("_pos").bitwiseAND(F.lit(_LOW_BITS)))
        .drop("_pid", "_pos", "_before")
    )


def with_group_running_total(
    df: DataFrame,
    group: Sequence[str],
    keys: Sequence[str],
    weight: str | None = None,
    name: str = "idx",
    total: str = "total",
) -> DataFrame:
    """Sum of ``weight`` over the earlier rows of the group, and over the whole group.

    Without a weight these are the 0-based position and the group size. Rows are ranged over
    (group, keys), so a hot group spreads over many partitions. Only the first and last group of
    a partition can continue elsewhere; their carried sums fit one small broadcast table.
    """
    group = list(group)
    rows = _range_sorted(df, [F.col(c) for c in [*group, *keys]])
    w = F.col(weight) if weight else F.lit(1).cast("bigint")
    rows = rows.withColumn("_w", w)
    edge = F.struct(*[F.col(c) for c in group])
    edges = (
        rows.groupBy("_pid")
        .agg(F.min_by(edge, F.col("_pos")).alias("a"), F.max_by(edge, F.col("_pos")).alias("b"))
        .select(F.explode(F.array("a", "b")).alias("g"))
        .select("g.*")
        .distinct()
    )
    pieces = (
        rows.join(F.broadcast(edges), group, "left_semi")
        .groupBy(*group, "_pid")
        .agg(F.sum("_w").alias("_piece"))
    )
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select(
        *group,
        "_pid",
        F.coalesce(F.sum("_piece").over(earlier), F.lit(0)).alias("_carry"),
        F.sum("_piece").over(Window.partitionBy(*group)).alias("_whole"),
    )
    local = Window.partitionBy("_pid", *group)
    upto = local.orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumn("_local", F.sum("_w").over(upto) - F.col("_w")).withColumn(
        "_local_total", F.sum("_w").over(local)
    )
    return (
        out.join(F.broadcast(carried), [*group, "_pid"], "left")
        .withColumn(name, F.col("_local") + F.coalesce("_carry", F.lit(0)))
        .withColumn(total, F.coalesce("_whole", "_local_total"))
        .drop("_pid", "_pos", "_w", "_local", "_local_total", "_carry", "_whole")
    )


def head_by_order(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in key order, without moving a large head through one task."""
    if n <= SMALL_LIMIT:
        return df.orderBy(*keys).limit(n)
    return with_global_index(df, keys, "_idx").where(F.col("_idx") < n).drop("_idx")


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """Best ``k`` rows per group; Spark cuts each map task to k rows per group before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def rank_values(
    df: DataFrame,
    value: str,
    picks: dict[str, Callable[[Column], Column]],
    group: Sequence[str] = (),
) -> DataFrame:
    """Values at given sorted positions per group: columns ``group.., n`` and one per pick.

    A pick maps the group's row count to a 0-based position. Values are counted first (map-side
    combine) and ranged over partitions; partition sums then tell which partitions hold a wanted
    position, and only their rows are ranked. Neither a group nor its values sit in one buffer.
    """
    keys = list(group) or ["_all"]
    src = df if group else df.withColumn("_all", F.lit(0))
    counted = (
        src.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.count("*").alias("_c"))
    )
    rows = _range_sorted(counted, [F.col(c) for c in [*keys, "_v"]])
    # One row per partition a group touches.
    pieces = rows.groupBy(*keys, "_pid").agg(F.sum("_c").alias("_piece"))
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_carry", F.coalesce(F.sum("_piece").over(earlier), F.lit(0)))
    pieces = pieces.withColumn("n", F.sum("_piece").over(Window.partitionBy(*keys)))
    at = {name: pick(F.col("n")) for name, pick in picks.items()}
    wanted = F.lit(False)
    for pos in at.values():
        wanted = wanted | ((F.col("_carry") <= pos) & (pos < F.col("_carry") + F.col("_piece")))
    near = rows.join(pieces.where(wanted), [*keys, "_pid"])
    upto = Window.partitionBy("_pid", *keys).orderBy("_pos")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = near.withColumn("_hi", F.col("_carry") + F.sum("_c").over(upto))
    near = near.withColumn("_lo", F.col("_hi") - F.col("_c"))
    out = near.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[
            F.max(F.when((F.col("_lo") <= pos) & (pos < F.col("_hi")), F.col("_v"))).alias(name)
            for name, pos in at.items()
        ],
    )
    return out.select(*group, "n", *picks)


def exact_percentiles(
    df: DataFrame, value: str, probabilities: Sequence[float], group: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated percentiles: rows ``(group.., p, value, n)``."""
    probs = [float(p) for p in probabilities]
    picks = {}
    for i, p in enumerate(probs):
        picks[f"_lo{i}"] = lambda n, p=p: F.floor(F.lit(p) * (n - 1))
        picks[f"_hi{i}"] = lambda n, p=p: F.ceil(F.lit(p) * (n - 1))
    found = rank_values(
        df.select(*group, F.col(value).cast("double").alias("_x")), "_x", picks, group
    )

    def point(i: int, p: float) -> Column:
        at = F.lit(p) * (F.col("n") - 1)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        return F.struct(F.lit(p).alias("p"), (lo + (hi - lo) * (at - F.floor(at))).alias("value"))

    points = F.explode(F.array(*[point(i, p) for i, p in enumerate(probs)])).alias("x")
    return found.select(*group, points, "n").select(*group, "x.p", "x.value", "n")
