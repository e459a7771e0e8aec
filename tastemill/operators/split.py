"""Time-based train / validation / test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemill.operators.ordering import with_global_index, with_group_running_total
from tastemill.schemas import DEFAULTS, TIMELINE

SPLITS = ("train", "validation", "test")


def check_ratios(ratios: Sequence[float]) -> None:
    if abs(sum(ratios) - 1.0) > 1e-6:
        raise ValueError(f"split ratios must sum to 1, got {tuple(ratios)}")


def split_time_global(
    df: DataFrame,
    ratios: Sequence[float] = DEFAULTS.split_ratios,
    keys: Sequence[str] = TIMELINE,
    time_column: str = "timestamp",
) -> DataFrame:
    """Positional split of the timeline, as a ``split`` column.

    An hourly histogram finds the hours the two cut positions fall in. Every other row is decided
    by its time alone, so only the rows of those two hours are ordered exactly; the table itself
    is never shuffled or sorted.
    """
    check_ratios(ratios)
    hour = F.date_trunc("hour", F.col(time_column))
    hist = df.groupBy(hour.alias("h")).agg(F.count("*").alias("c"))
    # One row per hour of history: a bounded table.
    upto = Window.orderBy(F.col("h").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    hist = (
        hist.withColumn("hi", F.sum("c").over(upto))
        .withColumn("lo", F.col("hi") - F.col("c"))
        .withColumn("n", F.sum("c").over(everything))
        .withColumn("cut1", F.floor(F.col("n") * F.lit(float(ratios[0]))))
        .withColumn("cut2", F.col("cut1") + F.floor(F.col("n") * F.lit(float(ratios[1]))))
    )
    found = hist.where(
        "(lo <= cut1 AND cut1 < hi) OR (lo <= cut2 AND cut2 < hi)"
    ).collect()  # the two cut hours at most
    cut1 = cut2 = None
    at = {}
    for row in found:
        cut1, cut2 = row["cut1"], row["cut2"]
        at.update({cut: row for cut in (cut1, cut2) if row["lo"] <= cut < row["hi"]})
    by_hour = F.lit("train")
    for cut, name in ((cut1, "validation"), (cut2, "test")):
        if cut in at:
            start = at[cut]["h"]
            later = F.lit(True) if start is None else (hour >= F.lit(start)) | hour.isNull()
            by_hour = F.when(later, name).otherwise(by_hour)
    hours = [r["h"] for r in at.values()]
    if not hours:
        return df.withColumn("split", by_hour)
    on_cut = F.lit(False)
    for h in hours:
        on_cut = on_cut | (hour.isNull() if h is None else F.coalesce(hour == F.lit(h), F.lit(False)))
    clear = df.where(~on_cut).withColumn("split", by_hour)
    # Position inside the cut hours, moved to the position in the whole timeline.
    edge = with_global_index(df.where(on_cut), keys, "_idx")
    seen, base = 0, F.lit(0).cast("bigint")
    for r in sorted({(r["lo"], r["hi"], r["h"]) for r in at.values()}, key=lambda r: r[0]):
        lo, hi, _ = r
        base = F.when(F.col("_idx") >= seen, F.lit(lo - seen)).otherwise(base)
        seen += hi - lo
    where = F.col("_idx") + base
    exact = edge.withColumn(
        "split", F.when(where < cut1, "train").when(where < cut2, "validation").otherwise("test")
    ).drop("_idx")
    return clear.unionByName(exact)


def split_per_user(
    df: DataFrame,
    min_history: int = 2,
    ratios: Sequence[float] = DEFAULTS.split_ratios,
    keys: Sequence[str] = TIMELINE,
) -> DataFrame:
    """Per-user positional split; users below ``min_history`` rows stay in train."""
    own = [k for k in keys if k != "user_id"]
    rows = with_group_running_total(df, ["user_id"], own, name="_i", total="_n")
    t_end = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(float(ratios[0]))))
    v_end = t_end + F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(float(ratios[1]))))
    part = (
        F.when((F.col("_n") < min_history) | (F.col("_i") < t_end), "train")
        .when(F.col("_i") < v_end, "validation")
        .otherwise("test")
    )
    return rows.withColumn("split", part).drop("_i", "_n")


def split_thresholds(
    split: DataFrame, ratios: Sequence[float] = DEFAULTS.split_ratios
) -> DataFrame:
    """Newest time per split next to its ratio."""
    share = F.create_map(*[F.lit(x) for kv in zip(SPLITS, map(float, ratios)) for x in kv])
    return (
        split.groupBy("split")
        .agg(F.max("timestamp").alias("max_time"))
        .withColumn("ratio", F.try_element_at(share, F.col("split")))
    )


def split_summary(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.count_distinct("user_id").alias("users"),
        F.min("timestamp").alias("min_time"),
        F.max("timestamp").alias("max_time"),
    )
