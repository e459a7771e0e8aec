"""Distribution drift between a reference table and a current table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemill.operators.ordering import exact_percentiles
from tastemill.session import materialize

FLOOR = 1e-6
ALERT = 0.1
#: Size parameter of quantile sketches, and the rank error it stands for in 99 of 100 cases.
KLL_K = 1600
_DELTAS = "array<struct<category:string,delta:double>>"
RANK_ERROR = 0.0025


def unpivot_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form ``(feature, value)`` of the non-null values of the numeric columns."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "value"
    ).where(F.col("value").isNotNull())


def _grid(lo: Column, hi: Column, bins: int) -> Column:
    step = (hi - lo) / F.lit(float(bins))
    return F.transform(
        F.sequence(F.lit(0), F.lit(bins)),
        lambda i: F.when(i == bins, hi).otherwise(lo + step * i),
    )


def quantile_edges(
    reference: DataFrame, features: Sequence[str], bins: int = 10, approximate: bool = False
) -> DataFrame:
    """Bin edges per feature of a long ``(feature, value)`` table: rows ``(feature, edges)``.

    Distinct linear percentiles of the reference; a constant feature gets a grid one unit either
    side, an empty one the grid over [0, 1]. ``approximate`` trades exact ranks for a quantile
    sketch that needs no sort.
    """
    if approximate:
        return edges_of_sketches(sketch_values(reference), features, bins)
    probs = [i / bins for i in range(bins + 1)]
    ranks = (
        exact_percentiles(reference, "value", probs, ["feature"])
        .groupBy("feature")
        .agg(F.array_sort(F.collect_list("value")).alias("e"))  # bins + 1 entries
    )
    return _edges(ranks, features, bins)


def _edges(ranks: DataFrame, features: Sequence[str], bins: int) -> DataFrame:
    """Edges of every feature from its percentiles ``e``."""
    e = F.col("e")
    edges = (
        F.when(e.isNull(), _grid(F.lit(0.0), F.lit(1.0), bins))
        .when(e[0] == F.element_at(e, -1), _grid(e[0] - 1.0, e[0] + 1.0, bins))
        .otherwise(F.array_distinct(e))
    )
    names = _features(ranks.sparkSession, features)
    return names.join(ranks, "feature", "left").select("feature", edges.alias("edges"))


def sketch_values(values: DataFrame, by: Sequence[str] = (), k: int = KLL_K) -> DataFrame:
    """A mergeable quantile sketch of each feature: rows ``(by.., feature, n, sketch)``, a few kilobytes each.

    Ranks read from it are off by more than ``RANK_ERROR`` of all values in about one case of a hundred.
    """
    values = values.where(~F.isnan("value"))
    return values.groupBy(*by, "feature").agg(
        F.count("*").alias("n"), F.expr(f"kll_sketch_agg_double(value, {k})").alias("sketch")
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (), k: int = KLL_K) -> DataFrame:
    """Sketches of several tables, days or batches as those of all their values: no value is read again."""
    return sketches.groupBy(*by, "feature").agg(
        F.sum("n").alias("n"), F.expr(f"kll_merge_agg_double(sketch, {k})").alias("sketch")
    )


def edges_of_sketches(sketches: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """Bin edges per feature as ``quantile_edges`` gives them, from sketches alone."""
    probs = F.array(*[F.lit(i / bins) for i in range(bins + 1)])
    ranks = sketches.select("feature", F.call_function("kll_sketch_get_quantile_double", "sketch", probs).alias("e"))
    return _edges(ranks, features, bins)


def shares_of_sketches(sketches: DataFrame, edges: DataFrame) -> DataFrame:
    """``(feature, bin, p)`` of right-open bins (the last one closed), from the ranks of the edges in the sketches."""
    # The points of a sketch's ranks have to be constants: one row per feature comes to the driver.
    points = {r["feature"]: list(r["edges"]) for r in edges.collect()}

    def ranks_of(shift) -> Column:
        found = [
            F.when(F.col("feature") == f, F.call_function("kll_sketch_get_rank_double", "sketch", F.array(*[F.lit(shift(x)) for x in e])))
            for f, e in points.items()
        ]
        return F.coalesce(*found) if found else F.lit(None).cast("array<double>")

    # A sketch counts values up to a point; those below an edge are counted up to the double before it.
    ranks = sketches.select(
        "feature", ranks_of(lambda x: math.nextafter(x, -math.inf)).alias("lo"), F.element_at(ranks_of(float), -1).alias("top")
    ).where(F.col("lo").isNotNull())
    n = F.size("lo") - 1
    cut = F.concat(F.slice("lo", 1, n), F.array("top"))
    inside = F.greatest(F.col("top") - F.col("lo")[0], F.lit(0.0))
    rows = ranks.withColumn("inside", inside).withColumn("bin", F.explode(F.sequence(F.lit(1), n))).withColumn("cut", cut)
    part = (F.get("cut", F.col("bin")) - F.get("cut", F.col("bin") - 1)) / F.when(F.col("inside") > 0, F.col("inside")).otherwise(1.0)
    rows = rows.select("feature", "bin", F.greatest(F.lit(FLOOR), part).alias("_p"))
    whole = F.sum("_p").over(Window.partitionBy("feature"))  # at most `bins` rows
    return rows.select("feature", "bin", (F.col("_p") / whole).alias("p"))


def psi_of_sketches(actual: DataFrame, expected: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """Population stability index per feature of two tables of sketches; neither side's values are read."""
    edges = edges_of_sketches(expected, features, bins)
    return psi_from_shares(shares_of_sketches(actual, edges), shares_of_sketches(expected, edges), edges)


def _features(spark, names: Sequence[str]) -> DataFrame:
    """One row per feature name."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("feature"))


def bin_proportions(
    values: DataFrame, edges: DataFrame, by: Sequence[str] = (), most: int | None = None
) -> DataFrame:
    """Share of each bin per feature: rows ``(by.., feature, bin, n, p, outside)``.

    Bins are right-open but the last; values outside the edges are left out of the shares and
    counted in ``outside``. Shares are floored and scaled to sum to 1. Features may have any
    number of bins; ``most`` is a bound of their edges, by default read from ``edges``, which has one row per feature.
    """
    if most is None:
        most = edges.agg(F.max(F.size("edges"))).first()[0] or 0
    keys = [*by, "feature"]
    e, v = F.col("edges"), F.col("value")
    n_bins = F.size(e) - 1
    # Plain comparisons instead of a lambda over the edges: they compile.
    at = F.lit(0)
    for i in range(most):
        at = at + F.when(F.get(e, F.lit(i)) <= v, 1).otherwise(0)
    inside = (v >= F.get(e, F.lit(0))) & (v <= F.get(e, n_bins))
    counted = (
        values.join(F.broadcast(edges), "feature")  # one row per feature
        .groupBy(*keys, F.when(inside, F.least(at, n_bins)).otherwise(F.lit(0)).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    totals = counted.groupBy(*keys).agg(
        F.sum(F.when(F.col("bin") > 0, F.col("n")).otherwise(0)).alias("inside"),
        F.sum(F.when(F.col("bin") == 0, F.col("n")).otherwise(0)).alias("outside"),
    )
    empty = edges.select("feature", F.explode(F.sequence(F.lit(1), n_bins)).alias("bin"))
    shares = (
        totals.join(empty, "feature")
        .join(counted, [*keys, "bin"], "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn(
            "_p", F.greatest(F.lit(FLOOR), F.col("n") / F.greatest(F.col("inside"), F.lit(1)))
        )
    )
    # At most `bins` rows per feature and side.
    whole = F.sum("_p").over(Window.partitionBy(*keys))
    return shares.select(*keys, "bin", "n", (F.col("_p") / whole).alias("p"), "outside")


def psi_long(
    actual: DataFrame,
    expected: DataFrame,
    features: Sequence[str],
    bins: int = 10,
    approximate: bool = False,
) -> DataFrame:
    """Population stability index per feature of two long ``(feature, value)`` tables.

    ``approximate`` sketches each side in one pass and compares the sketches.
    """
    if approximate:
        return psi_of_sketches(sketch_values(actual), materialize(sketch_values(expected), "sketches"), features, bins)
    edges = materialize(quantile_edges(expected, features, bins), "edges")
    return psi_from_edges(actual, expected, edges, bins + 1)


def psi_from_edges(actual: DataFrame, expected: DataFrame, edges: DataFrame, most: int | None = None) -> DataFrame:
    """Index per feature over given edges; a side without values gives 0."""
    tagged = actual.select("feature", "value", F.lit("a").alias("side")).unionByName(
        expected.select("feature", "value", F.lit("e").alias("side"))
    )
    shares = bin_proportions(tagged, edges, ["side"], most)
    side = {s: shares.where(F.col("side") == s).drop("side") for s in "ae"}
    return psi_from_shares(side["a"], side["e"], edges)


def psi_from_shares(actual: DataFrame, expected: DataFrame, edges: DataFrame) -> DataFrame:
    """Index per feature of two tables of bin shares ``(feature, bin, p)``; 0 where one is absent."""
    both = actual.select("feature", "bin", F.col("p").alias("a")).join(
        expected.select("feature", "bin", F.col("p").alias("e")), ["feature", "bin"]
    )
    term = (F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))
    scores = both.groupBy("feature").agg(F.sum(term).alias("psi"))
    return edges.select("feature").join(scores, "feature", "left").fillna(0.0, ["psi"])


def psi(
    actual: DataFrame, expected: DataFrame, column: str, bins: int = 10, approximate: bool = False
) -> DataFrame:
    return psi_long(
        unpivot_numeric(actual, [column]),
        unpivot_numeric(expected, [column]),
        [column],
        bins,
        approximate,
    )


def kl_divergence(
    reference: DataFrame, current: DataFrame, column: str, bins: int = 10, approximate: bool = False
) -> DataFrame:
    """Symmetrised (Jeffreys) divergence: the stability index with swapped arguments."""
    return psi(current, reference, column, bins, approximate).withColumnRenamed("psi", "kl")


def _shares(df: DataFrame, column: str, top: int, name: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("category")).agg(
        F.count("*").alias("c")
    )
    total = counts.agg(F.sum("c")).scalar()
    return (
        counts.withColumn(name, F.col("c") / total)
        .orderBy(F.desc("c"), "category")
        .limit(top)
        .select("category", name)
    )


def category_deltas(reference: DataFrame, current: DataFrame, column: str, top: int = 20) -> DataFrame:
    """Share change of each of the most frequent categories on either side."""
    both = _shares(reference, column, top, "ref").join(
        _shares(current, column, top, "cur"), "category", "full"
    )
    both = both.fillna(0.0, ["ref", "cur"])
    return both.withColumn("delta", F.round(F.col("cur") - F.col("ref"), 4))


def categorical_shift(reference: DataFrame, current: DataFrame, column: str, top: int = 20) -> DataFrame:
    """Smoothed divergence of the category shares, one row."""
    return shift_of_deltas(category_deltas(reference, current, column, top))


def shift_of_deltas(d: DataFrame) -> DataFrame:
    r, c = F.col("ref") + FLOOR, F.col("cur") + FLOOR
    sums = d.agg(F.sum(r).alias("sr"), F.sum(c).alias("sc"), F.collect_list(F.struct(r.alias("r"), c.alias("c"))).alias("l"))

    def term(x: Column) -> Column:
        a, b = x["r"] / F.col("sr"), x["c"] / F.col("sc")
        return (a - b) * F.log(a / b)

    return sums.select(
        F.aggregate(F.array_sort("l"), F.lit(0.0), lambda s, x: s + term(x)).alias("score")
    )  # at most 2 * top entries


def detect_drift(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    bins: int = 10,
    top: int = 20,
    approximate: bool = False,
) -> DataFrame:
    """One row per feature: numeric ones with an alert above the threshold, categorical scores.

    ``deltas`` are the share changes of a categorical feature's categories, by category. Categories beyond the ``top`` of either side don't count. Without a feature on both sides the
    report is empty. ``approximate`` takes bin edges from a quantile sketch.
    """
    parts = []
    numeric = [c for c in numeric if c in reference.columns and c in current.columns]
    if numeric:
        scores = psi_long(
            unpivot_numeric(current, numeric),
            unpivot_numeric(reference, numeric),
            numeric,
            bins,
            approximate,
        )
        parts.append(
            scores.select(
                "feature",
                F.lit("numeric").alias("kind"),
                F.col("psi").alias("score"),
                (F.col("psi") > ALERT).alias("alert"),
                F.lit(None).cast(_DELTAS).alias("deltas"),
            )
        )
    for c in categorical:
        if c in reference.columns and c in current.columns:
            shares = materialize(category_deltas(reference, current, c, top), "deltas")  # at most 2 * top rows
            deltas = shares.agg(F.array_sort(F.collect_list(F.struct("category", "delta"))).alias("d"))
            parts.append(
                shift_of_deltas(shares).select(
                    F.lit(c).alias("feature"),
                    F.lit("categorical").alias("kind"),
                    "score",
                    F.lit(None).cast("boolean").alias("alert"),
                    deltas.scalar().cast(_DELTAS).alias("deltas"),
                )
            )
    if not parts:
        report = f"feature string, kind string, score double, alert boolean, deltas {_DELTAS}"
        return reference.sparkSession.createDataFrame([], report)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
