"""Array-of-number expressions and vector aggregates, all evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-12


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once per row, also where the body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(as_double(a), as_double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x
    )


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(as_double(v), F.lit(0.0), lambda s, x: s + x * x))


def l2_normalize(v: Column, eps: float = EPS) -> Column:
    """Unit vector; a zero vector stays zero."""
    return let(
        as_double(v),
        lambda w: let(F.greatest(norm(w), F.lit(eps)), lambda n: F.transform(w, lambda x: x / n)),
    )


def cosine(a: Column, b: Column, eps: float = EPS) -> Column:
    return dot(a, b) / (F.greatest(norm(a), F.lit(eps)) * F.greatest(norm(b), F.lit(eps)))


def vector_sum(v: Column) -> Column:
    """Element-wise sum as an aggregate with map-side combine."""
    return vector_to_array(Summarizer.sum(array_to_vector(as_double(v))))


def zeros(dim: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), dim), lambda _: F.lit(0.0))


def weighted_means(
    df: DataFrame, keys: Sequence[str], vector: str, weight: Column, dim: int, name: str = "vector"
) -> DataFrame:
    """Weighted element-wise mean per group; zeros where the weights sum to 0."""
    scaled = let(weight, lambda w: F.transform(as_double(F.col(vector)), lambda x: x * w))
    sums = df.groupBy(*keys).agg(vector_sum(scaled).alias("_s"), F.sum(weight).alias("_w"))
    mean = F.transform("_s", lambda x: x / F.col("_w"))
    return sums.select(
        *keys, F.when(F.col("_w") != 0, mean).otherwise(zeros(F.lit(dim))).alias(name)
    )
