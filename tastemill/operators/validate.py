"""Schema checks and row-level cleaning of the three base tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tastemill.functions.events import (
    event_weight,
    normalize_timestamp,
    recency_weight,
)
from tastemill.functions.text import item_text
from tastemill.operators.ordering import head_by_order, with_global_index
from tastemill.schemas import (
    BATCH_EVENTS,
    DEFAULTS,
    INTERACTION_KEYS,
    TIMELINE,
    USERS,
    ITEMS,
    Settings,
)
from tastemill.session import materialize


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count of every column in one pass: rows ``(column, nulls)``."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.unpivot([], list(columns), "column", "nulls")


def validate_schema(df: DataFrame, columns: Sequence[str], required: Sequence[str], name: str) -> None:
    """Raise when a column is missing or a required one holds nulls."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name} missing required columns: {missing}")
    if not required:
        return
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first()
    fatal = [c for c in required if row[c]]
    if fatal:
        raise ValueError(f"{name} has null values in required columns: {fatal}")


def land(
    df: DataFrame,
    columns: Sequence[str],
    required: Sequence[str],
    name: str,
    shape: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    forbidden: dict[str, Column] | None = None,
) -> DataFrame:
    """``shape(df)`` written once to the scratch area, the source checked by the same pass.

    Nulls in required columns, and rows for which a ``forbidden`` condition holds (by the error's text), are counted while
    the rows go by; any of them raises. No row is read twice for the checks.
    """
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name} missing required columns: {missing}")
    forbidden = forbidden or {}
    seen = Observation()
    counts = [F.count_if(F.col(c).isNull()).alias(f"null:{c}") for c in required]
    counts += [F.count_if(condition).alias(f"bad:{text}") for text, condition in forbidden.items()]
    out = materialize(shape(df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)), name)
    try:
        got = seen.get
    except Py4JJavaError:  # Spark left the pass out, as it saw that there are no rows: counted by itself
        got = df.agg(*counts).first().asDict() if counts else {}
    fatal = [c for c in required if got.get(f"null:{c}")]
    if fatal:
        raise ValueError(f"{name} has null values in required columns: {fatal}")
    for text in forbidden:
        if got.get(f"bad:{text}"):
            raise ValueError(text)
    return out


def dedupe_interactions(df: DataFrame) -> DataFrame:
    return df.dropDuplicates(INTERACTION_KEYS)


def clean_interactions(df: DataFrame) -> DataFrame:
    """Project and cast the four columns, without filtering."""
    types = dict(df.dtypes)
    return df.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("item_id").cast("string").alias("item_id"),
        F.col("event_type").cast("string").alias("event_type"),
        normalize_timestamp("timestamp", types["timestamp"]).alias("timestamp"),
    )


def validate_interactions(
    df: DataFrame, drop_unknown: bool = True, check_nulls: bool = True
) -> DataFrame:
    """Known event types only (or an error), each (user, item, type, time) once.

    With a check the rows are written once, by the pass that makes it; without any the result is lazy.
    """
    known = F.coalesce(F.col("event_type").cast("string").isin(*BATCH_EVENTS), F.lit(False))

    def shape(rows: DataFrame) -> DataFrame:
        return dedupe_interactions(clean_interactions(rows).where(known))

    required = ["user_id", "item_id"] if check_nulls else []
    refused = {} if drop_unknown else {"interactions contain unsupported event types": ~known}
    if not required and not refused:
        validate_schema(df, INTERACTION_KEYS, [], "interactions")
        return shape(df)
    return land(df, INTERACTION_KEYS, required, "interactions", shape, refused)


def validate_items(df: DataFrame, check_nulls: bool = True) -> DataFrame:
    built = item_text(("title", "category", "tags"))

    def shape(rows: DataFrame) -> DataFrame:
        return rows.select(
            F.col("item_id").cast("string").alias("item_id"),
            "title",
            "category",
            "tags",
            F.coalesce("text_description", built).alias("text_description"),
        )

    if not check_nulls:
        validate_schema(df, ITEMS.names, [], "items")
        return shape(df)
    return land(df, ITEMS.names, ["item_id"], "items", shape)


def validate_users(df: DataFrame, order_by: Sequence[str], check_nulls: bool = True) -> DataFrame:
    """First row per user in ``order_by`` order; ``metadata`` is kept where present."""
    validate_schema(df, ["user_id"], [], "users")
    kept = [c for c in USERS.names if c in df.columns]
    row = F.struct(F.col("user_id").cast("string").alias("user_id"), *[F.col(c) for c in kept[1:]])
    first = F.min_by(row, F.struct(*[F.col(c) for c in order_by]))

    def shape(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("user_id").cast("string").alias("_u")).agg(first.alias("r")).select("r.*")

    return land(df, ["user_id"], ["user_id"], "users", shape) if check_nulls else shape(df)


def apply_event_weights(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return df.withColumn("weight", event_weight("event_type", settings.event_weights))


def apply_recency(
    df: DataFrame, settings: Settings = DEFAULTS, reference=None, name: str = "recency"
) -> DataFrame:
    """Recency weight per row; the reference time defaults to the newest row."""
    knobs = (settings.recency_lambda, settings.recency_unit, settings.recency_max_age_days)
    if reference is not None:
        return df.withColumn(name, recency_weight("timestamp", F.lit(reference), *knobs))
    newest = df.agg(F.max("timestamp")).scalar()
    return df.withColumn(name, recency_weight("timestamp", newest, *knobs))


def filter_low_activity_users(df: DataFrame, min_interactions: int) -> DataFrame:
    active = (
        df.groupBy("user_id").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_interactions)
    )
    return df.join(active.select("user_id"), "user_id", "left_semi")


def strided_positions(index, n: int, m: int):
    """Whether 0-based ``index`` is one of ``m`` evenly spaced positions out of ``n``."""
    if m == 1:
        return index == 0
    near = F.rint(index * F.lit(float(m - 1)) / F.lit(float(n - 1)))
    step = (n - 1) / (m - 1)
    hit = F.lit(False)
    for d in (-1, 0, 1):
        j = near + F.lit(float(d))
        hit = hit | (
            (j >= 0) & (j <= F.lit(float(m - 1))) & (F.rint(j * F.lit(step)) == index)
        )
    return hit


def trim_to_max_rows(
    df: DataFrame, max_rows: int | None, mode: str = "strided", keys: Sequence[str] = TIMELINE
) -> DataFrame:
    """Cap a table along its timeline: evenly spaced rows, or the head."""
    if mode not in ("head", "strided"):
        raise ValueError(f"unsupported trim mode {mode!r}; use 'head' or 'strided'")
    n = df.count() if max_rows is not None else 0
    if max_rows is None or n <= max_rows:
        return df
    if mode == "head":
        return head_by_order(df, keys, max_rows)
    indexed = with_global_index(df, keys, "_idx")
    return indexed.where(strided_positions(F.col("_idx"), n, max_rows)).drop("_idx")
