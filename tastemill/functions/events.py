"""Column expressions over interaction rows."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tastemill.schemas import EVENT_WEIGHTS, UNIT_SECONDS

# Epoch seconds of 3000-01-01: anything larger is taken as milliseconds.
_FAR_FUTURE_SECONDS = 32503680000

# Event words of free-form sources; any other word is a view.
EVENT_WORDS = {
    "purchase": "purchase",
    "buy": "purchase",
    "click": "click",
    "like": "like",
    "view": "view",
    "watch": "view",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])


def rating_to_event(rating: Column | str, threshold: float = 4.0, upper: float = 5.1) -> Column:
    """(-1, threshold] is a view, (threshold, upper] a like, anything else null."""
    r = _col(rating)
    return F.when((r > -1) & (r <= threshold), "view").when(
        (r > threshold) & (r <= upper), "like"
    )


def text_to_event(text: Column | str) -> Column:
    return F.coalesce(F.try_element_at(literal_map(EVENT_WORDS), F.lower(_col(text))), F.lit("view"))


def namespaced_id(prefix: str, raw: Column | str, numeric: bool = True) -> Column:
    """Prefix an id; numeric ids lose their leading zeros."""
    r = _col(raw)
    return F.concat(F.lit(prefix), (r.cast("bigint") if numeric else r).cast("string"))


def event_weight(event: Column | str, weights: dict | None = None) -> Column:
    table = literal_map({k: float(v) for k, v in (weights or EVENT_WEIGHTS).items()})
    return F.coalesce(F.try_element_at(table, _col(event)), F.lit(1.0))


def epoch_to_timestamp(epoch: Column | str) -> Column:
    """Integer epoch to UTC, deciding seconds or milliseconds row by row."""
    e = _col(epoch).cast("bigint")
    return F.when(e > _FAR_FUTURE_SECONDS, F.timestamp_millis(e)).otherwise(F.timestamp_seconds(e))


def normalize_timestamp(name: str, data_type: str) -> Column:
    """Coerce an epoch, string, date or zoneless timestamp column to a UTC timestamp."""
    c = F.col(name)
    if data_type in ("tinyint", "smallint", "int", "bigint"):
        return epoch_to_timestamp(c)
    return c.cast("timestamp")


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def recency_weight(
    ts: Column | str,
    reference: Column,
    lam: float = 0.035,
    unit: str = "days",
    max_age_days: float | None = 365.0,
) -> Column:
    """exp(-lam * age), the age in ``unit`` and clipped to [0, max_age_days]."""
    if unit not in UNIT_SECONDS:
        raise ValueError(f"unsupported recency unit {unit!r}; use one of {sorted(UNIT_SECONDS)}")
    per_unit = UNIT_SECONDS[unit]
    age = F.greatest(F.lit(0.0), seconds_between(reference, _col(ts)) / F.lit(per_unit))
    if max_age_days:
        age = F.least(age, F.lit(max_age_days * 86400.0 / per_unit))
    return F.exp(F.lit(-lam) * age)


def classify_error(message: Column | str) -> Column:
    """One of four error classes; the first matching rule wins."""
    m = F.lower(_col(message))

    def has(*words: str) -> Column:
        out = F.lit(False)
        for w in words:
            out = out | F.contains(m, F.lit(w))
        return out

    return (
        F.when(has("timeout", "timed out"), "timeout")
        .when(has("connect", "network", "dns"), "connection")
        .when(has("401", "403", "unauthorized", "forbidden"), "unavailable")
        .otherwise("other")
    )
