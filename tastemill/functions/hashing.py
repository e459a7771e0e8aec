"""Deterministic ids, buckets and keys as column expressions."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType


def seeded_order(df: DataFrame, keys: Sequence[str], seed: int) -> Column:
    """md5 of the seed and the keys as text: an order any engine can repeat. Times count as
    microseconds; null keys are empty."""

    def text(name: str) -> Column:
        c = F.col(name)
        c = F.unix_micros(c) if isinstance(df.schema[name].dataType, TimestampType) else c
        return F.coalesce(c.cast("string"), F.lit(""))

    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[text(k) for k in keys]))


def assign_bucket(user: Column, n_buckets: int = 100) -> Column:
    """First eight md5 hex digits modulo the bucket count."""
    digits = F.substring(F.md5(user.cast("string")), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % F.lit(n_buckets)


def assign_variant(user: Column, weights: list[tuple[str, float]], n_buckets: int = 100) -> Column:
    """Variant whose cumulative share of the buckets covers the user's bucket.

    The last variant also takes whatever rounding leaves over.
    """
    bucket = assign_bucket(user, n_buckets)
    out, upto = None, 0.0
    for name, weight in weights:
        upto += weight * n_buckets
        out = (F if out is None else out).when(bucket < F.lit(upto), name)
    return out.otherwise(weights[-1][0])


# Fixed value: prefix of the names vector-point ids are derived from.
POINT_PREFIX = "recsys:"


def point_id(item: Column, prefix: str = POINT_PREFIX) -> Column:
    """Version-5 UUID of ``prefix + item`` in the URL namespace."""
    name = F.concat(F.unhex(F.lit(uuid.NAMESPACE_URL.hex)), F.encode(F.concat(F.lit(prefix), item), "UTF-8"))
    h = F.sha1(name)
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("int").bitwiseAND(0x3F).bitwiseOR(0x80)))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 19, 2)),
        F.substring(h, 21, 12),
    )


def request_key(message: Column) -> Column:
    return F.substring(F.sha2(message, 256), 1, 16)


def seeded_hash(seed: int, *cols: Column) -> Column:
    return F.xxhash64(F.lit(seed), *cols)
