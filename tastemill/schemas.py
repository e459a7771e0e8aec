"""Table schemas, vocabularies and default settings."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

INTERACTIONS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
INTERACTION_KEYS = ["user_id", "item_id", "event_type", "timestamp"]
# Total order of the interaction timeline; unique once rows are deduplicated.
TIMELINE = ["timestamp", "user_id", "item_id", "event_type"]

ITEMS = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in ("item_id", "title", "category", "tags", "text_description")
    ]
)
USERS = T.StructType(
    [T.StructField("user_id", T.StringType()), T.StructField("metadata", T.StringType())]
)
VECTORS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("vector", T.ArrayType(T.FloatType())),
    ]
)
STREAM_EVENT = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in ("user_id", "item_id", "event_type", "timestamp", "received_at")
    ]
)
RATINGS_CSV = "userId LONG, movieId LONG, rating DOUBLE, timestamp LONG"
MOVIES_CSV = "movieId LONG, title STRING, genres STRING"
TAGS_CSV = "userId LONG, movieId LONG, tag STRING, timestamp LONG"
PREFERENCE = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in ("category", "color", "style", "price_preference")
    ]
)

# Event vocabularies of the batch tables and of the event endpoint.
BATCH_EVENTS = ("view", "click", "like", "purchase")
SERVING_EVENTS = ("view", "click", "like", "purchase", "rate")

# Implicit-feedback weight per event type; other types weigh 1.
EVENT_WEIGHTS = {"view": 1.0, "click": 2.0, "like": 3.0, "purchase": 5.0}

# Seconds per recency unit.
UNIT_SECONDS = {"days": 86400.0, "hours": 3600.0, "minutes": 60.0, "seconds": 1.0}


@dataclass(frozen=True)
class Settings:
    """Defaults of the batch jobs."""

    max_rows: int | None = None
    min_interactions_per_user: int = 2
    event_weights: dict = field(default_factory=lambda: dict(EVENT_WEIGHTS))
    recency_lambda: float = 0.035
    recency_unit: str = "days"
    recency_max_age_days: float | None = 365.0
    split_ratios: tuple = (0.7, 0.1, 0.2)
    like_threshold: float = 4.0
    als_factors: int = 64
    als_iterations: int = 40
    als_regularization: float = 0.1
    als_alpha: float = 5.0
    top_k: int = 20
    eval_k: tuple = (10, 20)
    eval_max_users: int | None = None


DEFAULTS = Settings()
