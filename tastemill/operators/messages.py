"""Message columns: redaction, token counts, preferences, structured output, explanations."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.functions.events import literal_map
from tastemill.functions.hashing import request_key
from tastemill.functions.text import squeeze, strip
from tastemill.schemas import PREFERENCE

# Markers of prompt injection.
INJECTION_MARKERS = (
    "ignore previous instructions",
    "ignore the above",
    "forget your instructions",
    "forget your prompt",
    "reveal your system prompt",
    "print your instructions",
    "you are now in jailbreak mode",
    "disregard your instructions",
    "sudo rm -rf",
)

# Price in dollars per thousand tokens.
COST_PER_1K = {"qwen3:8b": 0.0, "gemma3:4b": 0.0}

# Colours in matching order.
COLORS = ("black", "white", "red", "blue", "green", "beige", "grey", "navy")

# Allowed categories and price bands of a structured preference.
CATEGORIES = (
    "jacket", "coat", "shirt", "t-shirt", "sweater", "hoodie", "dress", "jeans", "pants",
    "shorts", "skirt", "shoes", "sneakers", "boots", "hat", "scarf", "accessories", "other",
)
PRICE_BANDS = ("low", "medium", "high", "medium_or_lower")
DEFAULT_CATEGORY = "jacket"


def sanitize(message: Column) -> Column:
    """Injection markers become [REDACTED], white space collapses."""
    out = message
    for marker in INJECTION_MARKERS:
        out = F.regexp_replace(out, "(?i)" + re.escape(marker), "[REDACTED]")
    return squeeze(out)


def estimate_tokens(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4)).cast("bigint")


def estimated_cost(tokens_in: Column, tokens_out: Column, model: Column, prices: dict | None = None) -> Column:
    price = F.coalesce(F.try_element_at(literal_map(prices or COST_PER_1K), model), F.lit(0.0))
    return F.round(price * (tokens_in + tokens_out) / 1000.0, 6)


def preferred_color(message: Column) -> Column:
    """First colour, in list order, that occurs as a word of the message."""
    text = F.lower(message)
    out = None
    for color in COLORS:
        out = (F if out is None else out).when(text.rlike(rf"\b{color}\b"), color)
    return out


def extract_preferences(df: DataFrame, message: str = "message") -> DataFrame:
    return df.withColumn(
        "preference",
        F.to_json(
            F.struct(
                F.lit(DEFAULT_CATEGORY).alias("category"),
                preferred_color(F.col(message)).alias("color"),
                F.lit(None).cast("string").alias("style"),
                F.lit(None).cast("string").alias("price_preference"),
            ),
            {"ignoreNullFields": "false"},
        ),
    )


def validate_structured_output(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Parse JSON preferences; adds the fields, ``styles`` and ``error`` (null when valid).

    A field that is not a string, or outside its list of values, makes the row invalid; an
    invalid row has no fields.
    """
    text = F.col(raw)
    variant = F.try_parse_json(text)
    is_object = F.schema_of_variant(variant).startswith("OBJECT")
    p = F.from_json(text, PREFERENCE)
    clean = {c: F.nullif(strip(F.lower(p[c])), F.lit("")) for c in ("color", "style")}

    def not_text(name: str) -> Column:
        kind = F.schema_of_variant(F.try_variant_get(variant, f"$.{name}", "variant"))
        return F.coalesce(~kind.isin("STRING", "VOID"), F.lit(False))

    wrong = F.lit(False)
    for name in PREFERENCE.names:
        wrong = wrong | not_text(name)
    error = (
        F.when(variant.isNull() | ~F.coalesce(is_object, F.lit(False)), "malformed")
        .when(wrong, "type")
        .when(p["category"].isNotNull() & ~p["category"].isin(*CATEGORIES), "category")
        .when(
            p["price_preference"].isNotNull() & ~p["price_preference"].isin(*PRICE_BANDS),
            "price_preference",
        )
    )
    checked = df.withColumn("error", error)
    ok = F.col("error").isNull()
    return checked.select(
        "*",
        F.when(ok, p["category"]).alias("category"),
        F.when(ok, clean["color"]).alias("color"),
        F.when(ok & clean["style"].isNotNull(), F.array(clean["style"]))
        .when(ok, F.array().cast("array<string>"))
        .alias("styles"),
        F.when(ok, p["price_preference"]).alias("price_preference"),
    )


def explanation(item: Column, attributes: Column) -> Column:
    """Reason text built from true attributes only; the short form without any."""
    return F.when(
        F.coalesce(F.size(attributes), F.lit(0)) > 0, F.concat(F.lit("Recommended for "), item, F.lit("."))
    ).otherwise(F.concat(F.lit("Recommended "), item, F.lit(".")))


def explanations(items: DataFrame, attributes: Column) -> DataFrame:
    """``(item_id, text, item_attributes)``: the reason with the attributes it rests on, none as an empty list."""
    held = F.coalesce(attributes, F.array().cast("array<string>"))
    return items.select("item_id", explanation(F.col("item_id"), held).alias("text"), held.alias("item_attributes"))


def distinct_requests(messages: DataFrame, message: str = "message") -> DataFrame:
    """Each distinct message once, under its key."""
    return (
        messages.select(F.col(message).alias("message"))
        .distinct()
        .withColumn("request_key", request_key(F.col("message")))
    )


def answer_once(messages: DataFrame, answer, message: str = "message") -> DataFrame:
    """Run ``answer`` (DataFrame to DataFrame keyed by message) per distinct text, and join back."""
    return messages.join(answer(distinct_requests(messages, message)), message, "left")
