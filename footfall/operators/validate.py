"""The rule set: ordered messages, status, and the two routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions.text import is_empty
from ..functions.timestamps import as_time, time_text
from .barrier import computed_once

# Accepted domains and the words that make a message critical.
EVENT_TYPES = ("VIEW", "CLICK")
DEVICE_TYPES = ("DESKTOP", "MOBILE", "TABLET", "ANDROID", "IOS")
CRITICAL_WORDS = ("required", "Invalid event type", "User ID must be positive")

CLEAN_DAYS, INVALID_DAYS = 365, 7  # fixed values: retention


def _rules(now: Column) -> list[tuple[Column, Column]]:
    """Condition and message of every rule, in the order the messages are listed."""
    kind, device = F.col("type"), F.col("device_type")
    user, created, received = F.col("user_id"), F.col("created_at"), F.col("received_at")

    def message(label: str, value: Column | None = None) -> Column:
        if value is None:
            return F.lit(label)
        return F.concat(F.lit(f"{label}: "), value)

    def required(name: str, label: str) -> tuple[Column, Column]:
        return is_empty(F.col(name)), message(f"{label} is required")

    def future(c: Column, label: str) -> tuple[Column, Column]:
        return c > now, message(f"{label} timestamp is in the future", time_text(c))

    return [
        required("id", "Event ID"),
        required("type", "Event type"),
        (~is_empty(kind) & ~F.upper(kind).isin(*EVENT_TYPES), message("Invalid event type", kind)),
        (user.isNull(), message("User ID is required")),
        (user <= 0, message("User ID must be positive", user.cast("string"))),
        required("session_id", "Session ID"),
        required("url", "URL"),
        required("user_agent", "User agent"),
        (created.isNull(), message("Created at timestamp is required")),
        future(created, "Created at"),
        future(received, "Received at"),
        (~is_empty(device) & ~F.upper(device).isin(*DEVICE_TYPES),
         message("Invalid device type", device)),
        (~is_empty(kind) & is_empty(F.col("element_id")),
         message("Element ID is required for events")),
    ]


def with_validation(events: DataFrame, as_of) -> DataFrame:
    """Adds ``errors`` (messages in rule order) and ``status``."""
    errors = F.array_compact(F.array(*(F.when(c, m) for c, m in _rules(as_time(as_of)))))

    def is_critical(error: Column) -> Column:
        hit = F.lit(False)
        for word in CRITICAL_WORDS:
            hit = hit | error.contains(word)
        return hit

    status = (
        F.when(F.size("found") == 0, "VALID")
        .when(F.exists("found", is_critical), "INVALID")
        .otherwise("SUSPICIOUS")
    )
    listed = events.withColumn("found", errors)
    return computed_once(listed, errors=F.col("found"), status=status).drop("found")


def error_text() -> Column:
    return F.concat_ws("; ", "errors")


def clean_rows(validated: DataFrame, loaded_at) -> DataFrame:
    """Valid and suspicious rows in the clean shape. Duplicates are still in."""
    when = as_time(loaded_at)
    return validated.where(F.col("status") != "INVALID").select(
        *schemas.CLEAN_COLUMNS,
        when.alias("loaded_at"),
        (when + F.make_dt_interval(days=F.lit(CLEAN_DAYS))).alias("expires_at"),
    )


def quarantine_rows(validated: DataFrame, processed_at) -> DataFrame:
    """Invalid and suspicious rows with their messages."""
    when = as_time(processed_at)
    return validated.where(F.col("status") != "VALID").select(
        "user_id",
        "id",
        "type",
        "session_id",
        F.col("created_at").alias("event_time"),
        when.alias("processed_at"),
        error_text().alias("validation_error"),
        (when + F.make_dt_interval(days=F.lit(INVALID_DAYS))).alias("expires_at"),
    )


def processed_keys(validated: DataFrame) -> DataFrame:
    """Keys to take out of the raw table; a row with an incomplete key stays there."""
    return validated.where(complete_key()).select(*schemas.RAW_KEY).distinct()


def complete_key() -> Column:
    return F.col("user_id").isNotNull() & F.col("created_at").isNotNull() & ~is_empty(F.col("id"))


def status_counts(validated: DataFrame) -> DataFrame:
    return validated.groupBy("status").agg(F.count(F.lit(1)).alias("events"))


def message_counts(validated: DataFrame) -> DataFrame:
    """How often every rule fired, without the value a message quotes."""
    rule = F.substring_index("error", ":", 1)
    return (
        validated.select("status", F.explode("errors").alias("error"))
        .select("status", rule.alias("rule"))
        .groupBy("rule", "status")
        .agg(F.count(F.lit(1)).alias("events"))
    )
