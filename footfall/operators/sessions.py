"""Session roll-up and daily session metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.events import event_day
from ..functions.timestamps import micros_between
from .quantile import exact_median

SECOND = 1_000_000
LONGEST = 86_400 * SECOND  # fixed value: durations are clamped to one day


def session_parts(events: DataFrame) -> DataFrame:
    """Events per session and user. Fixed-width counters only, so this is a hash aggregate."""
    return events.groupBy("session_id", "user_id").agg(
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
        F.count(F.lit(1)).alias("events"),
    )


def session_rollup(parts: DataFrame) -> DataFrame:
    """One row per session from ``session_parts`` or from visits.

    The user is the one of the earliest event; the date is the day the session starts.
    """
    merged = (
        parts.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.min(F.struct("first_at", "user_id")).alias("earliest"),
            F.max("last_at").alias("end_time"),
            F.sum("events").alias("event_count"),
        )
        .withColumn("start_time", F.col("earliest.first_at"))
        .withColumn("duration_us", micros_between(F.col("start_time"), F.col("end_time")))
    )
    # The guards read every aggregate. No consumer can drop one of them, so the plans of several
    # consumers agree up to here and Spark reuses the exchanges instead of reading events again.
    return merged.where((F.col("duration_us") >= 0) & (F.col("event_count") > 0)).select(
        "session_id",
        F.col("earliest.user_id").alias("user_id"),
        event_day(F.col("start_time")).alias("date"),
        "start_time",
        "end_time",
        F.least("duration_us", F.lit(LONGEST)).alias("duration_us"),
        "event_count",
    )


def session_metrics_daily(sessions: DataFrame) -> DataFrame:
    """Mean, exact median and sample deviation of the duration, and the counts, per start day.

    Sums run over whole microseconds, so they do not depend on the order of addition.
    """
    seconds = F.col("duration_us") / F.lit(float(SECOND))
    daily = sessions.groupBy("date").agg(
        F.sum(F.col("duration_us").cast("decimal(20,0)")).alias("total_us"),
        F.coalesce(F.stddev_samp(seconds), F.lit(0.0)).alias("std_duration_seconds"),
        F.sum("event_count").alias("total_events"),
        F.count(F.lit(1)).alias("session_count"),
        F.count_distinct("user_id").alias("unique_users"),
    )
    medians = exact_median(sessions, "date", "duration_us", width=SECOND)
    mean = F.col("total_us").cast("double") / F.col("session_count") / F.lit(float(SECOND))
    return (
        daily.join(medians, "date")
        .select(
            "date",
            mean.alias("avg_duration_seconds"),
            (F.col("median") / F.lit(float(SECOND))).alias("median_duration_seconds"),
            "std_duration_seconds",
            "total_events",
            "session_count",
            "unique_users",
        )
        .withColumns(
            {
                f"{name}_duration_minutes": F.col(f"{name}_duration_seconds") / 60.0
                for name in ("avg", "median")
            }
        )
    )
