"""The visit roll-up: events reduced to one row per day, session, user and device.

User activity, device shares and sessions all follow from it, so a job reads the event log once
for the three of them. Map tasks combine events first, whatever key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.events import event_day

def visit_rollup(events: DataFrame) -> DataFrame:
    return (
        events.withColumn("date", event_day(F.col("created_at")))
        .groupBy("date", "session_id", "user_id", "device_type")
        .agg(
            F.min("created_at").alias("first_at"),
            F.max("created_at").alias("last_at"),
            F.count(F.lit(1)).alias("events"),
            F.count("event_id").alias("identified_events"),
        )
    )
