"""Device shares per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.events import percent


def device_distribution_daily(visits: DataFrame) -> DataFrame:
    """Users, sessions and events per day and device, with their share of the day's totals.

    Grouping sets count devices and whole days in one pass over the visits; the totals row of a
    day is then attached to its device rows. Events without a device count in the totals only.
    """
    whole_day = F.grouping("device_type") == 1
    counted = visits.groupingSets(
        [["date", "device_type"], ["date"]], "date", "device_type"
    ).agg(
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("session_id").alias("unique_sessions"),
        F.sum("identified_events").alias("device_events"),
        whole_day.alias("whole_day"),
    )
    shares = {
        "user_percentage": "unique_users",
        "session_percentage": "unique_sessions",
        "event_percentage": "device_events",
    }
    day = W.partitionBy("date")

    def day_total(name: str):
        return F.max(F.when(F.col("whole_day"), F.col(name))).over(day)

    return (
        counted.withColumns(
            {share: percent(F.col(name), day_total(name)) for share, name in shares.items()}
        )
        .where(~F.col("whole_day") & F.col("device_type").isNotNull())
        .drop("whole_day")
    )
