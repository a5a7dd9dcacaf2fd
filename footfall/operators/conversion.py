"""Clicks per view, by element and by page, over the whole frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.events import event_category, event_day, percent
from ..functions.text import is_empty


def _categorised(events: DataFrame) -> DataFrame:
    category = event_category(F.col("event_type"), F.col("event_title"))
    return events.withColumn("category", category)


def _is(category: str) -> Column:
    return F.col("category") == category


def _last_day() -> Column:
    return event_day(F.max("created_at")).alias("date")


def element_conversion(events: DataFrame) -> DataFrame:
    """Views, clicks, rate and mean click position per element, dated with its last event."""

    def mean_position(axis: str) -> Column:
        return F.coalesce(F.avg(F.when(_is("click"), F.col(axis))), F.lit(0.0))

    return (
        _categorised(events)
        .where(~is_empty(F.col("element_id")))
        .groupBy("element_id")
        .agg(
            _last_day(),
            F.count_if(_is("view")).alias("views"),
            F.count_if(_is("click")).alias("clicks"),
            mean_position("x").alias("avg_x"),
            mean_position("y").alias("avg_y"),
        )
        .withColumn("conversion_rate", percent(F.col("clicks"), F.col("views")))
        .withColumn("total_interactions", F.col("views") + F.col("clicks"))
    )


def page_conversion(events: DataFrame) -> DataFrame:
    """Views, clicks and rate per page; users and sessions over all its events."""
    return (
        _categorised(events)
        .where(F.col("url").isNotNull())
        .groupBy("url")
        .agg(
            _last_day(),
            F.count_if(_is("view")).alias("views"),
            F.count_if(_is("click")).alias("clicks"),
            F.count_distinct("user_id").alias("unique_users"),
            F.count_distinct("session_id").alias("unique_sessions"),
        )
        .withColumn("conversion_rate", percent(F.col("clicks"), F.col("views")))
    )


def category_counts(events: DataFrame) -> DataFrame:
    return _categorised(events).groupBy("category").agg(F.count(F.lit(1)).alias("events"))
