"""The dashboard panels over the marts. ``as_of`` stands for the day the dashboard is opened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Days a panel looks back (both ends count) and rows a list shows.
TREND_DAYS, RECENT_DAYS = 30, 7
TOP_PAGES, TOP_RANK, TOP_ELEMENTS = 10, 10, 20


def _day(as_of) -> Column:
    return F.lit(str(as_of)).cast("date")


def _since(mart: DataFrame, as_of, days: int) -> DataFrame:
    return mart.where(F.col("date") >= F.date_sub(_day(as_of), days))


def trend(mart: DataFrame, column: str, as_of) -> DataFrame:
    """A metric by day over the last 30 days."""
    return _since(mart, as_of, TREND_DAYS).select(F.col("date").alias("time"), column).orderBy("time")


def last_value(trend_rows: DataFrame, column: str) -> DataFrame:
    """The tile of a trend: its newest value that is not null."""
    return trend_rows.where(F.col(column).isNotNull()).agg(
        F.max("time").alias("time"), F.max_by(column, "time").alias(column)
    )


def mean_session_minutes(sessions: DataFrame, as_of) -> DataFrame:
    return trend(sessions, "avg_duration_minutes", as_of)


def median_session_minutes(sessions: DataFrame, as_of) -> DataFrame:
    return trend(sessions, "median_duration_minutes", as_of)


def session_counts(sessions: DataFrame, as_of) -> DataFrame:
    return trend(sessions, "session_count", as_of)


def active_users(activity: DataFrame, metric: str, as_of) -> DataFrame:
    """``metric`` is dau, wau or mau."""
    return trend(activity, metric, as_of)


def top_pages(pages: DataFrame, as_of) -> DataFrame:
    return (
        _since(pages, as_of, RECENT_DAYS)
        .where(F.col("rank") <= TOP_RANK)
        .groupBy("url")
        .agg(F.sum("view_count").alias("total_views"))
        .orderBy(F.desc("total_views"), "url")
        .limit(TOP_PAGES)
    )


def _device_share(devices: DataFrame, column: str, total: str, as_of) -> DataFrame:
    return (
        devices.where(F.col("date") == _day(as_of))
        .groupBy("device_type")
        .agg(F.sum(column).alias(total))
        .orderBy(F.desc(total), "device_type")
    )


def device_users(devices: DataFrame, as_of) -> DataFrame:
    return _device_share(devices, "unique_users", "total_users", as_of)


def device_events(devices: DataFrame, as_of) -> DataFrame:
    return _device_share(devices, "device_events", "total_events", as_of)


def _click_ratio() -> Column:
    """Clicks per view: a ratio, not a percentage."""
    return (F.sum("clicks") / F.sum("views")).alias("conversion_rate")


def _viewed(elements: DataFrame, as_of) -> DataFrame:
    return _since(elements, as_of, RECENT_DAYS).where(F.col("views") > 0)


def overall_click_ratio(elements: DataFrame, as_of) -> DataFrame:
    return _viewed(elements, as_of).agg(_click_ratio())


def element_click_ratio(elements: DataFrame, as_of) -> DataFrame:
    return (
        _viewed(elements, as_of)
        .groupBy("element_id")
        .agg(_click_ratio())
        .orderBy(F.desc("conversion_rate"), "element_id")
        .limit(TOP_ELEMENTS)
    )
