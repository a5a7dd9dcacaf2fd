"""The dashboard's statements, as parametrised SQL over the stored marts.

``:today`` is the day the dashboard is opened. The date filters prune the day partitions of the marts.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..operators.dashboard import RECENT_DAYS, TOP_ELEMENTS, TOP_PAGES, TOP_RANK, TREND_DAYS
from .marts import read_mart

LIMITS = {
    "trend_days": TREND_DAYS, "recent_days": RECENT_DAYS, "top_rank": TOP_RANK,
    "top_pages": TOP_PAGES, "top_elements": TOP_ELEMENTS,
}
_RECENT = "date >= date_sub(:today, :recent_days)"


def _trend(column: str) -> str:
    return f"SELECT date AS time, {column} FROM {{mart}} WHERE date >= date_sub(:today, :trend_days) ORDER BY time"


def _devices(column: str, total: str) -> str:
    return (
        f"SELECT device_type, sum({column}) AS {total} FROM {{mart}} WHERE date = :today"
        f" GROUP BY device_type ORDER BY {total} DESC, device_type"
    )


# panel: (mart, statement)
PANELS: dict[str, tuple[str, str]] = {
    "mean_session_minutes": ("session_metrics_daily", _trend("avg_duration_minutes")),
    "median_session_minutes": ("session_metrics_daily", _trend("median_duration_minutes")),
    "session_counts": ("session_metrics_daily", _trend("session_count")),
    "dau": ("user_activity_daily", _trend("dau")),
    "wau": ("user_activity_daily", _trend("wau")),
    "mau": ("user_activity_daily", _trend("mau")),
    "latest_wau": (
        "user_activity_daily",
        "SELECT max(date) AS time, max_by(wau, date) AS wau FROM {mart}"
        " WHERE date >= date_sub(:today, :trend_days) AND wau IS NOT NULL",
    ),
    "top_pages": (
        "top_pages_daily",
        f"SELECT url, sum(view_count) AS total_views FROM {{mart}} WHERE {_RECENT} AND rank <= :top_rank"
        " GROUP BY url ORDER BY total_views DESC, url LIMIT :top_pages",
    ),
    "device_users": ("device_distribution_daily", _devices("unique_users", "total_users")),
    "device_events": ("device_distribution_daily", _devices("device_events", "total_events")),
    "overall_click_ratio": (
        "element_conversion",
        f"SELECT sum(clicks) / sum(views) AS conversion_rate FROM {{mart}} WHERE {_RECENT} AND views > 0",
    ),
    "element_click_ratio": (
        "element_conversion",
        f"SELECT element_id, sum(clicks) / sum(views) AS conversion_rate FROM {{mart}} WHERE {_RECENT} AND views > 0"
        " GROUP BY element_id ORDER BY conversion_rate DESC, element_id LIMIT :top_elements",
    ),
}


def panel(spark: SparkSession, marts_path: str, name: str, today: date) -> DataFrame:
    mart, statement = PANELS[name]
    used = {k: v for k, v in {"today": today, **LIMITS}.items() if f":{k}" in statement}
    return spark.sql(statement, args=used, mart=read_mart(spark, marts_path, mart))
