"""Clean table -> the five marts."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.timestamps import as_time
from ..operators import activity, conversion, devices, keyed, pages, sessions, visits
from ..session import staging
from ..sources import tables
from .write import replace_days

LOOKBACK_DAYS = 10  # fixed value: days one run reports on


#: Marts made of visits; the others are made of the events.
FROM_VISITS = ("user_activity_daily", "session_metrics_daily", "device_distribution_daily")


def compute_marts(
    events: DataFrame, visited: DataFrame, first_day: date, only: tuple[str, ...] = tuple(schemas.MARTS)
) -> dict[str, DataFrame]:
    """Marts from an analysis frame and its visits, both of which may start before ``first_day``.

    Earlier days serve as warm-up of the trailing windows and complete the sessions that cross
    midnight; no row of theirs is emitted.
    """
    recent = events.where(F.col("created_at") >= as_time(datetime.combine(first_day, time())))

    def emitted(mart: DataFrame) -> DataFrame:
        return activity.since(mart, first_day)

    session_rows = sessions.session_rollup(visited)
    marts = {
        "user_activity_daily": emitted(
            activity.user_activity_daily(visited.select("date", "user_id").distinct())
        ),
        "element_conversion": conversion.element_conversion(recent),
        "session_metrics_daily": sessions.session_metrics_daily(emitted(session_rows)),
        "device_distribution_daily": devices.device_distribution_daily(emitted(visited)),
        "top_pages_daily": pages.top_pages_daily(pages.page_days(pages.page_visitors(recent))),
    }
    return {name: mart for name, mart in marts.items() if name in only}


def run_marts(
    spark: SparkSession,
    clean_path: str,
    marts_path: str,
    as_of: datetime,
    lookback_days: int = LOOKBACK_DAYS,
    warmup_days: int = activity.WARMUP_DAYS,
    only: tuple[str, ...] = tuple(schemas.MARTS),
) -> None:
    """Compute the marts of the last days and replace these days in the mart tables.

    The state of the clean table (one row per key) and the visits are each written once to the
    shared folder if several marts read them; the marts then read columns of those copies. All days of the range are replaced,
    also those that now have no rows; it starts at midnight, since a half first day must not
    overwrite the full one of an earlier run.
    """
    first_day = as_of.date() - timedelta(days=lookback_days)
    low = datetime.combine(first_day - timedelta(days=warmup_days), time())
    table = tables.read_table(spark, clean_path, tables.CLEAN_TABLE)
    in_range = tables.time_range(table, low, as_of, closed=True)
    days = [first_day + timedelta(days=i) for i in range((as_of.date() - first_day).days + 1)]
    with staging(spark) as stage:
        events = tables.analysis_frame(tables.clean_state(in_range, as_of))
        n_of_visits = len(set(only) & set(FROM_VISITS))
        if len(only) > 1 and n_of_visits < len(only):
            events = stage(events, "clean-state")
        visited = visits.visit_rollup(events)
        if n_of_visits:
            visited = stage(visited, "visits")

        for name, mart in compute_marts(events, visited, first_day, only).items():
            columns = schemas.MARTS[name].names
            stamped = mart.select(*columns, as_time(as_of).alias("calculation_timestamp"))
            if name == "element_conversion":
                # Dated by the run: the rows cover the whole range, not one day.
                stamped = stamped.withColumn("run_date", F.lit(str(as_of.date())).cast("date"))
                replace_days(stamped, f"{marts_path}/{name}", "element_id", day="run_date",
                             days=[as_of.date()])
            else:
                replace_days(stage(stamped, name), f"{marts_path}/{name}", days=days)


def read_mart(spark: SparkSession, marts_path: str, name: str) -> DataFrame:
    """A mart as the dashboard reads it; of the element mart, the latest run."""
    table = tables.read_table(spark, f"{marts_path}/{name}", tables.mart_table(name))
    if name == "element_conversion":
        table = keyed.latest_snapshot(table, keys=(), stamp="run_date")
    return table.select(*schemas.MARTS[name].names, "calculation_timestamp")
