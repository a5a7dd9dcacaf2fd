"""Daily, weekly and monthly active users."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.events import event_day

# Trailing calendar days a metric looks at, the day itself included.
SPANS = {"dau": 1, "wau": 7, "mau": 30}
WARMUP_DAYS = max(SPANS.values()) - 1


def active_days(events: DataFrame) -> DataFrame:
    """One row per user and day."""
    return events.select(event_day(F.col("created_at")).alias("date"), "user_id").distinct()


def rolling_active_users(days: DataFrame) -> DataFrame:
    """Distinct users in the trailing windows of every day that has events.

    A user who is active on day D stays active for the days from D on, until the next own active
    day takes over or the longest window ends. Counting users by day and by that reach leaves at
    most 30 rows per day; only those few rows are spread over the days they cover. No user-day is
    ever copied 7 or 30 times, and a user's rows number at most the days of the frame.
    """
    longest = max(SPANS.values())
    upcoming = F.lead("date").over(W.partitionBy("user_id").orderBy("date"))
    reach = F.least(F.coalesce(F.date_diff(upcoming, "date"), F.lit(longest)), F.lit(longest))
    by_reach = (
        days.select("date", "user_id", reach.alias("reach"))
        .groupBy("date", "reach")
        .agg(F.count("user_id").alias("users"))
    )
    covered = by_reach.select(
        "date", "users", F.explode(F.sequence(F.lit(0), F.col("reach") - 1)).alias("offset")
    ).select(F.date_add("date", F.col("offset")).alias("date"), "offset", "users")
    counts = {
        name: F.sum(F.when(F.col("offset") < span, F.col("users")).otherwise(0)).alias(name)
        for name, span in SPANS.items()
    }
    observed = F.count_if(F.col("offset") == 0) > 0
    return (
        covered.groupBy("date")
        .agg(*counts.values(), observed.alias("observed"))
        .where("observed")
        .select("date", *SPANS)
    )


def user_activity_daily(days: DataFrame) -> DataFrame:
    """The user activity mart from ``active_days`` (or any frame of date and user)."""
    rolling = rolling_active_users(days)

    def per_daily(name: str):
        return F.try_divide(F.col(name).cast("double"), F.col("dau").cast("double"))

    return rolling.select(
        "*", *(per_daily(name).alias(f"{name}_to_dau_ratio") for name in ("wau", "mau"))
    )


def since(mart: DataFrame, first_day) -> DataFrame:
    """Only days from ``first_day`` on; earlier ones served as warm-up of the windows."""
    return mart.where(F.col("date") >= F.lit(str(first_day)).cast("date"))
