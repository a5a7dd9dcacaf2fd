"""Pages per day: views, clicks, ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.events import event_category, event_day, percent

TOP = 10  # fixed value: ranks kept in the mart


def page_visitors(events: DataFrame) -> DataFrame:
    """Views and clicks per day, page, user and session: the distinct counts run on these few rows."""
    category = event_category(F.col("event_type"), F.col("event_title"))
    seen = events.select(
        event_day(F.col("created_at")).alias("date"),
        "url",
        "user_id",
        "session_id",
        "event_id",
        category.alias("category"),
    ).where(F.col("url").isNotNull() & (F.col("category") != "other"))
    visitors = seen.groupBy("date", "url", "user_id", "session_id").agg(
        *(
            F.count(F.when(F.col("category") == name, F.col("event_id"))).alias(f"{name}s")
            for name in ("view", "click")
        )
    )
    # Reads both counts, so that all consumers share this plan and its exchange.
    return visitors.where(F.col("views") + F.col("clicks") > 0)


def page_days(visitors: DataFrame) -> DataFrame:
    """Viewed pages per day. Views and clicks come out of one pass instead of two and a join."""
    viewed = F.col("views") > 0
    return (
        visitors.groupBy("date", "url")
        .agg(
            F.count_distinct(F.when(viewed, F.col("user_id"))).alias("unique_users"),
            F.count_distinct(F.when(viewed, F.col("session_id"))).alias("unique_sessions"),
            F.sum("views").alias("view_count"),
            F.sum("clicks").alias("click_count"),
        )
        .where(F.col("view_count") > 0)
        .withColumn("conversion_rate", percent(F.col("click_count"), F.col("view_count")))
    )


def _by_views():
    return W.partitionBy("date").orderBy(F.desc("view_count"))


def top_pages_daily(pages: DataFrame, top: int = TOP) -> DataFrame:
    """Pages of the ``top`` ranks of every day; ties share a rank, so there may be more pages.

    The rank filter sits on the window, so Spark limits every map task's rows before the shuffle.
    """
    ranked = pages.withColumn("rank", F.dense_rank().over(_by_views()))
    return ranked.where(F.col("rank") <= top)


def page_ranks_daily(pages: DataFrame) -> DataFrame:
    """All pages with their rank.

    A dense rank depends on the distinct view counts of a day only, and there are at most
    sqrt(2 * views) of those. They are ranked, not the pages, so a day of many pages is never
    sorted in one task.
    """
    levels = pages.groupBy("date", "view_count").agg(F.count(F.lit(1)).alias("pages"))
    ranks = levels.select("date", "view_count", F.dense_rank().over(_by_views()).alias("rank"))
    return pages.join(ranks, ["date", "view_count"])
