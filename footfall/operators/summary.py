"""Profiles of a frame and reports of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from .. import schemas
from ..functions.events import DUPLICATE_NAMES, duplicate_coordinates
from .validate import complete_key


def extract_profile(events: DataFrame) -> DataFrame:
    """Rows, time range, distinct users and sessions."""
    return events.agg(
        F.count(F.lit(1)).alias("events"),
        F.min("created_at").alias("first_event"),
        F.max("created_at").alias("last_event"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("session_id").alias("unique_sessions"),
    )


def activity_summary(activity: DataFrame) -> DataFrame:
    return activity.agg(
        F.min("dau").alias("min_dau"), F.max("dau").alias("max_dau"), F.avg("dau").alias("avg_dau")
    )


def session_summary(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.sum("session_count").alias("sessions"),
        F.min("avg_duration_seconds").alias("min_avg_duration"),
        F.max("avg_duration_seconds").alias("max_avg_duration"),
    )


def _missing(names: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for name in names:
        hit = hit | F.col(name).isNull()
    return hit


_IS_CLEAN, _IS_BAD = "status != 'INVALID'", "status != 'VALID'"


def load_report(validated: DataFrame) -> DataFrame:
    """Total, loaded, failed and success rate of every sink and of the whole run.

    A row fails where the table's key would have a null part. Rows that are the same event count once
    in the clean sink, rows of one raw key once in the deletion. Events are reduced to one row each,
    these to one row per raw key: both groupings combine before their shuffle.
    """
    x, y = duplicate_coordinates()
    of_event = validated.groupBy(*DUPLICATE_NAMES, x.alias("at_x"), y.alias("at_y")).agg(
        F.max(F.expr(_IS_CLEAN).cast("long")).alias("clean"),
        F.count_if(F.expr(_IS_BAD)).alias("invalid"),
        F.count(F.lit(1)).alias("rows"),
    )
    of_key = of_event.groupBy(*schemas.RAW_KEY).agg(
        *(F.sum(name).alias(name) for name in ("clean", "invalid", "rows"))
    )

    def total(value: str | Column, condition: Column | None = None) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        return F.coalesce(F.sum(value if condition is None else F.when(condition, value)), F.lit(0))

    return report_lines(
        of_key.agg(
            total("clean").alias("clean"),
            total("clean", _missing(schemas.CLEAN_KEY)).alias("clean_failed"),
            total("invalid").alias("invalid"),
            total("invalid", _missing(schemas.INVALID_KEY)).alias("invalid_failed"),
            F.count_if(complete_key()).alias("deleted"),
            total("rows", ~complete_key()).alias("undeletable"),
        )
    )


def observed_report(validated: DataFrame) -> tuple[DataFrame, Observation]:
    """``validated``, one row per raw key, with the figures of its load report counted as it is written."""
    observation = Observation()
    is_clean, is_bad = F.expr(_IS_CLEAN), F.expr(_IS_BAD)
    counts = {
        "clean": is_clean,
        "clean_failed": is_clean & _missing(schemas.CLEAN_KEY),
        "invalid": is_bad,
        "invalid_failed": is_bad & _missing(schemas.INVALID_KEY),
        "deleted": complete_key(),
        "undeletable": ~complete_key(),
    }
    return validated.observe(observation, *(F.count_if(c).alias(n) for n, c in counts.items())), observation


def report_of(spark: SparkSession, observation: Observation) -> DataFrame:
    """The load report of rows that have been written."""
    counts = observation.get
    return report_lines(spark.createDataFrame([counts], ", ".join(f"{name} long" for name in counts)))


def report_lines(totals: DataFrame) -> DataFrame:
    """Four lines from the six counts."""

    def line(sink: str, total: Column, failed: Column) -> Column:
        loaded = total - failed
        rate = F.try_divide(loaded.cast("double"), total.cast("double")) * 100.0
        return F.struct(
            F.lit(sink).alias("sink"),
            total.alias("total"),
            loaded.alias("loaded"),
            failed.alias("failed"),
            F.round(F.coalesce(rate, F.lit(0.0)), 2).alias("success_rate"),
        )

    clean, invalid = F.col("clean"), F.col("invalid")
    clean_failed, invalid_failed = F.col("clean_failed"), F.col("invalid_failed")
    return totals.select(
        F.inline(
            F.array(
                line("clean", clean, clean_failed),
                line("invalid", invalid, invalid_failed),
                line("deletion", F.col("deleted") + F.col("undeletable"), F.col("undeletable")),
                line("overall", clean + invalid, clean_failed + invalid_failed),
            )
        )
    )
