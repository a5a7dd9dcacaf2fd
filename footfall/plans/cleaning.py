"""Raw -> clean and quarantine, then out of raw."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..operators import keyed, summary, validate
from ..session import staging
from ..sources import tables
from .write import append_days, files_of, read_files, replace_files

LOOKBACK = timedelta(days=1)  # fixed value: trailing range one run looks at


@dataclass(frozen=True)
class CleaningPaths:
    raw: str
    processed: str
    clean: str
    invalid: str


def unprocessed(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Raw rows that no run has taken yet: neither listed, nor older than the listed version.

    Rows leave the raw table by being listed, so ingest and cleaning only ever append and never
    rewrite each other's files. ``compact_raw`` drops listed rows from the files later.
    """
    done = processed.select(
        *(F.col(name).alias(f"done_{name}") for name in (*schemas.RAW_KEY, "ingested_at"))
    )
    same_key = [F.col(name) == F.col(f"done_{name}") for name in schemas.RAW_KEY]
    return raw.join(
        done, [*same_key, F.col("ingested_at") <= F.col("done_ingested_at")], "left_anti"
    )


def _tables(spark: SparkSession, paths: CleaningPaths) -> tuple[DataFrame, DataFrame]:
    return (
        tables.read_table(spark, paths.raw, tables.RAW_TABLE),
        tables.read_table(spark, paths.processed, tables.PROCESSED_TABLE, may_be_absent=True),
    )


def clean(
    spark: SparkSession, paths: CleaningPaths, as_of: datetime, lookback: timedelta = LOOKBACK
) -> DataFrame:
    """One cleaning run; returns the load report."""
    raw, processed = _tables(spark, paths)
    return route(raw, processed, appender(paths), as_of, lookback)


Put = Callable[[DataFrame, str], None]


def appender(paths: CleaningPaths) -> Put:
    """Appends rows to the tables on ``paths``, sorted inside their files."""
    order = {"clean": ("user_id", F.desc("created_at"), "id"), "invalid": ("user_id", "id"), "processed": ("user_id",)}
    return lambda rows, part: append_days(rows, getattr(paths, part), *order[part])


def route(raw: DataFrame, processed: DataFrame, put: Put, as_of: datetime, lookback: timedelta) -> DataFrame:
    """Validate the raw rows no run has taken, ``put`` them into their tables, return the load report.

    The validated rows, one per raw key, are written to the shared folder once, and all sinks read
    that copy; they are counted for the report while they are written. Rows whose quarantine key has
    a null part fail there and are counted as failed. The keys are listed as processed last: a run
    that dies earlier is repeated as a whole, and what it appended twice is one row in
    ``clean_state`` and ``invalid_state``.
    """
    spark = raw.sparkSession
    raw, processed = (tables.raw_window(t, as_of - lookback, as_of) for t in (raw, processed))
    current = keyed.last_write_wins(unprocessed(raw, processed), schemas.RAW_KEY)
    with staging(spark) as stage:
        counted, observation = summary.observed_report(validate.with_validation(current, as_of))
        put_validated(stage(counted, "validated"), put, as_of)
        report = summary.report_of(spark, observation)
    return report


def put_validated(validated: DataFrame, put: Put, as_of) -> None:
    """Clean and quarantined rows to their tables, then the keys that are done with."""
    good = validate.clean_rows(validated, as_of)
    put(good.withColumn("date", F.to_date("created_at")), "clean")
    bad = validate.quarantine_rows(validated, as_of).dropna(subset=list(schemas.INVALID_KEY))
    put(bad.withColumn("date", F.to_date("processed_at")), "invalid")
    done = validated.where(validate.complete_key()).select(*schemas.RAW_KEY, "ingested_at")
    put(done.withColumn("date", F.to_date("created_at")), "processed")


def compact_raw(spark: SparkSession, paths: CleaningPaths, before) -> None:
    """Drop processed rows and superseded versions from the raw files of days before ``before``.

    Late events may still be appended to these days while it runs: only the files listed at the
    start are read, and only they are replaced. The processed keys of the days go too, after the
    raw rows; a version that arrives later is newer than them and is cleaned anyway.
    """
    raw, processed = _tables(spark, paths)
    closed = F.col("date") < F.lit(str(before)).cast("date")
    raw_files, done_files = (files_of(t.where(closed)) for t in (raw, processed))
    if not raw_files or not done_files:
        return
    old = read_files(spark, paths.raw, raw_files, tables.RAW_TABLE)
    done = read_files(spark, paths.processed, done_files, tables.PROCESSED_TABLE)
    left = keyed.last_write_wins(unprocessed(old, done), schemas.RAW_KEY)
    replace_files(paths.raw, raw_files, left, "user_id", F.desc("created_at"), "id")
    replace_files(paths.processed, done_files, done.limit(0))


def purge_expired(spark: SparkSession, path: str, schema: T.StructType, as_of) -> None:
    """Remove expired rows from a table: the files that hold some are replaced, no others."""
    table = tables.read_table(spark, path, schema)
    files = files_of(keyed.expired(table, as_of))
    if files:
        old = read_files(spark, path, files, schema)
        replace_files(path, files, keyed.unexpired(old, as_of))
