"""Files -> raw table and dead letter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.timestamps import as_time
from ..operators import normalise
from ..session import staging
from ..sources import files
from .write import append_days


def land(rows: DataFrame, raw_path: str, dead_path: str, source: str, ingested_at) -> None:
    """Append accepted rows to the raw table and the others to the dead letter.

    ``ingested_at`` is a time or a column of ``rows``. Decoded rows are written to the shared folder
    once and both sinks read that copy. Delivery is at least once: a repeated batch appends the same
    keys again, and readers keep the last write of a key.
    """
    with staging(rows.sparkSession) as stage:
        stamped = stage(
            rows.withColumns({"ingested_at": as_time(ingested_at), "source": F.lit(source)}), "landing"
        )
        good = normalise.accepted(stamped, "ingested_at", "source")
        append_days(
            good.withColumn("date", F.to_date("created_at")),
            raw_path,
            "user_id",
            F.desc("created_at"),
            "id",
        )
        bad = normalise.rejected(stamped, "ingested_at", "source")
        append_days(bad.withColumn("date", F.to_date("ingested_at")), dead_path)


def ingest_csv(
    spark: SparkSession, drop: str, raw_path: str, dead_path: str, dialect: str = "rfc4180"
) -> None:
    """One sweep over a drop folder. The stream in ``streaming.ingest`` takes each file once.

    Rows carry the time of their file, so a second sweep brings the same keys and load times again.
    """
    rows = files.read_csv_drop(spark, drop, dialect)
    land(rows, raw_path, dead_path, "csv", F.col("arrived_at"))


def ingest_bodies(spark: SparkSession, path: str, raw_path: str, dead_path: str) -> None:
    land(files.read_bodies(spark, path), raw_path, dead_path, "http", F.col("arrived_at"))
