"""CSV drop folder and request bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader

from ..operators import normalise

CSV_GLOB = "*.[cC][sS][vV]"
# File kinds that are never taken for CSV when no file is named .csv.
NEVER_CSV = ("txt", "json", "parquet")
DIALECTS = ("rfc4180", "two_quotes")

# Reads a file line by line, its first line left out, with nothing quoted or escaped. A line that
# holds the separator comes whole in the second column.
_LINE_OPTIONS = {
    "header": "true", "sep": "\x01", "quote": "", "escape": "", "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "whole", "columnPruning": "false",
}


def _has_csv(spark: SparkSession, path: str) -> bool:
    """Whether any file below ``path`` is named .csv; lists names, opens no file."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", CSV_GLOB)
        .load(path)
        .select("path")
    )
    return not listing.isEmpty()


def _not_csv() -> Column:
    return F.lower(F.col("_metadata.file_path")).rlike(rf"\.({'|'.join(NEVER_CSV)})$")


def _written() -> Column:
    """When the file of a row was written; the reader's own time zone takes no part."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.unix_micros(F.col("_metadata.file_modification_time"))
    return epoch + F.make_dt_interval(secs=(micros / F.lit(1_000_000)).cast("decimal(18,6)"))


def csv_fields(
    reader: DataFrameReader | DataStreamReader, path: str, dialect: str, named_csv: bool
) -> DataFrame:
    """CSV files as 23 text fields and ``arrived_at``, when the file was written.

    The first line of a file is skipped.
    """
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {DIALECTS}, not {dialect!r}")
    if named_csv:
        reader = reader.option("pathGlobFilter", CSV_GLOB)
    if dialect == "rfc4180":
        reader = reader.options(header="true", columnPruning="false", **normalise.CSV_OPTIONS)
        found = reader.schema(normalise.CSV_SCHEMA).csv(path)
    else:
        found = reader.options(**_LINE_OPTIONS).schema("line string, whole string").csv(path)
    if not named_csv:
        found = found.where(~_not_csv())
    found = found.withColumn("arrived_at", _written())
    if dialect == "rfc4180":
        return found
    lines = found.select(F.coalesce("whole", "line").alias("line"), "arrived_at")
    return normalise.csv_fields(lines.where(F.trim("line") != ""), "line", dialect, ("arrived_at",))


def csv_rows(
    reader: DataFrameReader | DataStreamReader, path: str, dialect: str, named_csv: bool
) -> DataFrame:
    """CSV files as raw rows. A missing time is the file's, so reading it again gives the same rows."""
    fields = csv_fields(reader, path, dialect, named_csv)
    return normalise.raw_from_csv(
        fields, F.col("arrived_at"), undouble_metadata=dialect == "two_quotes", keep=("arrived_at",)
    )


def body_rows(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    """Request bodies as raw rows. A missing time is the file's."""
    lines = reader.text(path).withColumn("arrived_at", _written())
    return normalise.raw_from_bodies(
        lines.where(F.trim("value") != ""), F.col("arrived_at"), keep=("arrived_at",)
    )


def read_csv_drop(spark: SparkSession, path: str, dialect: str = "rfc4180") -> DataFrame:
    """All CSV files below ``path`` as raw rows with a ``reject_reason`` and ``arrived_at``."""
    reader = spark.read.option("recursiveFileLookup", "true")
    return csv_rows(reader, path, dialect, _has_csv(spark, path))


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """JSON request bodies, one per line, as raw rows with a ``reject_reason`` and ``arrived_at``."""
    return body_rows(spark.read.option("recursiveFileLookup", "true"), path)
