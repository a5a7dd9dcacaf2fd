"""Writes to tables on a path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import delete_paths, staging


def _by_day(df: DataFrame, day: str, sort: tuple[str | Column, ...]) -> DataFrame:
    """Evenly sized files per day: a day that holds most rows is split, small days share a task."""
    return df.hint("rebalance", day).sortWithinPartitions(day, *sort)


def append_days(df: DataFrame, path: str, *sort: str | Column, day: str = "date") -> None:
    _by_day(df, day, sort).write.mode("append").partitionBy(day).parquet(path)


def replace_days(
    df: DataFrame, path: str, *sort: str | Column, day: str = "date", days: list | None = None
) -> None:
    """Overwrite the days that ``df`` has rows of, and empty those of ``days`` it has none of.

    All other days stay. With ``days``, ``df`` is read twice.
    """
    writer = _by_day(df, day, sort).write.mode("overwrite").partitionBy(day)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    empty = df.drop(day).limit(0)
    for gone in sorted(set(days) - set(distinct_days(df, day))) if days else ():
        empty.write.mode("overwrite").parquet(f"{path}/{day}={gone}")


def distinct_days(df: DataFrame, day: str = "date") -> list:
    """The days of a frame: at most one row per calendar day reaches the driver."""
    return sorted(row[0] for row in df.select(day).distinct().collect())


def replace_files(path: str, files: list[str], survivors: DataFrame, *sort: str | Column) -> None:
    """Put ``survivors`` in the place of the listed files of the table at ``path``.

    The survivors are appended, then exactly the files they were read from are deleted: a file that
    another job added meanwhile is not touched. Between the two steps, or if the job dies there,
    readers see rows twice, which tables with a key bear; the next run drops the old files again.
    """
    if not files:
        return
    spark = survivors.sparkSession
    with staging(spark) as stage:
        kept = stage(survivors, "survivors")
        append_days(kept, path, *sort)
    delete_paths(spark, files)


def files_of(rows: DataFrame) -> list[str]:
    """The files that hold these rows of a table: names of files reach the driver, no rows.

    ``DataFrame.inputFiles`` would name the files of all days, whatever the filter.
    """
    names = rows.select(F.col("_metadata.file_path").alias("f")).distinct()
    return sorted(row.f for row in names.collect())


def read_files(spark: SparkSession, path: str, files: list[str], schema: T.StructType) -> DataFrame:
    """Just these files of the table at ``path``, with its partition columns."""
    return spark.read.schema(schema).option("basePath", path).parquet(*files)
