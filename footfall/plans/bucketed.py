"""Raw, processed and clean tables bucketed by their key.

Both sides of the read of a state, and of the anti-join with the processed keys, then lie in the same
buckets: the grouping by key and the join run bucket by bucket, without a shuffle. Rows are shuffled
once, when they are appended. The buckets hash the whole key, so a user with a third of all rows is
spread over all of them.

The files of a table are in the folder named for it and hold their bucket in their names. The catalog
only keeps the layout: a later session declares the table over the same folder.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..session import make_folder
from ..sources import tables
from . import cleaning

BUCKETS = 64  # default; a bucket of a day should fill a file, so it grows with the rows of a day


@dataclass(frozen=True)
class BucketedTables:
    """Tables ``<name>_raw``, ``_processed``, ``_clean`` and ``_invalid`` below one folder."""

    name: str
    home: str
    buckets: int = BUCKETS

    def table(self, part: str) -> str:
        return f"{self.name}_{part}"

    def folder(self, part: str) -> str:
        return f"{self.home}/{part}-{self.buckets}"


PARTS: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "raw": (tables.RAW_TABLE, schemas.RAW_KEY),
    "processed": (tables.PROCESSED_TABLE, schemas.RAW_KEY),
    "clean": (tables.CLEAN_TABLE, schemas.CLEAN_KEY),
    "invalid": (tables.INVALID_TABLE, schemas.INVALID_KEY),
}


def declare(spark: SparkSession, store: BucketedTables) -> None:
    """Create the tables, or find those that an earlier session left in the folder.

    Declaring them with another number of buckets than they were written with would read them wrong,
    so the number is part of the folder's name.
    """
    for part, (schema, keys) in PARTS.items():
        make_folder(spark, store.folder(part))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {store.table(part)} ({columns}) USING parquet"
            f" PARTITIONED BY (date) CLUSTERED BY ({', '.join(keys)}) INTO {store.buckets} BUCKETS"
            f" LOCATION '{store.folder(part)}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {store.table(part)}")


def read(spark: SparkSession, store: BucketedTables, part: str) -> DataFrame:
    return spark.read.table(store.table(part))


def append(rows: DataFrame, store: BucketedTables, part: str) -> None:
    """One file per day and bucket; the columns may be in any order."""
    schema, keys = PARTS[part]
    typed = rows.select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))
    typed.repartition(store.buckets, *keys).write.insertInto(store.table(part))


def state(spark: SparkSession, store: BucketedTables, as_of) -> DataFrame:
    """The clean state, computed inside the buckets."""
    return tables.clean_state(read(spark, store, "clean"), as_of)


def clean(
    spark: SparkSession, store: BucketedTables, as_of: datetime, lookback: timedelta = cleaning.LOOKBACK
) -> DataFrame:
    """``cleaning.clean`` over bucketed tables."""
    return cleaning.route(
        read(spark, store, "raw"), read(spark, store, "processed"),
        lambda rows, part: append(rows, store, part), as_of, lookback,
    )


def drop(spark: SparkSession, store: BucketedTables) -> None:
    """Forget the tables; their files stay."""
    for part in PARTS:
        spark.sql(f"DROP TABLE IF EXISTS {store.table(part)}")
