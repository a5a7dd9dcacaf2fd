"""Repeats kept out of a stream for as long as its rows are kept, and what that state holds.

The keys seen are state of the query, in RocksDB: on local disk with a change log in the checkpoint, so
their number is not bound by the memory of the executors, and a lost executor reloads its share. They
leave the state when the rows they stand for leave the table, not before.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.validate import CLEAN_DAYS

#: Keys are kept as long as the clean rows they stand for.
RETENTION = f"{CLEAN_DAYS} days"
_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_DROPPED = "numDroppedDuplicateRows"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's settings are as before afterwards."""
    before = {name: spark.conf.get(name, None) for name in _ROCKSDB}
    try:
        for name, value in _ROCKSDB.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def first_arrivals(
    rows: DataFrame, arrived: str, keys: tuple[str, ...] = schemas.RAW_KEY, retention: str = RETENTION
) -> DataFrame:
    """The first row of each key; repeats that arrive up to ``retention`` later are dropped.

    ``arrived`` is a timestamp of the load (of the message or the file), never of the event. Null keys
    equal each other. Rows whose arrival is null, or lies more than ``retention`` behind the newest one
    of earlier batches, cannot be told from repeats that are forgotten, and are dropped as late.
    """
    return rows.withWatermark(arrived, retention).dropDuplicatesWithinWatermark(list(keys))


def start_first_arrivals(
    rows: DataFrame, target: str, checkpoint: str, arrived: str, trigger: dict,
    keys: tuple[str, ...] = schemas.RAW_KEY, retention: str = RETENTION,
) -> StreamingQuery:
    """Write the first row of each key to ``target`` as Parquet, with the keys seen in RocksDB."""
    with rocksdb_state(rows.sparkSession):
        writer = first_arrivals(rows, arrived, keys, retention).writeStream.format("parquet")
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(target)


def dropped_repeats(query: StreamingQuery) -> int:
    """Rows this run of a query dropped as repeats, from the progress it reported."""
    return sum(
        operator.customMetrics.get(_DROPPED, 0) for progress in query.recentProgress for operator in progress.stateOperators
    )


def held_keys(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per key a stopped query holds: its columns, and ``held_until``, when it may be forgotten.

    Read from the checkpoint by Spark's state reader, one task per partition of the state.
    """
    with rocksdb_state(spark):
        state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.*", F.timestamp_micros("value.expiresAtMicros").alias("held_until"))
