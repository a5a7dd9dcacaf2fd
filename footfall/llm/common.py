"""What several operators share: table readers, row keys, Arrow tasks, text cut into blocks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import ship_package

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: The characters [\x20\x09-\x0D]; ``bytes.split()`` and ``bytes.strip()`` use the same six.
SPACES = " \t\n\x0b\x0c\r"
#: Rows go to Python tasks in batches of so many bytes: the JVM and the worker of each task hold one or two of them.
BATCH_BYTES = 4 << 20
ROW_KEY = ["key_hi", "key_lo"]
#: Ids are broadcast up to this many (16 MB at most); beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.when(F.length(column) == F.octet_length(column), F.lower(column)).otherwise(
        F.translate(column, UPPER, LOWER)
    )


def row_key(*columns: str) -> list[Column]:
    """128 bits that stand for a row: never null, equal only for rows with equal columns."""
    parts = [part for name in columns for part in (F.col(name).isNull(), F.col(name))]
    return [
        F.xxhash64(*parts).alias("key_hi"),
        F.xxhash64(F.lit("second"), *parts).alias("key_lo"),
    ]


def map_batches(
    df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors; a task's memory is given back when it ends.

    The session's batches are bounded by bytes, as the plan runs only when its result is read.
    """
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back_memory()

    return df.mapInArrow(run, schema)


def bound_batches(spark: SparkSession) -> None:
    """Set BATCH_BYTES for the session's Arrow batches, which Spark lets grow to 64 MB; a limit of its own stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) in (None, "67108864b"):
        spark.conf.set(name, BATCH_BYTES)


def give_back_memory() -> None:
    """Return what Arrow and the C library hold unused: a Python worker outlives its task and waits for the next stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def free_shuffles(spark: SparkSession) -> None:
    """Let the shuffle files of finished steps go.

    Spark removes them when the driver's garbage is collected, and a driver that has little to do
    collects none for up to half an hour, however many files there are by then.
    """
    gc.collect()
    spark._jvm.System.gc()


def join_few(big: DataFrame, few: DataFrame, on: list[str], n_few: int, how: str = "inner") -> DataFrame:
    """Join on a side of known row count: broadcast while it is small, shuffled otherwise."""
    return big.join(F.broadcast(few) if n_few <= BROADCAST_ROWS else few, on, how)


def fresh(wanted: str, taken: list[str]) -> str:
    """A column name that does not clash (Spark compares names without case)."""
    used = {name.lower() for name in taken}
    name = wanted
    while name.lower() in used:
        name = f"_{name}"
    return name


def narrow_key(df: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """Like ``row_key``, with an integer id itself as first half (null: the largest number).

    Long lists of it compress better, and it keeps the order of the ids.
    """
    integer = df.schema[id_col].dataType.typeName() in ("long", "integer", "short", "byte")
    hi, lo = row_key(id_col, text_col)
    return [F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("key_hi"), lo] if integer else [hi, lo]
