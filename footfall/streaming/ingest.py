"""Topic and drop folder as streams into the raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from .. import schemas
from ..operators import normalise
from ..plans.ingest import land
from ..sources import files
from . import counts

EVERY_MINUTE = {"processingTime": "1 minute"}
DRAIN = {"availableNow": True}


def start_ingest(
    rows: DataFrame, raw_path: str, dead_path: str, checkpoint: str, source: str, trigger: dict,
    arrived: str = "arrived_at", ledger: str | None = None,
) -> StreamingQuery:
    """Land every micro-batch. The checkpoint holds the offsets and moves on after the writes.

    Rows bring their own load time in ``arrived`` (of the message or the file), so a batch that is
    written again after a failure is the same batch. With a ``ledger`` every written batch is listed
    there, and one that is listed is not written again: a replay appends nothing. A batch that died
    between its rows and its line in the ledger is repeated, and readers keep the last write of a key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if ledger and counts.is_written(spark, ledger, source, batch_id):
            return
        land(batch, raw_path, dead_path, source, F.col(arrived))
        if ledger:
            counts.mark_written(spark, ledger, source, batch_id)

    writer = counts.observed(rows).writeStream.queryName(counts.stream_name(source, checkpoint)).foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def decode_topic(messages: DataFrame) -> DataFrame:
    """Topic rows -> raw rows. A missing time becomes the time the topic stamped on the message."""
    stamped = messages.withColumn("arrived_at", F.col("timestamp").cast("timestamp_ntz"))
    return normalise.raw_from_messages(
        stamped, F.col("arrived_at"), column="value", keep=("arrived_at",)
    )


def _limited(reader: DataStreamReader, files_per_batch: int | None) -> DataStreamReader:
    return reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)


def stream_csv_drop(
    spark: SparkSession, drop: str, dialect: str = "rfc4180", files_per_batch: int | None = None,
    any_name: bool = False, archive: str | None = None,
) -> DataFrame:
    """CSV files of a drop folder; each is read once, when it turns up, with the time it was written.

    A folder whose files are not named .csv is read with ``any_name``: all files then count but those
    of kinds that are never CSV. With an ``archive``, a folder outside the drop, files move there once
    their batch is committed, which the stream notes with the batch after: the folder empties itself
    and holds the files of the last batch until more arrive.
    """
    reader = _limited(spark.readStream.option("recursiveFileLookup", "true"), files_per_batch)
    if archive is not None:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive)
    return files.csv_rows(reader, drop, dialect, named_csv=not any_name)


def stream_bodies(spark: SparkSession, drop: str, files_per_batch: int | None = None) -> DataFrame:
    """Request bodies, one per line, of a folder; each file is read once, when it turns up."""
    reader = _limited(spark.readStream.option("recursiveFileLookup", "true"), files_per_batch)
    return files.body_rows(reader, drop)


def drop_repeats(
    rows: DataFrame, keys: tuple[str, ...] = schemas.RAW_KEY, delay: str = "1 day"
) -> DataFrame:
    """Let the first row of a key through and drop repeats that arrive within ``delay``.

    The watermark follows the arrival of rows, not the time their sender wrote on them: a row with a
    time far in the future ages nothing, and a row from long ago is still let through. The state
    holds the keys that arrived in the last ``delay``.
    """
    return (
        rows.withColumn("arrival", F.current_timestamp())
        .withWatermark("arrival", delay)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop("arrival")
    )
