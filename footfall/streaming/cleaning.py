"""Cleaning as a stream over the raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import keyed, validate
from ..plans import cleaning
from ..session import staging
from ..sources import tables


def stream_raw(spark: SparkSession, raw_path: str, files_per_batch: int | None = None) -> DataFrame:
    """Rows of the raw table in the order their files arrive, whatever day they belong to."""
    reader = spark.readStream.schema(tables.RAW_TABLE)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(raw_path)


def start_cleaning(
    raw: DataFrame, paths: cleaning.CleaningPaths, checkpoint: str, trigger: dict
) -> StreamingQuery:
    """Clean every micro-batch of raw rows; a late row is cleaned when it comes, no range is scanned again.

    The checkpoint knows which rows are taken, so nothing is joined with the processed keys; these are
    listed all the same, for ``compact_raw``. Every row is judged at the time it was ingested and
    stored with that time. A version that arrives after a newer one therefore loses to it in
    ``clean_state``, and a batch that is repeated after a failure writes the same rows again.
    """

    def clean(batch: DataFrame, _batch_id: int) -> None:
        at = F.col("ingested_at")
        current = keyed.last_write_wins(batch, schemas.RAW_KEY)
        with staging(batch.sparkSession) as stage:
            validated = stage(validate.with_validation(current, at), "validated")
            cleaning.put_validated(validated, cleaning.appender(paths), at)

    writer = raw.writeStream.foreachBatch(clean)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
