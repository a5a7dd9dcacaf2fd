"""What a stream accepted and refused, batch by batch, and which batches are written.

Counts are observed inside the streaming plan while its rows pass to the sink, so nothing is read
twice for them. A listener stores them as they are reported.
"""

from __future__ import annotations

from collections import defaultdict
from threading import Event

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators import normalise
from ..sources import tables

OBSERVED = "landed"
COUNTS = "source string, batch_id long, accepted long, refused long, success_rate double"
LEDGER = "source string, batch_id long"


def stream_name(source: str, checkpoint: str) -> str:
    """Names a stream by what it reads; its checkpoint keeps several of one source apart."""
    return f"{source}@{checkpoint}"


def observed(rows: DataFrame) -> DataFrame:
    """``rows``, with the accepted and refused ones counted as they pass."""
    refused = F.col(normalise.REJECT).isNotNull()
    return rows.observe(OBSERVED, F.count_if(~refused).alias("accepted"), F.count_if(refused).alias("refused"))


class BatchCounts(StreamingQueryListener):
    """Stores one row per batch of a named stream that had rows below ``path``.

    ``close`` waits until the end of the stream has been reported, then stops listening.
    """

    def __init__(self, spark: SparkSession, path: str, source: str) -> None:
        self._spark, self._path, self._source = spark, path, source
        self._ended: defaultdict[str, Event] = defaultdict(Event)
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(OBSERVED) if (progress.name or "").startswith(f"{self._source}@") else None
        if found is None or found.accepted + found.refused == 0:
            return
        total = found.accepted + found.refused
        row = (self._source, progress.batchId, found.accepted, found.refused, round(100.0 * found.accepted / total, 2))
        self._spark.createDataFrame([row], COUNTS).coalesce(1).write.mode("append").parquet(self._path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def close(self, query: StreamingQuery) -> None:
        query.awaitTermination()
        self._ended[str(query.runId)].wait(60)
        self._spark.streams.removeListener(self)


def is_written(spark: SparkSession, ledger: str, source: str, batch_id: int) -> bool:
    listed = tables.read_table(spark, ledger, spark.createDataFrame([], LEDGER).schema, may_be_absent=True)
    return not listed.where((F.col("source") == source) & (F.col("batch_id") == batch_id)).isEmpty()


def mark_written(spark: SparkSession, ledger: str, source: str, batch_id: int) -> None:
    spark.createDataFrame([(source, batch_id)], LEDGER).coalesce(1).write.mode("append").parquet(ledger)
