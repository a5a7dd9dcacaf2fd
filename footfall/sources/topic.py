"""The message topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOPIC = "app.messages"  # fixed value


def _options(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    messages_per_batch: int | None = None,
) -> DataFrame:
    """The topic as a stream. Needs the Kafka connector on the class path.

    A run takes all there is; ``messages_per_batch`` bounds a micro-batch where memory needs it. What
    the topic dropped before it was read is an error.
    """
    reader = spark.readStream.format("kafka").options(**_options(servers, topic))
    if messages_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", messages_per_batch)
    return reader.load()


def read_topic(spark: SparkSession, servers: str, topic: str = TOPIC) -> DataFrame:
    """Everything the topic holds now, as a batch."""
    return spark.read.format("kafka").options(**_options(servers, topic)).load()
