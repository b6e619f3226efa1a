"""Messages of the event topic, as MESSAGE rows (topic, partition, offset, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import stripped


# Messages taken into one micro-batch, so that a first run over a backlog is many batches of bounded size.
MAX_PER_TRIGGER = 5_000_000


def topic_options(servers: str, topic: str, starting_offsets: str, max_per_trigger: int) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": str(max_per_trigger),
    }


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_per_trigger: int = MAX_PER_TRIGGER,
) -> DataFrame:
    """Subscribe to a Kafka topic. Needs the Kafka connector on the cluster's class path."""
    reader = spark.readStream.format("kafka").options(**topic_options(servers, topic, starting_offsets, max_per_trigger))
    return reader.load().select(
        "topic", "partition", "offset", F.col("value").cast("string").alias("value")
    )


def envelope_text(received_at: Column, sdk_key: Column, events: Column) -> Column:
    """The message value for one request; keys without a value are left out."""
    return F.to_json(
        F.struct(
            received_at.alias("received_at"),
            stripped(sdk_key).alias("sdk_key"),
            events.alias("events"),
        )
    )
