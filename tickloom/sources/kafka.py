"""Topic sources and sinks; they need the Spark Kafka package on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

# Topic names and the producer settings of the message sinks.
TICK_TOPIC = "market-ticks"
EVENT_TOPIC = "portfolio-events"
ALERT_TOPIC = "risk-alerts"
PRODUCER_OPTIONS = {"kafka.acks": "1", "kafka.linger.ms": "5"}


def topic_stream(
    spark: SparkSession, servers: str, topic: str = TICK_TOPIC, starting: str = "latest", **options
) -> DataFrame:
    """Streaming (key, value) messages of a topic."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
        .select("key", "value")
    )


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish a batch of (key, value) messages."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**PRODUCER_OPTIONS)
        .save()
    )


def topic_writer(
    messages: DataFrame, servers: str, checkpoint: str, topic: str = ALERT_TOPIC
) -> DataStreamWriter:
    """Publish a stream of (key, value) messages; the caller sets the trigger and starts it."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .options(**PRODUCER_OPTIONS)
    )
