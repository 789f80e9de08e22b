"""Publishing state messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from delayengine.streaming.messages import to_messages


def publish_kafka(states: DataFrame, servers: str, topic: str) -> None:
    """One message per state (needs the Spark Kafka package on the classpath)."""
    (
        to_messages(states)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def publish_files(states: DataFrame, folder: str) -> None:
    """The same messages as JSON lines, for a file stream to pick up."""
    to_messages(states).select("value").write.mode("append").text(folder)
