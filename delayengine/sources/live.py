"""Raw message streams. Both return a ``value`` text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None, **options: str
) -> DataFrame:
    """One Kafka topic (needs the Spark Kafka package on the classpath)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    for key, setting in options.items():
        reader = reader.option(key, setting)
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("arrived_at"),
    )


def text_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON lines dropped into a folder, standing in for the topic."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder).select("value", F.current_timestamp().alias("arrived_at"))
