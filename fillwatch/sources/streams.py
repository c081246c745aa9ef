"""Where JSON messages come from: a Kafka topic, or files with the same contract."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Consumer settings.
KAFKA_DEFAULT_SERVERS = "localhost:9092"
KAFKA_OPTIONS = {
    "startingOffsets": "latest",
    "failOnDataLoss": "true",
    "kafka.consumer.request.timeout.ms": "20000",
    "kafka.consumer.session.timeout.ms": "10000",
}

ARRIVAL = ("arrived_at", "arrived_partition", "arrived_offset")
"""Columns that tell the order messages came in."""


def kafka_options(topic: str, servers: str | None = None, **overrides: str) -> dict[str, str]:
    servers = servers or os.environ.get("KAFKA_BOOTSTRAP", KAFKA_DEFAULT_SERVERS)
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        **KAFKA_OPTIONS,
        **{k: str(v) for k, v in overrides.items()},
    }


def kafka_json(
    spark: SparkSession, topic: str, servers: str | None = None, **overrides: str
) -> DataFrame:
    """Stream of one topic's payloads; needs the Spark Kafka package on the class path.

    A trigger takes all that has come, unless ``maxOffsetsPerTrigger`` is given; messages that
    Kafka dropped before they were read are an error, unless ``failOnDataLoss`` is ``false``.
    """
    options = kafka_options(topic, servers, **overrides)
    return payload(spark.readStream.format("kafka").options(**options).load())


def payload(messages: DataFrame) -> DataFrame:
    """The value as ``json_str``, plus the message's place in the topic."""
    return messages.select(
        F.col("value").cast("string").alias("json_str"),
        F.col("timestamp").alias("arrived_at"),
        F.col("partition").alias("arrived_partition"),
        F.col("offset").alias("arrived_offset"),
    )


def file_json(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same stream over a folder of JSON-lines files, for backfills and tests."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # lines of a file block have no place of their own: a hash of the text puts them in an order
    # that every pass over them agrees on
    return reader.text(path).select(
        F.col("value").alias("json_str"),
        F.col("_metadata.file_modification_time").alias("arrived_at"),
        F.shiftright("_metadata.file_block_start", 20).cast("int").alias("arrived_partition"),
        F.xxhash64("value").alias("arrived_offset"),
    )
