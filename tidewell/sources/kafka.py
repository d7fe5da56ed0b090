"""Kafka transport: options and payloads. The connector jar is not part of the image, so only these are tested."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source_options(servers: str, topic: str, starting: str = "latest", fail_on_data_loss: bool = False, max_per_trigger: int | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest", max_per_trigger: int | None = None) -> DataFrame:
    """Raw messages with key, value, topic, partition, offset and timestamp."""
    return spark.readStream.format("kafka").options(**source_options(servers, topic, starting, max_per_trigger=max_per_trigger)).load()


def range_options(servers: str, topic: str, since_ms: int) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingTimestamp": str(since_ms), "endingOffsets": "latest"}


def kafka_range(spark: SparkSession, servers: str, topic: str, since_ms: int, limit: int) -> DataFrame:
    """Most recent messages since a time, newest first."""
    return newest(spark.read.format("kafka").options(**range_options(servers, topic, since_ms)).load(), limit)


def newest(messages: DataFrame, limit: int) -> DataFrame:
    text = messages.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})
    return text.orderBy(F.col("timestamp").desc(), "partition", F.col("offset").desc()).limit(limit)


def to_messages(df: DataFrame, key: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as (key, value) with a JSON value."""
    value = F.to_json(F.struct(*(columns or df.columns))).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None, trigger: str = "10 seconds"):
    """Start a stream that appends rows to a topic."""
    return (
        to_messages(df, key).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(processingTime=trigger).start()
    )
