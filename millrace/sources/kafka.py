"""Kafka as a source of text records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(servers: str, topic: str, group: str, offsets: str = "latest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": offsets,
    }


def read_kafka(spark: SparkSession, **options: str) -> DataFrame:
    """Needs the Kafka connector on the class path."""
    return decode_value(spark.readStream.format("kafka").options(**options).load())


def decode_value(df: DataFrame) -> DataFrame:
    """Binary record values as text, with the record's own time and position."""
    return df.selectExpr(
        "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "topic", "partition", "offset", "timestamp"
    )
