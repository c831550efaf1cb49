"""JSON documents, Kafka payloads, delimited files, JDBC rows and console output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_document(df: DataFrame, field: str = "data", column: str = "value") -> DataFrame:
    """One JSON document per row with the text under `field`."""
    return df.select(F.to_json(F.struct(F.col(column).alias(field))).alias("value"))


def document_batches(path: str, field: str = "data", column: str = "value") -> Callable[[DataFrame, int], None]:
    """Streaming index of documents, one folder per micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        as_document(batch, field, column).write.mode("overwrite").text(f"{path}/batch={batch_id}")

    return write


def kafka_payload(df: DataFrame, key: Column | None = None) -> DataFrame:
    """Rows as Kafka records: the whole row as JSON in `value`."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(value) if key is None else df.select(key.cast("string").alias("key"), value)


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Needs the Kafka connector on the class path."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    kafka_payload(df).write.format("kafka").options(**options).save()


def write_delimited(df: DataFrame, path: str, sep: str = "|") -> None:
    df.write.mode("overwrite").option("sep", sep).csv(path)


def jdbc_options(url: str, table: str, user: str, password: str, batch_rows: int = 10_000) -> dict[str, str]:
    return {
        "url": url, "dbtable": table, "user": user, "password": password, "batchsize": str(batch_rows),
    }


def jdbc_batches(options: dict[str, str]) -> Callable[[DataFrame, int], None]:
    """Append each micro-batch to a database table; every task opens one connection and inserts in batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("jdbc").options(**options).mode("append").save()

    return write


def show(df: DataFrame, prefix: str = "", rows: int = 20) -> None:
    """Print a few rows, each behind an optional prefix; a stream goes to the console sink."""
    out = df.select(F.concat(F.lit(prefix and prefix + "> "), F.to_json(F.struct("*"))).alias("value"))
    if df.isStreaming:
        out.writeStream.format("console").option("truncate", "false").trigger(availableNow=True).start().awaitTermination()
    else:
        out.show(rows, truncate=False)
