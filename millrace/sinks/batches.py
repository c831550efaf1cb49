"""Idempotent folder sinks for `foreachBatch`: a replayed batch overwrites its own output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BatchWriter = Callable[[DataFrame, int], None]


def parquet_batches(path: str, shape: Callable[[DataFrame], DataFrame] | None = None) -> BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        out = shape(batch) if shape else batch
        out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("basePath", path).parquet(f"{path}/batch=*")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """Last written value per key; partial aggregation leaves one row per key and task to shuffle."""
    last = F.max_by(F.struct(*fields), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def split_batches(path: str, routes: dict[str, Callable[[DataFrame], DataFrame]]) -> BatchWriter:
    """Several outputs from one pass over a micro-batch, which is cached so the input is read once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, shape in routes.items():
                shape(batch).write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        finally:
            batch.unpersist()

    return write
