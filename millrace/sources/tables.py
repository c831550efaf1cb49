"""Parquet tables, as batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(
    spark: SparkSession, path: str, schema: str, max_files: int | None = None
) -> DataFrame:
    """New files below `path` arrive as rows; `max_files` bounds one micro-batch.

    The last letter goes into a glob, since a stream accepts a single file only as the match of a glob.
    """
    path = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A literal collection of records."""
    return spark.createDataFrame(rows, schema)
