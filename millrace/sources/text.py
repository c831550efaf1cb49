"""Lines, delimited records and access-log lines.  All of it works on batch and streaming input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.times import parse_log_time


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of a file, folder or glob, on any Hadoop file system."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of files dropped into a folder."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def words(df: DataFrame, column: str = "value") -> DataFrame:
    """Blank-separated tokens; blanks at the end of a line give no token."""
    line = F.explode(F.split(column, "\n")).alias("_line")
    tokens = F.explode(F.split(F.rtrim("_line"), " ")).alias("word")
    return df.select(line).where(F.rtrim("_line") != "").select(tokens)


def _fields(column: str, sep: str, schema: str) -> tuple[Column, StructType]:
    return F.split(column, f"\\Q{sep}\\E"), StructType.fromDDL(schema)


def parse_delimited(df: DataFrame, schema: str, sep: str = ",", column: str = "value") -> DataFrame:
    """Typed records; a malformed number fails the job (ANSI cast)."""
    parts, fields = _fields(column, sep, schema)
    return df.select(
        *[F.get(parts, F.lit(i)).cast(f.dataType).alias(f.name) for i, f in enumerate(fields)]
    )


def split_rejects(
    df: DataFrame, schema: str, sep: str = ",", column: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Typed records, and the lines in which some field is missing or does not parse."""
    parts, fields = _fields(column, sep, schema)
    parsed = df.select(
        F.col(column).alias("_line"),
        *[F.get(parts, F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)],
    )
    names = [f.name for f in fields]
    bad = F.greatest(*[F.col(n).isNull() for n in names], F.lit(False))
    return parsed.where(~bad).select(*names), parsed.where(bad).select(F.col("_line").alias(column))


def parse_access_log(df: DataFrame, column: str = "value") -> DataFrame:
    """`ip - user time zone method url` lines: blank-separated fields 0, 1, 3, 5 and 6."""
    field = F.split(column, " ")
    return df.select(
        F.get(field, F.lit(0)).alias("ip"),
        F.get(field, F.lit(1)).alias("user_id"),
        parse_log_time(F.get(field, F.lit(3))).alias("ts"),
        F.get(field, F.lit(5)).alias("method"),
        F.get(field, F.lit(6)).alias("url"),
    )
