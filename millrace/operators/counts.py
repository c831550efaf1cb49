"""Page views, visitors, marketing and word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import bitmap_offset
from millrace.functions.times import window_start
from millrace.operators.windows import flat_window
from millrace.sources.text import words


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    return words(lines, column).groupBy("word").agg(F.count("*").alias("n"))


def exact_visitors(df: DataFrame, ts: str, user: str, size: str) -> DataFrame:
    """Distinct users per window, by deduplicating (window, user) first: works on streams, and a window
    with most of the rows is spread over its users."""
    window = F.window(ts, size)
    pairs = df.select(window.alias("window"), F.col(user).alias("_user")).dropDuplicates(["window", "_user"])
    return flat_window(pairs.groupBy("window").agg(F.count("*").alias("uv")))


def visitors(df: DataFrame, user: str) -> DataFrame:
    return df.select(user).distinct().agg(F.count("*").alias("uv"))


def sketch_visitors(df: DataFrame, ts: str, user: str, size: str, error: float = 0.01) -> DataFrame:
    """Approximate distinct users per window from mergeable sketches of fixed size."""
    return flat_window(df.groupBy(F.window(ts, size)).agg(F.approx_count_distinct(user, error).alias("uv")))


def bitmap_visitors(df: DataFrame, ts: str, user: str, size: str) -> DataFrame:
    """Distinct bitmap positions per window; users whose hashes collide count once."""
    hashed = df.select(ts, bitmap_offset(F.col(user)).alias("_offset"))
    return exact_visitors(hashed, ts, "_offset", size)


def bitmap_rows(df: DataFrame, ts: str, user: str, size: str) -> DataFrame:
    """Kept bitmaps: per window the buckets of the bitmap that users fall into, each one binary of fixed size."""
    rows = df.select(window_start(ts, size).alias("window_start"), bitmap_offset(F.col(user)).alias("_offset"))
    bucket = F.bitmap_bucket_number("_offset").alias("bucket")
    return rows.groupBy("window_start", bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_offset")).alias("bitmap"))


def merge_bitmaps(rows: DataFrame, size: str) -> DataFrame:
    """Bitmaps of coarser or the same windows, from those of finer ones or of parts of the data."""
    start = window_start("window_start", size).alias("window_start")
    return rows.groupBy(start, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def bitmap_count(rows: DataFrame) -> DataFrame:
    """Distinct users per window of merged bitmaps."""
    return rows.groupBy("window_start").agg(F.sum(F.bitmap_count("bitmap")).alias("uv"))
