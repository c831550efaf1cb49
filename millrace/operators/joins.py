"""Window joins, interval joins, two-sided reconciliation, null-aware exclusion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import interval, span_us, to_micros, window_start
from millrace.plans.chunks import layout, run_count
from millrace.plans.skew import salted_join


def window_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, size: str
) -> DataFrame:
    """Rows with the same keys in the same tumbling window; batch, skew-safe on (key, window)."""
    a = left.withColumn("window_start", window_start(left_ts, size))
    b = right.withColumn("window_start", window_start(right_ts, size))
    return salted_join(a, b, [*keys, "window_start"])


def _in_buckets(
    left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, low: int, high: int
) -> tuple[DataFrame, DataFrame]:
    """Cut time into buckets as wide as the interval [-low, +high] around a left row.  A right row lies in one
    bucket and a left row is sent to the two its interval can touch, so that a range predicate becomes an
    equi-join on the bucket, in which each pair meets once."""
    width = max(low + high, 1)
    us = to_micros(left_ts)
    bucket_of = lambda at: (at - F.pmod(at, F.lit(width))).cast("long")
    reach = F.sequence(bucket_of(us - low), bucket_of(us + high), F.lit(width).cast("long"))
    return left.withColumn("_bucket", F.explode(reach)), right.withColumn("_bucket", bucket_of(to_micros(right_ts)))


def interval_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, before: str, after: str
) -> DataFrame:
    """Rows with the same keys and `right_ts` in [left_ts - before, left_ts + after]; batch."""
    a, b = _in_buckets(left, right, left_ts, right_ts, span_us(before), span_us(after))
    near = F.col(right_ts).between(F.col(left_ts) - interval(before), F.col(left_ts) + interval(after))
    return salted_join(a, b, [*keys, "_bucket"], where=near).drop("_bucket")


def interval_join_stream(
    left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, before: str, after: str,
    how: str = "inner",
) -> DataFrame:
    """The same on two watermarked streams; the range bounds the join state on both sides.

    An inner join runs on time buckets too, which spreads the state of a hot key over all partitions.  An
    outer join cannot: a left row would look unmatched in one of its two buckets.
    """
    on = list(keys)
    if how == "inner":
        left, right = _in_buckets(left, right, left_ts, right_ts, span_us(before), span_us(after))
        on.append("_bucket")
    match = F.col(right_ts).between(F.col(left_ts) - interval(before), F.col(left_ts) + interval(after))
    for k in on:
        right = right.withColumnRenamed(k, f"_r_{k}")
        match = match & (F.col(k) == F.col(f"_r_{k}"))
    return left.join(right, match, how).drop("_bucket", *[f"_r_{k}" for k in on])


def right_join(left: DataFrame, right: DataFrame, on: list[str], left_by: list[str], right_by: list[str]) -> DataFrame:
    """Right outer join whose left side may have hot keys: a hot key of the side that is not kept cannot be
    split in an outer join, so the matches come from a salted inner join and the rest from an anti join."""
    matched = salted_join(left, right, on, left_by=left_by, right_by=right_by)
    alone = right.join(left.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def reconcile(
    left: DataFrame, right: DataFrame, key: str, left_order: list[str], right_order: list[str]
) -> DataFrame:
    """Pair the n-th left row of a key with its n-th right row, whichever came first; each row is used
    once.  Rows without a partner stay, with nulls on the other side.  (key, pair_no) is unique on both
    sides, so a key with very many rows spreads over all tasks."""
    a = layout(left, [key], left_order).running(left, pair_no=run_count())
    b = layout(right, [key], right_order).running(right, pair_no=run_count())
    both = a.withColumn("_in_left", F.lit(True)).join(b.withColumn("_in_right", F.lit(True)), [key, "pair_no"], "full")
    side = (
        F.when(F.col("_in_left").isNull(), "right_only").when(F.col("_in_right").isNull(), "left_only").otherwise("matched")
    )
    return both.withColumn("side", side).drop("_in_left", "_in_right")


def exclude(df: DataFrame, others: DataFrame, column: str, other: str) -> DataFrame:
    """`column NOT IN (SELECT other FROM others)` with SQL null rules, as a shuffled anti join.

    The planner broadcasts the whole subquery of a NOT IN; here only one row of null statistics is
    looked up, so the excluded set may be of any size.
    """
    keys = others.select(F.col(other).alias("_k"))
    spark = df.sparkSession
    stats = keys.agg(F.count("*").alias("total"), F.count("_k").alias("known"))
    keep = df.join(keys.distinct(), F.col(column) == F.col("_k"), "left_anti")
    return spark.sql(
        f"SELECT * FROM {{rows}} WHERE (SELECT total = known FROM {{stats}}) "
        f"AND (`{column}` IS NOT NULL OR (SELECT total = 0 FROM {{stats}}))",
        rows=keep,
        stats=stats,
    )
