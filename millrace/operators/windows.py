"""Time and count windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import from_micros, interval, span_us, to_micros, window_start
from millrace.plans.chunks import layout, run_count


def tumble(
    df: DataFrame, ts: str, size: str, keys: list[str], *aggs: Column, offset: str | None = None
) -> DataFrame:
    """Aggregates per key and tumbling window; without keys, per window.  Batch and streaming."""
    window = F.window(ts, size, startTime=offset) if offset else F.window(ts, size)
    return flat_window(df.groupBy(window, *keys).agg(*aggs))


def slide(df: DataFrame, ts: str, size: str, slide_by: str, keys: list[str], *aggs: Column) -> DataFrame:
    """Aggregates per key and sliding window.  Batch and streaming; copies rows size/slide times, so
    `slide_count` is the one to use for counts over batch tables."""
    return flat_window(df.groupBy(F.window(ts, size, slide_by), *keys).agg(*aggs))


def tumble_processing_time(df: DataFrame, size: str, keys: list[str], *aggs: Column) -> DataFrame:
    """Tumbling windows on the time a micro-batch is processed."""
    return tumble(df.withColumn("_now", F.current_timestamp()), "_now", size, keys, *aggs)


def flat_window(df: DataFrame) -> DataFrame:
    """The window struct as `window_start` and `window_end`."""
    kept = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *kept)


def pane_counts(df: DataFrame, ts: str, size: str, slide_by: str, keys: list[str]) -> DataFrame:
    """Counts per pane, the largest slice that every sliding window either holds whole or not at all."""
    pane = math.gcd(span_us(size), span_us(slide_by))
    us = to_micros(ts)
    return df.groupBy((us - F.pmod(us, F.lit(pane))).alias("_pane"), *keys).agg(F.count("*").alias("n"))


def slide_count(df: DataFrame, ts: str, size: str, slide_by: str, keys: list[str]) -> DataFrame:
    """Row count per key and sliding window, from pane counts: only pane totals are copied into the
    size/slide windows they belong to, never rows."""
    width, step = span_us(size), span_us(slide_by)
    panes = pane_counts(df, ts, size, slide_by, keys)
    last = F.col("_pane") - F.pmod("_pane", F.lit(step))
    left_edge = F.col("_pane") - width
    first = left_edge - F.pmod(left_edge, F.lit(step)) + step
    copies = panes.select(*keys, "n", F.explode(F.sequence(first, last, F.lit(step))).alias("_start"))
    totals = copies.groupBy("_start", *keys).agg(F.sum("n").alias("n"))
    return totals.select(
        from_micros(F.col("_start")).alias("window_start"),
        from_micros(F.col("_start") + width).alias("window_end"),
        *keys,
        "n",
    )


def sessions(df: DataFrame, ts: str, gap: str, keys: list[str], order: list[str], *aggs: Column) -> DataFrame:
    """Session windows over a batch table.  A row later than the gap after its predecessor opens a new
    session; exactly one gap apart still belongs together, as in Spark's `session_window`."""
    plan = layout(df, keys, order)
    rows = plan.neighbour(plan.assign(df), "_before", [ts])
    opens = F.col("_before").isNull() | (F.col(ts) > F.col(f"_before.{ts}") + interval(gap))
    rows = plan.running(rows, _session=run_count(opens))
    bounds = [F.min(ts).alias("session_start"), (F.max(ts) + interval(gap)).alias("session_end")]
    return rows.groupBy(*keys, "_session").agg(*bounds, *aggs).drop("_session")


def session_stream(df: DataFrame, ts: str, gap: str, keys: list[str], *aggs: Column) -> DataFrame:
    """Session windows over a stream."""
    out = df.groupBy(F.session_window(ts, gap), *keys).agg(*aggs)
    kept = [c for c in out.columns if c != "session_window"]
    return out.select(
        F.col("session_window.start").alias("session_start"),
        F.col("session_window.end").alias("session_end"),
        *kept,
    )


def count_tumble(df: DataFrame, keys: list[str], order: list[str], size: int, *aggs: Column) -> DataFrame:
    """Every `size` rows of a key form a window; an incomplete last one gives nothing."""
    rows = layout(df, keys, order).running(df, _nth=run_count())
    number = F.floor((F.col("_nth") - 1) / size).cast("long").alias("window_no")
    return (
        rows.groupBy(*keys, number)
        .agg(F.count("*").alias("_rows"), *aggs)
        .where(F.col("_rows") == size)
        .drop("_rows")
    )


def count_slide(
    df: DataFrame, keys: list[str], order: list[str], size: int, slide_by: int, *aggs: Column
) -> DataFrame:
    """After every `slide_by`-th row of a key, aggregates over its last `size` rows at most.

    A row joins the ceil(size/slide) firings it is part of; the firing exists if its own row does.
    """
    rows = layout(df, keys, order).running(df, _nth=run_count())
    nth = F.col("_nth")
    first = F.ceil(nth / slide_by).cast("long") * slide_by
    upto = nth + size - 1
    fired = F.when(first <= upto, F.sequence(first, upto, F.lit(slide_by).cast("long")))
    return (
        rows.withColumn("fired_at", F.explode(fired))
        .groupBy(*keys, "fired_at")
        .agg(F.max("_nth").alias("_newest"), *aggs)
        .where(F.col("_newest") == F.col("fired_at"))
        .drop("_newest")
    )


def fire_per_row(df: DataFrame, ts: str, size: str, order: list[str], out: str = "n") -> DataFrame:
    """Result of a tumbling window after each of its rows, as a fire-on-every-element trigger emits it."""
    start = window_start(ts, size)
    rows = df.withColumns({"window_start": start, "window_end": start + interval(size)})
    return layout(rows, ["window_start"], order).running(rows, **{out: run_count()})
