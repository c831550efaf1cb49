"""Exact per-record watermarks over a recorded arrival order, and what they do to late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import interval, window_start
from millrace.plans.chunks import layout, run_count, run_max


def watermark_trace(df: DataFrame, ts: str, arrival: list[str], delay: str) -> DataFrame:
    """`wm_before` and `wm_after` each row: highest event time so far minus the delay, as an assigner
    called per record gives it."""
    top = {"_top_before": run_max(F.col(ts), strict=True), "_top": run_max(F.col(ts))}
    rows = layout(df, [], arrival).running(df, **top)
    return rows.withColumns(
        {"wm_before": F.col("_top_before") - interval(delay), "wm_after": F.col("_top") - interval(delay)}
    ).drop("_top_before", "_top")


def late_rows(df: DataFrame, ts: str, arrival: list[str], size: str, delay: str, lateness: str) -> DataFrame:
    """Each row with its window and `status`: `on_time`, `late` (window fired, still open) or `dropped`.

    A window [s, e) fires when the watermark reaches e - 1 ms and closes `lateness` after that.
    """
    start = window_start(ts, size)
    rows = watermark_trace(df, ts, arrival, delay).withColumns(
        {"window_start": start, "window_end": start + interval(size)}
    )
    fires = F.col("window_end") - interval("1 millisecond")
    passed = lambda at: F.coalesce(at <= F.col("wm_before"), F.lit(False))
    status = F.when(passed(fires + interval(lateness)), "dropped").when(passed(fires), "late").otherwise("on_time")
    return rows.withColumn("status", status)


def late_audit(df: DataFrame, ts: str, arrival: list[str], size: str, delay: str, lateness: str) -> DataFrame:
    """The rows that came after their window had fired: refiring it, or left to the late output."""
    return late_rows(df, ts, arrival, size, delay, lateness).where(F.col("status") != "on_time")


def lateness_firings(
    df: DataFrame, ts: str, arrival: list[str], size: str, delay: str, lateness: str, keys: list[str]
) -> DataFrame:
    """All results of a window with allowed lateness: the on-time one (`firing` 0) and one per late row."""
    group = [*keys, "window_start", "window_end"]
    start = window_start(ts, size)
    windows = df.withColumns({"window_start": start, "window_end": start + interval(size)})
    plan = layout(windows, group, arrival)
    marked = late_rows(df, ts, arrival, size, delay, lateness).select(*group, *arrival, "status")
    kept = plan.settle(marked.where(F.col("status") != "dropped"))
    rows = plan.running(kept, n=run_count(), firing=run_count(F.col("status") == "late"))
    late = rows.where(F.col("status") == "late").select(*group, "firing", "n")
    on_time = kept.where(F.col("status") == "on_time").groupBy(*group).agg(F.count("*").alias("n"))
    return on_time.select(*group, F.lit(0).cast("long").alias("firing"), "n").unionByName(late)
