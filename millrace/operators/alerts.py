"""Alerts on keyed event sequences: rising values, login risk, click blacklist, order timeout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.times import interval
from millrace.operators.chains import span_starts
from millrace.plans.chunks import CHUNK, layout, run_count, run_last


def rise_alerts(
    df: DataFrame, keys: list[str], order: list[str], value: str, hold: str, floor: float = -1
) -> DataFrame:
    """A value that keeps rising for `hold`.

    A row rises if its value is above the key's previous one (above `floor` for the first row).  The first
    rising row starts a timer; a row that does not rise, up to and including the deadline, cancels it; after
    an alert the next rising row starts a new one.  Timers pending at the end of the data fire.
    """
    spans = rise_spans(df, keys, order, value, hold, floor)
    fires = F.col("broken_at").isNull() | (F.col("broken_at") > F.col("alert_ts"))
    return spans.where(fires).drop("broken_at")


def rise_spans(
    df: DataFrame, keys: list[str], order: list[str], value: str, hold: str, floor: float = -1, known: str | None = None
) -> DataFrame:
    """All timers of `rise_alerts`: `rise_start`, the deadline `alert_ts`, and `broken_at`, the next row of the key that
    does not rise.  Where the column `known` is not null it says whether a row rises."""
    ts = order[0]
    plan = layout(df, keys, order)
    columns = [*keys, *order, value, *([known] if known else [])]
    rows = plan.neighbour(plan.assign(df.select(*columns)), "_before", [value])
    rises = F.col(value) > F.coalesce(F.col(f"_before.{value}"), F.lit(floor))
    rows = rows.withColumn("_rises", F.coalesce(known, rises) if known else rises)
    # Rows of one rise have the same number of breaks ahead of them, the next one at `_broken_at`.
    breaks = ~F.col("_rises")
    rows = plan.running(
        rows, reverse=True, _run=run_count(breaks), _broken_at=run_last(F.when(breaks, F.col(ts)), strict=True)
    )
    group = [*keys, "_run", "_broken_at"]
    rising = rows.where("_rises").select(*group, *order, CHUNK)
    starts = span_starts(plan.settle(rising), plan.refine(group), hold)
    deadline = F.col("start") + interval(hold)
    return starts.select(*keys, F.col("start").alias("rise_start"), deadline.alias("alert_ts"), F.col("_broken_at").alias("broken_at"))


def login_risk(
    df: DataFrame, keys: list[str], order: list[str], failed: Column, succeeded: Column, reach: str, least: int = 2
) -> DataFrame:
    """At least `least` failures from the first one up to `reach` later, or up to a success before that."""
    ts, unique = order
    plan = layout(df, keys, order)
    rows = plan.assign(df.select(*keys, *order, failed.alias("_bad"), succeeded.alias("_good")))
    rows = rows.where("_bad or _good")
    good = F.col("_good")
    rows = plan.running(rows, reverse=True, _part=run_count(good), _good_at=run_last(F.when(good, F.col(ts)), strict=True))
    group = [*keys, "_part", "_good_at"]
    fails = plan.settle(rows.where("_bad").select(*group, *order, CHUNK))
    runs = plan.refine(group)
    starts = span_starts(fails, runs, reach)
    # Put the starts into the order of the failures and hand each failure the latest start.
    markers = starts.select(*group, F.col("start").alias(ts), F.lit(None).cast(df.schema[unique].dataType).alias(unique))
    merged = fails.drop(CHUNK).withColumn("_start", F.lit(None).cast(df.schema[ts].dataType)).unionByName(
        markers.withColumn("_start", F.col(ts))
    )
    placed = runs.running(plan.assign(merged), first_fail=run_last(F.col("_start")))
    counted = placed.where(F.col(unique).isNotNull()).groupBy(*group, "first_fail").agg(F.count("*").alias("fails"))
    end = F.col("first_fail") + interval(reach)
    return counted.where(F.col("fails") >= least).select(
        *keys, "first_fail", "fails", F.coalesce(F.least(F.col("_good_at"), end), end).alias("alert_ts")
    )


def utc_day(ts: str) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def daily_rank(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    per_day = Window.partitionBy(*keys, "day").orderBy(*order)
    return df.withColumn("day", utc_day(order[0])).withColumn("nth", F.row_number().over(per_day).cast("long"))


def blacklist_pass(df: DataFrame, keys: list[str], order: list[str], limit: int) -> DataFrame:
    """The first `limit` rows of each key and UTC day.  Spark trims groups to the limit before the shuffle."""
    return daily_rank(df, keys, order).where(F.col("nth") <= limit)


def blacklist_alerts(df: DataFrame, keys: list[str], order: list[str], limit: int) -> DataFrame:
    """One alert per key and UTC day, at the row after the limit."""
    return daily_rank(df, keys, order).where(F.col("nth") == limit + 1)


def order_outcomes(
    df: DataFrame, order_id: str, ts: str, created: Column, paid: Column, limit: str
) -> DataFrame:
    """`paid` within the limit (inclusive), `paid_late`, `timeout` without payment, `create_missing`."""
    per_order = df.groupBy(order_id).agg(
        F.min(F.when(created, F.col(ts))).alias("create_ts"), F.min(F.when(paid, F.col(ts))).alias("pay_ts")
    )
    outcome = (
        F.when(F.col("create_ts").isNull(), "create_missing")
        .when(F.col("pay_ts").isNull(), "timeout")
        .when(F.col("pay_ts") <= F.col("create_ts") + interval(limit), "paid")
        .otherwise("paid_late")
    )
    known = F.col("create_ts").isNotNull() | F.col("pay_ts").isNotNull()
    return per_order.where(known).withColumn("outcome", outcome)
