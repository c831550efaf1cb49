"""What watermarks drop from a feed that arrives out of order.

Every event arrives up to 23 hours after its event time.  The feed is delivered in PARTS deliveries by arrival time;
each is one micro-batch, followed by one without data that moves the watermark on.  So a window is closed for a
delivery if it ends at or before the watermark that the earlier deliveries have reached, and its rows are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.routing import union_all
from millrace.operators.windows import tumble
from millrace.plans.staging import fresh_dir
from millrace.queries.registry import events, query, row_count
from millrace.sinks.batches import BatchWriter, parquet_batches, read_batches
from millrace.sources.tables import stream_table
from millrace.streaming.replay import EndMarker, drain

PARTS = 4
HOUR_US = 3_600_000_000

def sql_parts(columns: str = "event_type, ts", parts: int = PARTS, late_us: int = HOUR_US) -> str:
    """Table `p`: the events and the delivery each one comes in."""
    return f"""e as (select {columns}, epoch_us(ts) + event_id % 24 * {late_us} as came from events),
    b as (select min(came) as lo, max(came) as hi from e),
    p as (select {columns}, (came - lo) * {parts} // (hi - lo + 1) as part from e, b)"""


SQL_PARTS = sql_parts()


def sql_survivors(types: str, top: str) -> str:
    """Hourly counts of the rows whose window is open when they arrive; `top` is the watermark of one part alone."""
    return f"""with {SQL_PARTS},
    t as (select part, {top} as top from p group by part),
    w as (select part, max(top) over (order by part rows between unbounded preceding and 1 preceding) as wm from t)
    select time_bucket(interval 1 hour, ts) as window_start, time_bucket(interval 1 hour, ts) + interval 1 hour as window_end,
    count(*) as n from p join w using (part)
    where event_type in ({types}) and (wm is null or time_bucket(interval 1 hour, ts) + interval 1 hour > wm) group by all"""


def latest(kind: str, delay: str) -> str:
    return f"max(ts) filter (where event_type = '{kind}') - interval {delay}"


Build = Callable[[Callable[[], DataFrame], EndMarker], DataFrame]


def deliver(
    spark: SparkSession,
    folder: str,
    build: Build,
    columns: tuple[str, ...] = ("event_type", "ts"),
    writer: Callable[[str], BatchWriter] = parquet_batches,
    parts: int = PARTS,
    late_us: int = HOUR_US,
    mode: str = "append",
) -> str:
    """Run the job that `build` makes over all deliveries and the end marker, from one checkpoint; gives the folder that
    `writer` filled.  Events come up to 23 times `late_us` after their event time."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = events(spark, folder).select(*columns, (us + F.col("event_id") % 24 * late_us).alias("came"))
    lo, hi = rows.agg(F.min("came"), F.max("came")).first()
    target = fresh_dir(spark, "deliveries")
    marker = EndMarker(spark, f"{target}/end")
    part = F.expr(f"(came - {lo}) * {parts} div ({hi} - {lo} + 1)") if lo is not None else F.lit(0)
    rows = rows.withColumn("part", part).withColumn("ts", F.col("ts").cast("timestamp"))
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)
    # No bound on the files of a micro-batch: what is late depends on where a delivery ends.
    feed = lambda: stream_table(spark, f"{target}/in", schema)
    for k in range(parts):
        rows.where(F.col("part") == k).select(*columns).write.mode("append").parquet(f"{target}/in")
        drain(build(feed, marker), writer(f"{target}/out"), f"{target}/checkpoint", mode)
    marker.set()
    drain(build(feed, marker), writer(f"{target}/out"), f"{target}/checkpoint", mode)
    return f"{target}/out"


def delivered(spark: SparkSession, folder: str, build: Build, columns: tuple[str, ...] = ("event_type", "ts")) -> DataFrame:
    """What the job wrote over all deliveries."""
    return read_batches(spark, deliver(spark, folder, build, columns)).drop("batch")


def delivered_windows(spark: SparkSession, folder: str, build) -> DataFrame:
    out = delivered(spark, folder, build)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def of_type(feed: Callable[[], DataFrame], kind: str) -> DataFrame:
    return feed().where(F.col("event_type") == kind).select("ts")


def hourly_views(spark: SparkSession, folder: str, delay: str) -> DataFrame:
    def build(feed, end):
        return tumble(end.follow(of_type(feed, "view")).withWatermark("ts", delay), "ts", "1 hour", [], row_count())

    return delivered_windows(spark, folder, build)


@query("wm_ascending", sql_survivors("'view'", latest("view", "0 second")))
def wm_ascending(spark, folder):
    """The feed is taken to be ascending: what comes after the highest time so far is late once its window ended."""
    return hourly_views(spark, folder, "0 seconds")


@query("wm_bounded", sql_survivors("'view'", latest("view", "12 hour")))
def wm_bounded(spark, folder):
    """Disorder of up to 12 hours is waited for; the feed has up to 23."""
    return hourly_views(spark, folder, "12 hours")


VIEWS, BOUGHT = latest("view", "0 second"), latest("purchase", "12 hour")


@query(
    "wm_min_of_inputs",
    sql_survivors("'view', 'purchase'", f"case when {VIEWS} is not null and {BOUGHT} is not null then least({VIEWS}, {BOUGHT}) end"),
)
def wm_min_of_inputs(spark, folder):
    """Two watermarked inputs: the slower one decides when a window closes."""

    def build(feed, end):
        views = end.follow(of_type(feed, "view")).withWatermark("ts", "0 seconds")
        bought = end.follow(of_type(feed, "purchase")).withWatermark("ts", "12 hours")
        return tumble(union_all(views, bought), "ts", "1 hour", [], row_count())

    return delivered_windows(spark, folder, build)
