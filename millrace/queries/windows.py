"""Time and count windows."""

from pyspark.sql import functions as F

from millrace.operators.counts import exact_visitors
from millrace.operators.rolling import peer_count
from millrace.operators.windows import count_slide, count_tumble, fire_per_row, sessions, slide_count, tumble
from millrace.queries.registry import ORDER, events, query, row_count
from millrace.sources.external import register_view

HOUR = "time_bucket(interval 1 hour, ts) as window_start, time_bucket(interval 1 hour, ts) + interval 1 hour as window_end"

SQL_TUMBLE = f"select {HOUR}, event_type, count(*) as n from events group by all"
SQL_SLIDE = (
    "with e as (select event_type, unnest(generate_series(time_bucket(interval 15 minute, ts) - interval 45 minute, "
    "time_bucket(interval 15 minute, ts), interval 15 minute)) as window_start from events) "
    "select window_start, window_start + interval 1 hour as window_end, event_type, count(*) as n from e group by all"
)
SQL_SESSION = (
    "with a as (select user_id, ts, event_id, case when ts <= lag(ts) over w + interval 6 hour then 0 else 1 end as opens "
    "from events window w as (partition by user_id order by ts, event_id)), "
    "b as (select *, sum(opens) over (partition by user_id order by ts, event_id rows unbounded preceding) as s from a) "
    "select user_id, min(ts) as session_start, max(ts) + interval 6 hour as session_end, count(*) as n "
    "from b group by user_id, s"
)
SQL_ALL = f"select {HOUR}, count(*) as n from events group by all"
SQL_COUNT_TUMBLE = (
    "with r as (select user_id, value, (row_number() over (partition by user_id order by ts, event_id) - 1) // 5 as window_no "
    "from events) select user_id, window_no, round(sum(value), 2) as total from r group by all having count(*) = 5"
)
SQL_PV = f"select {HOUR}, count(*) as n from events where event_type = 'view' group by all"
SQL_UV = f"select {HOUR}, count(distinct user_id) as uv from events where event_type = 'view' group by all"


@query("win_tumble_count", SQL_TUMBLE)
def win_tumble_count(spark, folder):
    return tumble(events(spark, folder), "ts", "1 hour", ["event_type"], row_count())


@query("win_slide_count", SQL_SLIDE)
def win_slide_count(spark, folder):
    return slide_count(events(spark, folder), "ts", "1 hour", "15 minutes", ["event_type"])


@query("win_session_count", SQL_SESSION)
def win_session_count(spark, folder):
    rows = events(spark, folder).select("user_id", "ts", "event_id")
    return sessions(rows, "ts", "6 hours", ["user_id"], ORDER, row_count())


@query("win_count_tumble", SQL_COUNT_TUMBLE)
def win_count_tumble(spark, folder):
    rows = events(spark, folder).select("user_id", "ts", "event_id", "value")
    return count_tumble(rows, ["user_id"], ORDER, 5, F.round(F.sum("value"), 2).alias("total"))


@query(
    "win_count_slide",
    "select user_id, fired_at, total from (select user_id, row_number() over w as fired_at, "
    "round(sum(value) over (partition by user_id order by ts, event_id rows 4 preceding), 2) as total from events "
    "window w as (partition by user_id order by ts, event_id)) where fired_at % 2 = 0",
)
def win_count_slide(spark, folder):
    rows = events(spark, folder).select("user_id", "ts", "event_id", "value")
    return count_slide(rows, ["user_id"], ORDER, 5, 2, F.round(F.sum("value"), 2).alias("total"))


@query("win_all_count", SQL_ALL)
def win_all_count(spark, folder):
    return tumble(events(spark, folder), "ts", "1 hour", [], row_count())


@query(
    "win_incremental_sum",
    f"select {HOUR}, event_type, round(sum(value), 2) as total from events group by all",
)
def win_incremental_sum(spark, folder):
    return tumble(events(spark, folder), "ts", "1 hour", ["event_type"], F.round(F.sum("value"), 2).alias("total"))


@query(
    "win_full_process",
    f"select {HOUR}, event_type, count(*) as n, min(ts) as first_ts, max(ts) as last_ts, min(value) as lowest, "
    "max(value) as highest from events group by all",
)
def win_full_process(spark, folder):
    """Facts on all elements of a window, with its bounds, as mergeable aggregates."""
    return tumble(
        events(spark, folder), "ts", "1 hour", ["event_type"], row_count(),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.min("value").alias("lowest"), F.max("value").alias("highest"),
    )


@query(
    "win_per_event_trigger",
    "select event_id, time_bucket(interval 1 hour, ts) as window_start, row_number() over "
    "(partition by time_bucket(interval 1 hour, ts) order by ts, event_id) as n from events where event_type = 'view'",
)
def win_per_event_trigger(spark, folder):
    views = events(spark, folder, "view").select("event_id", "ts")
    return fire_per_row(views, "ts", "1 hour", ORDER).select("event_id", "window_start", "n")


@query("pv_hourly", SQL_PV)
def pv_hourly(spark, folder):
    return tumble(events(spark, folder, "view"), "ts", "1 hour", [], row_count())


@query("uv_hourly", SQL_UV)
def uv_hourly(spark, folder):
    return exact_visitors(events(spark, folder, "view"), "ts", "user_id", "1 hour")


@query("sql_tumble", SQL_TUMBLE)
def sql_tumble(spark, folder):
    register_view(events(spark, folder), "tumbling", "event_type", "ts AS rt")
    return spark.sql(
        "SELECT window.start AS window_start, window.end AS window_end, event_type, count(*) AS n "
        "FROM tumbling GROUP BY window(rt, '1 hour'), event_type"
    )


@query("sql_hop", SQL_SLIDE)
def sql_hop(spark, folder):
    """HOP(rt, slide, size) in the usual SQL; Spark's `window` takes the size first."""
    register_view(events(spark, folder), "hopping", "event_type", "ts AS rt")
    return spark.sql(
        "SELECT window.start AS window_start, window.end AS window_end, event_type, count(*) AS n "
        "FROM hopping GROUP BY window(rt, '1 hour', '15 minutes'), event_type"
    )


@query("sql_over_count", "select event_id, user_id, count(*) over (partition by user_id order by ts) as n from events")
def sql_over_count(spark, folder):
    rows = events(spark, folder).select("event_id", "user_id", "ts")
    return peer_count(rows, ["user_id"], ORDER, "n").select("event_id", "user_id", "n")
