"""Streams that keep state of their own between micro-batches: late rows, windows that fire again, changelogs, OVER
counts, Top-N with small slides, login risk, bitmaps.

The events arrive out of order (see `watermarks`), one delivery per micro-batch, and the SQL works out what each delivery
finds: which rows are late for it, which windows fire, which counts change.
"""

from pyspark.sql import functions as F

from millrace.operators.counts import bitmap_count, bitmap_rows, merge_bitmaps
from millrace.operators.windows import tumble_processing_time
from millrace.plans.skew import salted_join
from millrace.queries.registry import ORDER, item, query
from millrace.queries.state import SQL_DAILY, SQL_LAST_VALUE, SQL_LOGIN_RISK, SQL_RISE
from millrace.queries.streams import plain_times
from millrace.queries.topn import sql_hot, SQL_VIEWS
from millrace.queries.watermarks import deliver, sql_parts
from millrace.sinks.batches import latest_per_key, parquet_batches, read_batches
from millrace.sources.tables import table
from millrace.streaming.jobs import (
    count_changes, daily_limit_batches, hot_windows, keyed_context_batches, last_value_batches, late_batches,
    login_risk_batches, over_count, refiring_windows, rise_batches,
)
from millrace.streaming.processors import Unanswered, run_clock_processor

# Eight deliveries of events that are up to eight days late, so that windows see several of them.
MANY = {"parts": 8, "late_us": 8 * 3_600_000_000}


def everything(feed, end):
    return end.follow(feed())


def sql_marks(columns: str, delay: str, **deliveries) -> str:
    """Tables `p` (rows and their delivery) and `w`: the watermark before and after each delivery."""
    return f"""{sql_parts(columns, **deliveries)},
    t as (select part, max(ts) - interval {delay} as top from p group by part),
    w as (select part, max(top) over (order by part rows between unbounded preceding and 1 preceding) as wm_before,
        max(top) over (order by part) as wm_after from t)"""


@query(
    "stream_late_split",
    f"""with {sql_marks('event_id, event_type, ts', '6 hour')}
    select event_id, event_type, case when coalesce(time_bucket(interval 1 hour, ts) + interval 1 hour - interval 1 millisecond
        + interval 2 hour <= wm_before, false) then 'late' else 'main' end as output from p join w using (part)""",
)
def stream_late_split(spark, folder):
    """Rows that come after their window and its allowed lateness go to an output of their own."""
    writer = lambda path: late_batches(path, "ts", "1 hour", "6 hours", "2 hours")
    target = deliver(spark, folder, lambda feed, end: feed(), ("event_id", "event_type", "ts"), writer)
    outputs = [read_batches(spark, f"{target}/{name}").select("event_id", "event_type", F.lit(name).alias("output")) for name in ("main", "late")]
    return outputs[0].unionByName(outputs[1])


@query(
    "stream_lateness_refires",
    f"""with {sql_marks('event_type, value, ts', '1 day', **MANY)},
    a as (select event_type, time_bucket(interval 6 hour, ts) as window_start, part, count(*) as n, max(value) as top
        from p join w using (part) where wm_before is null
        or time_bucket(interval 6 hour, ts) + interval 6 hour - interval 1 millisecond + interval 5 day > wm_before group by all),
    marks as (select part, wm_after from w union all select {MANY['parts']}, timestamp '2199-12-31'),
    f as (select event_type, window_start, min(marks.part) as part from (select event_type, window_start, min(part) as first
        from a group by all) join marks on marks.part >= first and window_start + interval 6 hour - interval 1 millisecond <= wm_after group by all),
    fires as (select event_type, window_start, part from f union
        select event_type, window_start, a.part from a join f using (event_type, window_start) where a.part > f.part)
    select event_type, window_start, window_start + interval 6 hour as window_end,
        row_number() over (partition by event_type, window_start order by fires.part) - 1 as firing,
        (select cast(sum(n) as bigint) from a where a.event_type = fires.event_type and a.window_start = fires.window_start
            and a.part <= fires.part) as n,
        (select max(top) from a where a.event_type = fires.event_type and a.window_start = fires.window_start
            and a.part <= fires.part) as top from fires""",
)
def stream_lateness_refires(spark, folder):
    """Every result of windows that stay open for five days after they fired."""
    aggs = {"n": (F.count("*"), "sum"), "top": (F.max("value"), "max")}
    writer = lambda path: refiring_windows(path, "ts", "6 hours", "1 day", "5 days", ["event_type"], aggs)
    target = deliver(spark, folder, everything, ("event_type", "value", "ts"), writer, **MANY)
    return plain_times(read_batches(spark, f"{target}/out").drop("batch"), "window_start", "window_end")


@query(
    "stream_retract_changelog",
    f"""with {sql_parts('user_id, ts')},
    c as (select user_id, part, cast(sum(count(*)) over (partition by user_id order by part) as bigint) as n from p group by user_id, part)
    select user_id, part as delivery, true as is_add, n from c union all
    select user_id, part, false, lag(n) over (partition by user_id order by part) from c
    qualify lag(n) over (partition by user_id order by part) is not null""",
)
def stream_retract_changelog(spark, folder):
    """A count per user as the changes that each delivery makes; the store of counts is folded every two batches."""
    writer = lambda path: count_changes(path, ["user_id"], every=2)
    target = deliver(spark, folder, lambda feed, end: feed(), ("user_id", "ts"), writer)
    return read_batches(spark, f"{target}/out").select("user_id", F.col("batch").cast("long").alias("delivery"), "is_add", "n")


@query(
    "stream_over_count",
    f"""with {sql_marks('event_id, user_id, ts', '12 hour')}
    select event_id, user_id, count(*) over (partition by user_id order by ts) as n from p join w using (part)
    where wm_before is null or ts > wm_before""",
)
def stream_over_count(spark, folder):
    """Rows so far of the user, equal times together; events more than 12 hours late are left out."""
    writer = lambda path: over_count(path, ["user_id"], ORDER, "12 hours", "n", every=2)
    target = deliver(spark, folder, everything, ("event_id", "user_id", "ts"), writer)
    return read_batches(spark, f"{target}/out").select("event_id", "user_id", "n")


@query(
    "stream_hot_pages_topn",
    sql_hot(f"select url, ts from ({SQL_VIEWS}) join pages on item = page_id", "url", "10 minute", "5 second", "595 second", 5),
)
def stream_hot_pages_topn(spark, folder):
    """Top 5 pages of ten minutes, every five seconds, over views that come up to 23 hours late."""
    pages = table(spark, folder, "pages").select(F.col("page_id").alias("item"), "url")

    def shape(rows):
        views = rows.where(F.col("event_type") == "view").select("event_id", item().alias("item"), "ts")
        return salted_join(views, pages, ["item"], left_by=["event_id"])

    writer = lambda path: hot_windows(path, "ts", "10 minutes", "5 seconds", ["url"], 5, "24 hours", shape)
    target = deliver(spark, folder, everything, ("event_id", "event_type", "props", "ts"), writer)
    return read_batches(spark, f"{target}/out").drop("batch")


@query("stream_login_risk", SQL_LOGIN_RISK)
def stream_login_risk(spark, folder):
    kind = F.col("event_type")
    writer = lambda path: login_risk_batches(path, ["user_id"], ORDER, kind == "error", kind == "signup", "6 hours", "24 hours")
    build = lambda feed, end: end.follow(feed().where(kind.isin("error", "signup")))
    target = deliver(spark, folder, build, ("event_id", "user_id", "event_type", "ts"), writer)
    return plain_times(read_batches(spark, f"{target}/out").drop("batch"), "first_fail", "alert_ts")


@query("stream_rise_late", SQL_RISE)
def stream_rise_late(spark, folder):
    """Values that rise for a day, over events that come up to 23 hours late."""
    writer = lambda path: rise_batches(path, ["user_id"], ORDER, "value", "24 hours", "24 hours", every=2)
    target = deliver(spark, folder, everything, ("event_id", "user_id", "value", "ts"), writer)
    return plain_times(read_batches(spark, f"{target}/out").drop("batch"), "rise_start", "alert_ts")


@query("stream_last_value_late", SQL_LAST_VALUE)
def stream_last_value_late(spark, folder):
    """The value before each event in event time, over events that come up to 23 hours late."""
    writer = lambda path: last_value_batches(path, ["user_id"], ORDER, "value", "last_value", "24 hours", every=2)
    target = deliver(spark, folder, everything, ("event_id", "user_id", "value", "ts"), writer)
    return read_batches(spark, f"{target}/out").select("event_id", "user_id", "value", "last_value")


@query(
    "stream_blacklist_late",
    "select event_id, user_id, event_type, day, nth, case when nth <= 2 then 'pass' else 'alert' end as output "
    f"from ({SQL_DAILY}) where nth <= 3",
)
def stream_blacklist_late(spark, folder):
    """The first two events of a user, type and day in event time, and an alert at the third, over late events."""
    writer = lambda path: daily_limit_batches(path, ["user_id", "event_type"], ORDER, 2, "24 hours")
    target = deliver(spark, folder, everything, ("event_id", "user_id", "event_type", "ts"), writer)
    return read_batches(spark, f"{target}/out").select("event_id", "user_id", "event_type", "day", "nth", "output")


SQL_BITS = """select ts, list_reduce(list_prepend(0::bigint, list_transform(string_split(user_id::varchar, ''),
    lambda c: ascii(c)::bigint)), lambda h, c: (h * 61 + c) & 1073741823) as bit from events where event_type = 'view'"""


@query(
    "stream_uv_bitmaps",
    f"""with h as ({SQL_BITS})
    select 'hour' as grain, time_bucket(interval 1 hour, ts) as window_start, count(distinct bit) as uv from h group by all
    union all select 'day', date_trunc('day', ts), count(distinct bit) from h group by all""",
)
def stream_uv_bitmaps(spark, folder):
    """Bitmaps per hour that every delivery adds to; days are merged from the hours, without the events."""
    shape = lambda batch: bitmap_rows(batch.where(F.col("event_type") == "view"), "ts", "user_id", "1 hour")
    writer = lambda path: parquet_batches(path, shape)
    target = deliver(spark, folder, lambda feed, end: feed(), ("event_type", "user_id", "ts"), writer)
    hours = merge_bitmaps(read_batches(spark, target), "1 hour")
    days = merge_bitmaps(hours, "1 day")
    counted = [bitmap_count(rows).select(F.lit(grain).alias("grain"), "window_start", "uv") for grain, rows in (("hour", hours), ("day", days))]
    return counted[0].unionByName(counted[1])


@query(
    "stream_keyed_context",
    f"""with {sql_marks('event_id, user_id, ts', '6 hour')}
    select user_id as current_key, event_id, epoch_us(ts) // 1000 as event_ms, epoch_us(wm_before) // 1000 as watermark_ms
    from p join w using (part)""",
)
def stream_keyed_context(spark, folder):
    """Key, event time and the watermark that the row's batch meets."""
    writer = lambda path: keyed_context_batches(path, "user_id", "ts", "6 hours")
    target = deliver(spark, folder, lambda feed, end: feed(), ("event_id", "user_id", "ts"), writer)
    return read_batches(spark, f"{target}/out").select("current_key", "event_id", "event_ms", "watermark_ms")


@query(
    "stream_processing_timer",
    f"""with {sql_parts('event_id, user_id, event_type, ts')},
    l as (select user_id, part, max_by(event_id, struct_pack(a := ts, b := event_id)) as event_id,
        max_by(event_type, struct_pack(a := ts, b := event_id)) as event_type from p group by user_id, part)
    select user_id, event_id from (select *, lead(part) over (partition by user_id order by part) as answered from l)
    where event_type = 'error' and (answered is null or answered > part + 1)""",
)
def stream_processing_timer(spark, folder):
    """Users whose last event of a delivery is an error and who are silent in the next one: the timer of one millisecond
    is due by then, whatever the clock says, and only an event deletes it first."""
    def build(feed, end):
        return run_clock_processor(end.follow(feed()), ["user_id"], Unanswered("event_type", "error", 1), Unanswered.schema)

    # Timers wait for the next delivery instead of a batch without data.
    setting, idle = "spark.sql.streaming.noDataMicroBatches.enabled", spark.conf
    before = idle.get(setting)
    idle.set(setting, "false")
    try:
        target = deliver(spark, folder, build, ("event_id", "user_id", "event_type", "ts"))
    finally:
        idle.set(setting, before)
    return read_batches(spark, target).drop("batch")


@query("stream_win_processing_time", "select event_type, count(*) as n from events group by event_type")
def stream_win_processing_time(spark, folder):
    """Windows on the time a delivery is processed; every event counts in one of them, whichever that is."""
    build = lambda feed, end: tumble_processing_time(feed(), "5 seconds", ["event_type"], F.count("*").alias("n"))
    target = deliver(spark, folder, build, mode="update")
    newest = latest_per_key(read_batches(spark, target), ["window_start", "event_type"], ["batch"], ["n"])
    return newest.groupBy("event_type").agg(F.sum("n").alias("n"))
