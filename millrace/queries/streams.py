"""Streaming queries.  Each one drains its stream to the end and reads back what the sink holds, so the same
SQL checks it as its batch form."""

from pyspark.sql import functions as F

from millrace.functions.times import span_us
from millrace.operators.counts import word_count
from millrace.operators.joins import interval_join_stream
from millrace.operators.routing import side_output, union_all
from millrace.operators.windows import flat_window, session_stream, slide, tumble
from millrace.plans.staging import fresh_dir
from millrace.queries.aggregates import ROLL
from millrace.queries.joins import SQL_INTERVAL_JOIN, SQL_PAIRS, SQL_UNION, SQL_WINDOW_JOIN
from millrace.queries.patterns import SQL_LOGIN
from millrace.queries.registry import ORDER, events, item, query, row_count
from millrace.queries.sources import SQL_LATEST, SQL_LINES, staged_text
from millrace.queries.state import SQL_DAILY, SQL_LAST_VALUE, SQL_OUTCOME, SQL_RISE
from millrace.queries.topn import SQL_HOT_ITEMS
from millrace.queries.windows import SQL_ALL, SQL_COUNT_TUMBLE, SQL_PV, SQL_SESSION, SQL_SLIDE, SQL_TUMBLE, SQL_UV
from millrace.schemas import EVENTS
from millrace.sinks.batches import latest_per_key, parquet_batches, read_batches, split_batches
from millrace.sinks.upserts import read_upserts, upsert_batches
from millrace.sources.tables import stream_table
from millrace.sources.text import stream_lines
from millrace.streaming.jobs import rule_batches, top_n_batches, watermarked_pairs
from millrace.streaming.processors import (
    CountWindow, DailyLimit, FailAfterFail, Inactivity, LastValue, OrderOutcome, Reconcile, RiseTimer, RollingStats,
    StateKinds, run_group_processor, run_processor,
)
from millrace.streaming.replay import drain, replay, replayed, replayed_latest

# Input of one micro-batch, which also bounds what a stateful processor sees of one key at a time.
MAX_FILES = 1000


def feed(spark, folder, *types):
    """The events as a stream; watermarks need `timestamp`, the tables hold `timestamp_ntz`."""
    rows = stream_table(spark, f"{folder}/events.parquet", EVENTS, MAX_FILES)
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.where(F.col("event_type").isin(*types)) if types else rows


def plain_times(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def at(us):
    return F.timestamp_micros(us).cast("timestamp_ntz")


def window_job(spark, label, build):
    return plain_times(replayed(spark, label, build), "window_start", "window_end")


@query("stream_scan_text", SQL_LINES)
def stream_scan_text(spark, folder):
    path = staged_text(spark, folder)
    target = fresh_dir(spark, "lines")
    drain(stream_lines(spark, path, MAX_FILES), parquet_batches(f"{target}/out"), f"{target}/checkpoint")
    return read_batches(spark, f"{target}/out").drop("batch")


@query(
    "stream_wordcount",
    "select word, count(*) as n from (select unnest(string_split(line, ' ')) as word from "
    "(select unnest(string_split(text, chr(10))) as line from documents) where trim(line) <> '') group by word",
)
def stream_wordcount(spark, folder):
    """A running count per word; each micro-batch updates the words it contains."""
    path = staged_text(spark, folder)
    target = fresh_dir(spark, "words")
    write = upsert_batches(f"{target}/out", ["word"], ["n"], ["n"])
    drain(word_count(stream_lines(spark, path, MAX_FILES)), write, f"{target}/checkpoint", "update")
    return read_upserts(spark, f"{target}/out", ["word"], ["n"], ["n"])


@query("stream_win_tumble", SQL_TUMBLE)
def stream_win_tumble(spark, folder):
    def build(end):
        rows = end.follow(feed(spark, folder).select("event_type", "ts")).withWatermark("ts", "0 seconds")
        return tumble(rows, "ts", "1 hour", ["event_type"], row_count())

    return window_job(spark, "tumble", build)


@query("stream_win_slide", SQL_SLIDE)
def stream_win_slide(spark, folder):
    def build(end):
        rows = end.follow(feed(spark, folder).select("event_type", "ts")).withWatermark("ts", "0 seconds")
        return slide(rows, "ts", "1 hour", "15 minutes", ["event_type"], row_count())

    return window_job(spark, "slide", build)


@query("stream_win_session", SQL_SESSION)
def stream_win_session(spark, folder):
    def build(end):
        rows = end.follow(feed(spark, folder).select("user_id", "ts")).withWatermark("ts", "0 seconds")
        return session_stream(rows, "ts", "6 hours", ["user_id"], row_count())

    return plain_times(replayed(spark, "session", build), "session_start", "session_end")


@query("stream_win_all", SQL_ALL)
def stream_win_all(spark, folder):
    def build(end):
        return tumble(end.follow(feed(spark, folder).select("ts")).withWatermark("ts", "0 seconds"), "ts", "1 hour", [], row_count())

    return window_job(spark, "all", build)


@query("stream_pv_hourly", SQL_PV)
def stream_pv_hourly(spark, folder):
    """Update mode: every micro-batch restates the windows it touched, the newest statement holds."""

    def build(end):
        rows = end.follow(feed(spark, folder, "view").select("ts")).withWatermark("ts", "10 minutes")
        return tumble(rows, "ts", "1 hour", [], row_count()).where(F.col("window_start") < "2200-01-01")

    out = replayed_latest(spark, "views", build, ["window_start", "window_end"])
    return plain_times(out, "window_start", "window_end")


@query(
    "stream_flush_all_windows",
    "select count(*) as windows, cast(sum(n) as bigint) as n from "
    "(select time_bucket(interval 5 second, ts) as w, count(*) as n from events group by 1)",
)
def stream_flush_all_windows(spark, folder):
    """Not one window, nor a row in them, is missing at the end of a bounded stream."""

    def build(end):
        return tumble(end.follow(feed(spark, folder).select("ts")).withWatermark("ts", "3 seconds"), "ts", "5 seconds", [], row_count())

    return replayed(spark, "flush", build).agg(F.count("*").alias("windows"), F.sum("n").alias("n"))


@query("stream_uv_hourly", SQL_UV)
def stream_uv_hourly(spark, folder):
    def build(end):
        rows = end.follow(feed(spark, folder, "view").select("user_id", "ts")).withWatermark("ts", "0 seconds")
        firsts = watermarked_pairs(rows, "ts", "1 hour", "user_id")
        return flat_window(firsts.groupBy("window").agg(F.count("*").alias("uv")))

    return window_job(spark, "visitors", build)


@query("stream_hot_items_topn", SQL_HOT_ITEMS)
def stream_hot_items_topn(spark, folder):
    def build(end):
        views = feed(spark, folder, "view").select(item().alias("item"), "ts")
        rows = end.follow(views).withWatermark("ts", "0 seconds")
        return slide(rows, "ts", "1 hour", "5 minutes", ["item"], row_count())

    by = [F.col("n").desc(), F.col("item").asc()]
    target = replay(spark, "hot", build, writer=lambda path: top_n_batches(path, ["window_end"], by, 3))
    out = read_batches(spark, target).select("window_end", "item", "n", "rk")
    return plain_times(out, "window_end")


@query(
    "stream_side_output",
    "select case when value > 50 then 'alert' else 'main' end as output, case when value > 50 then "
    "'high value of user ' || user_id else cast(event_id as varchar) end as text from events",
)
def stream_side_output(spark, folder):
    """Main and side output from one pass over each micro-batch."""
    rows = feed(spark, folder).select("event_id", "user_id", "value")
    text = F.concat(F.lit("high value of user "), "user_id")
    target = fresh_dir(spark, "outputs")
    parts = lambda batch: side_output(batch, F.col("value") > 50, text, "text")
    write = split_batches(f"{target}/out", {"main": lambda b: parts(b)[0], "alert": lambda b: parts(b)[1]})
    drain(rows, write, f"{target}/checkpoint")
    main = read_batches(spark, f"{target}/out/main").select(F.lit("main").alias("output"), F.col("event_id").cast("string").alias("text"))
    return main.unionByName(read_batches(spark, f"{target}/out/alert").select(F.lit("alert").alias("output"), "text"))


@query("stream_upsert_latest", SQL_LATEST)
def stream_upsert_latest(spark, folder):
    fields = ["event_type", "value"]
    target = fresh_dir(spark, "upsert")
    write = upsert_batches(f"{target}/out", ["user_id"], ORDER, fields)
    drain(feed(spark, folder).select("user_id", *ORDER, *fields), write, f"{target}/checkpoint")
    latest = read_upserts(spark, f"{target}/out", ["user_id"], ORDER, fields)
    return latest.select("user_id", F.col("event_type").alias("last_type"), F.col("value").alias("last_value"))


@query("stream_restart_exactly_once", "select event_id, user_id, event_type from events")
def stream_restart_exactly_once(spark, folder):
    """The input grows between runs of one checkpoint; each row reaches the sink once."""
    target = fresh_dir(spark, "restart")
    rows = events(spark, folder).select("event_id", "user_id", "event_type")
    schema = rows.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    for part in (F.col("event_type") == "view", F.col("event_type") != "view", None):
        if part is not None:
            rows.where(part).write.mode("append").parquet(f"{target}/in")
        stream = stream_table(spark, f"{target}/in", schema, MAX_FILES)
        drain(stream, parquet_batches(f"{target}/out"), f"{target}/checkpoint")
    return read_batches(spark, f"{target}/out").drop("batch")


@query("stream_union", SQL_UNION)
def stream_union(spark, folder):
    columns = ["event_id", "user_id", "event_type"]
    both = union_all(
        *[feed(spark, folder, *types).select(*columns) for types in (["view", "click"], ["click", "purchase"])]
    )
    target = fresh_dir(spark, "union")
    drain(both, parquet_batches(f"{target}/out"), f"{target}/checkpoint")
    return read_batches(spark, f"{target}/out").drop("batch")


@query(
    "stream_rule_switch",
    "select e.event_id, e.user_id, r.switch from events e left join (select user_id, case when value > 20 then 'true' else "
    "'false' end as switch, row_number() over (partition by user_id order by ts desc, event_id desc) as back from events "
    "where event_type = 'signup') r on e.user_id = r.user_id and back = 1 where e.event_type <> 'signup'",
)
def stream_rule_switch(spark, folder):
    """Each user's newest switch from a rule table that is read again for every micro-batch."""
    switch = F.when(F.col("value") > 20, "true").otherwise("false").alias("switch")
    control = events(spark, folder, "signup").select("user_id", *ORDER, switch)
    rules = lambda: latest_per_key(control, ["user_id"], ORDER, ["switch"])
    target = fresh_dir(spark, "switch")
    rows = feed(spark, folder).where(F.col("event_type") != "signup").select("event_id", "user_id")
    drain(rows, rule_batches(f"{target}/out", rules, ["user_id"]), f"{target}/checkpoint")
    return read_batches(spark, f"{target}/out").drop("batch")


def two_feeds(spark, folder, end):
    views = feed(spark, folder, "view").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    bought = feed(spark, folder, "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts")
    )
    return (
        end.follow(views, "view_ts", user_id=-1).withWatermark("view_ts", "0 seconds"),
        end.follow(bought, "purchase_ts", user_id=-1).withWatermark("purchase_ts", "0 seconds"),
    )


@query("stream_window_join", SQL_WINDOW_JOIN)
def stream_window_join(spark, folder):
    def build(end):
        views, bought = two_feeds(spark, folder, end)
        a = views.withColumn("window", F.window("view_ts", "1 day"))
        b = bought.withColumn("window", F.window("purchase_ts", "1 day"))
        joined = a.join(b, ["user_id", "window"])
        return joined.select("user_id", F.col("window.start").alias("window_start"), "view_id", "purchase_id")

    out = replayed(spark, "window-join", build).where(F.col("user_id") >= 0)
    return plain_times(out, "window_start")


@query("stream_interval_join", SQL_INTERVAL_JOIN)
def stream_interval_join(spark, folder):
    def build(end):
        views, bought = two_feeds(spark, folder, end)
        joined = interval_join_stream(views, bought, ["user_id"], "view_ts", "purchase_ts", "5 hours", "5 hours")
        return joined.select("user_id", "view_id", "purchase_id")

    return replayed(spark, "interval-join", build).where(F.col("user_id") >= 0)


@query(
    "stream_interval_outer_join",
    "select v.user_id, v.event_id as view_id, p.event_id as purchase_id from events v left join events p "
    "on v.user_id = p.user_id and p.event_type = 'purchase' "
    "and p.ts between v.ts - interval 5 hour and v.ts + interval 5 hour where v.event_type = 'view'",
)
def stream_interval_outer_join(spark, folder):
    """Views without a purchase come out too, once the watermark rules one out."""

    def build(end):
        views, bought = two_feeds(spark, folder, end)
        joined = interval_join_stream(views, bought, ["user_id"], "view_ts", "purchase_ts", "5 hours", "5 hours", "left")
        return joined.select("user_id", "view_id", "purchase_id")

    return replayed(spark, "outer-join", build).where(F.col("user_id") >= 0)


# ---- keyed state and timers ----------------------------------------------------------------------


def stateful(spark, folder, label, processor, keys, columns, *types, run=run_processor):
    def build(end):
        rows = feed(spark, folder, *types).select("event_id", "ts", *dict.fromkeys([*keys, *columns]))
        timed = end.follow(rows).withWatermark("ts", "0 seconds")
        return run(timed, keys, processor, processor.schema)

    return build


@query(
    "stream_rolling",
    f"select event_id, user_id, round(sum(value) {ROLL}, 2) as rolling_sum, max(value) {ROLL} as rolling_max, "
    f"min(value) {ROLL} as rolling_min, first_value(ts) {ROLL} as first_ts from events",
)
def stream_rolling(spark, folder):
    out = replayed(spark, "rolling", stateful(spark, folder, "rolling", RollingStats(), ["user_id"], ["value"]))
    return out.select(
        "event_id", "user_id", F.round("rolling_sum", 2).alias("rolling_sum"), "rolling_max", "rolling_min",
        at("first_us").alias("first_ts"),
    )


@query("stream_last_value", SQL_LAST_VALUE)
def stream_last_value(spark, folder):
    out = replayed(spark, "last", stateful(spark, folder, "last", LastValue(), ["user_id"], ["value"]))
    return out.withColumn("last_value", F.when(~F.isnan("last_value"), F.col("last_value")))


@query("stream_win_count", SQL_COUNT_TUMBLE)
def stream_win_count(spark, folder):
    out = replayed(spark, "count", stateful(spark, folder, "count", CountWindow(5), ["user_id"], ["value"]))
    return out.select("user_id", "window_no", F.round("total", 2).alias("total"))


@query(
    "state_kinds",
    "with r as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as back from events), "
    "t as (select user_id, event_type, count(*) as c from events group by all) "
    "select user_id, count(*) as n, string_agg(event_id::varchar, ',' order by ts, event_id) filter (back <= 3) as newest, "
    "(select string_agg(event_type || '=' || c, ',' order by event_type) from t where t.user_id = r.user_id) as types "
    "from r group by user_id",
)
def state_kinds(spark, folder):
    build = stateful(spark, folder, "kinds", StateKinds(), ["user_id"], ["event_type"])
    return replayed_latest(spark, "kinds", build, ["user_id"], mode="append")


@query(
    "event_timer",
    "select user_id, ts as last_ts, ts + interval 6 hour as alert_ts from (select *, lead(ts) over "
    "(partition by user_id order by ts, event_id) as nxt from events) where nxt is null or nxt > ts + interval 6 hour",
)
def event_timer(spark, folder):
    """A user silent for six hours: each event deletes the user's timer and registers a new one."""
    timer = Inactivity(span_us("6 hours"))
    out = replayed(spark, "timer", stateful(spark, folder, "timer", timer, ["user_id"], []))
    return out.select("user_id", at("last_us").alias("last_ts"), at("alert_us").alias("alert_ts"))


@query("stream_rise_alert", SQL_RISE)
def stream_rise_alert(spark, folder):
    timer = RiseTimer(span_us("24 hours"))
    out = replayed(spark, "rise", stateful(spark, folder, "rise", timer, ["user_id"], ["value"]))
    return out.select("user_id", at("start_us").alias("rise_start"), at("alert_us").alias("alert_ts"))


@query(
    "stream_blacklist",
    f"select event_id, user_id, event_type, day, nth, case when nth <= 2 then 'pass' else 'alert' end as output "
    f"from ({SQL_DAILY}) where nth <= 3",
)
def stream_blacklist(spark, folder):
    limit, keys = DailyLimit(2), ["user_id", "event_type"]
    out = replayed(spark, "blacklist", stateful(spark, folder, "blacklist", limit, keys, [], run=run_group_processor))
    return out.select("event_id", "user_id", "event_type", at("day_us").alias("day"), "nth", "output")


@query("stream_cep_login", SQL_LOGIN)
def stream_cep_login(spark, folder):
    step = FailAfterFail(span_us("6 hours"))
    return replayed(spark, "login", stateful(spark, folder, "login", step, ["user_id"], ["event_type"]))


def order_feeds(spark, folder):
    orders = stream_table(spark, f"{folder}/orders.parquet", "o_orderkey long, o_orderdate timestamp_ntz", MAX_FILES)
    items = stream_table(spark, f"{folder}/lineitem.parquet", "l_orderkey long, l_shipdate timestamp_ntz", MAX_FILES)
    left = orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_orderdate").cast("timestamp").alias("ts"))
    right = items.select(F.col("l_orderkey").alias("order_key"), F.col("l_shipdate").cast("timestamp").alias("ts"))
    return left, right


@query("stream_order_timeout", SQL_OUTCOME)
def stream_order_timeout(spark, folder):
    """Outcome as soon as both events are in.  Shipments come before and after orders here, by years, so the
    watermark waits for them."""

    def build(end):
        create, pay = order_feeds(spark, folder)
        both = create.withColumn("event_type", F.lit("create")).unionByName(pay.withColumn("event_type", F.lit("pay")))
        rows = end.follow(both.withColumnRenamed("order_key", "order_id")).withWatermark("ts", "3650 days")
        step = OrderOutcome(span_us("180 days"), span_us("3650 days"))
        return run_group_processor(rows, ["order_id"], step, step.schema)

    out = replayed(spark, "orders", build)
    return out.select("order_id", at("create_us").alias("create_ts"), at("pay_us").alias("pay_ts"), "outcome")


@query("stream_reconcile", f"select order_key, order_ts, ship_ts, side from ({SQL_PAIRS})")
def stream_reconcile(spark, folder):
    def build(end):
        left, right = order_feeds(spark, folder)
        both = left.withColumn("is_left", F.lit(True)).unionByName(right.withColumn("is_left", F.lit(False)))
        rows = end.follow(both).withWatermark("ts", "3650 days")
        step = Reconcile(span_us("3650 days"))
        return run_group_processor(rows, ["order_key"], step, step.schema)

    out = replayed(spark, "reconcile", build)
    return out.select("order_key", at("order_us").alias("order_ts"), at("ship_us").alias("ship_ts"), "side")
