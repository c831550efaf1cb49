"""Counts and running aggregates."""

from pyspark.sql import functions as F

from millrace.operators.aggregates import COUNT, aggregate_with
from millrace.operators.counts import bitmap_visitors, exact_visitors, sketch_visitors, visitors, word_count
from millrace.operators.rolling import count_changelog, rolling_extremes, rolling_reduce, running_count, running_distinct
from millrace.plans.skew import salted_join
from millrace.queries.registry import ORDER, SQL_ITEM, SQL_PROVINCES, behaviour, events, provinces, query
from millrace.sources.external import register_view
from millrace.sources.tables import table

ROLL = "over (partition by user_id order by ts, event_id rows unbounded preceding)"


@query(
    "wordcount",
    "select word, count(*) as n from (select unnest(string_split(line, ' ')) as word from "
    "(select unnest(string_split(text, chr(10))) as line from documents) where trim(line) <> '') group by word",
)
def wordcount(spark, folder):
    return word_count(table(spark, folder, "documents"), "text")


@query(
    "rolling_sum_max_min",
    f"select event_id, user_id, round(sum(value) {ROLL}, 2) as rolling_sum, max(value) {ROLL} as rolling_max, "
    f"min(value) {ROLL} as rolling_min, first_value(ts) {ROLL} as first_ts from events",
)
def rolling_sum_max_min(spark, folder):
    rows = events(spark, folder).select("event_id", "user_id", "ts", "value")
    out = rolling_extremes(rows, ["user_id"], ORDER, "value")
    return out.select(
        "event_id", "user_id", F.round("rolling_sum", 2).alias("rolling_sum"), "rolling_max", "rolling_min", "first_ts"
    )


@query("rolling_reduce", f"select event_id, user_id, ts, round(sum(value) {ROLL}, 2) as reduced from events")
def rolling_reduce_query(spark, folder):
    rows = events(spark, folder).select("event_id", "user_id", "ts", "value")
    return rolling_reduce(rows, ["user_id"], ORDER, "value", "reduced").select(
        "event_id", "user_id", "ts", F.round("reduced", 2).alias("reduced")
    )


@query("pv_total", "select 'pv' as behaviour, count(*) as n from events where event_type = 'view'")
def pv_total(spark, folder):
    return events(spark, folder, "view").agg(F.count("*").alias("n")).select(F.lit("pv").alias("behaviour"), "n")


@query(
    "pv_running",
    "select event_id, row_number() over (order by ts, event_id) as pv from events where event_type = 'view'",
)
def pv_running(spark, folder):
    views = events(spark, folder, "view").select("event_id", "ts")
    return running_count(views, [], ORDER, "pv").select("event_id", "pv")


@query("uv_total", "select count(distinct user_id) as uv from events where event_type = 'view'")
def uv_total(spark, folder):
    return visitors(events(spark, folder, "view"), "user_id")


@query(
    "uv_running",
    "with f as (select event_id, ts, row_number() over (partition by user_id order by ts, event_id) = 1 as is_new "
    "from events where event_type = 'view') select event_id, "
    "cast(sum(case when is_new then 1 else 0 end) over (order by ts, event_id rows unbounded preceding) as bigint) "
    "as uv from f",
)
def uv_running(spark, folder):
    views = events(spark, folder, "view").select("event_id", "user_id", "ts")
    return running_distinct(views, "user_id", ORDER, "uv").select("event_id", "uv")


def by_channel(spark, folder):
    """Counts per channel and behaviour; users are counted first, so the join sees one row per user."""
    per_user = events(spark, folder).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    joined = salted_join(per_user, provinces(spark, folder), ["user_id"], left_by=["user_id", "event_type"])
    return joined.groupBy(F.concat_ws("_", "province", "event_type").alias("channel_behaviour")).agg(F.sum("n").alias("n"))


@query(
    "marketing_by_channel",
    f"select province || '_' || event_type as channel_behaviour, count(*) as n from events "
    f"join ({SQL_PROVINCES}) using (user_id) group by 1",
)
def marketing_by_channel(spark, folder):
    return by_channel(spark, folder)


@query("marketing_total", "select event_type, count(*) as n from events group by event_type")
def marketing_total(spark, folder):
    return events(spark, folder).groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "ad_clicks_by_province",
    f"select province || '_' || {SQL_ITEM} as province_ad, count(*) as n from events "
    f"join ({SQL_PROVINCES}) using (user_id) where event_type = 'click' group by 1",
)
def ad_clicks_by_province(spark, folder):
    per_user = behaviour(spark, folder, "click").groupBy("user_id", "item").agg(F.count("*").alias("n"))
    joined = salted_join(per_user, provinces(spark, folder), ["user_id"], left_by=["user_id", "item"])
    return joined.groupBy(F.concat_ws("_", "province", "item").alias("province_ad")).agg(F.sum("n").alias("n"))


@query("sql_group_count", "select user_id as id, count(user_id) as cnt from events group by user_id")
def sql_group_count(spark, folder):
    register_view(events(spark, folder), "sensor_readings", "user_id AS id")
    return spark.sql("SELECT id, count(id) AS cnt FROM sensor_readings GROUP BY id")


@query(
    "retract_changelog",
    "with c as (select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) as k from events) "
    "select event_id, user_id, true as is_add, k as n from c union all "
    "select event_id, user_id, false, k - 1 from c where k > 1",
)
def retract_changelog(spark, folder):
    rows = events(spark, folder).select("event_id", "user_id", "ts")
    return count_changelog(rows, ["user_id"], ORDER).select("event_id", "user_id", "is_add", "n")


@query("udaf_custom_count", "select user_id, event_type, count(*) as n from events group by user_id, event_type")
def udaf_custom_count(spark, folder):
    return aggregate_with(events(spark, folder), ["user_id", "event_type"], COUNT, ["value"])


@query(
    "uv_hourly_approx",
    "select distinct time_bucket(interval 1 hour, ts) as window_start, true as close from events where event_type = 'view'",
)
def uv_hourly_approx(spark, folder):
    """Sketch against exact count per hour: within 3 %, or 1 for the smallest windows."""
    views = events(spark, folder, "view")
    sketch = sketch_visitors(views, "ts", "user_id", "1 hour").withColumnRenamed("uv", "approx")
    exact = exact_visitors(views, "ts", "user_id", "1 hour")
    both = sketch.join(exact, ["window_start", "window_end"])
    near = F.abs(F.col("approx") - F.col("uv")) <= F.greatest(F.lit(1.0), F.col("uv") * 0.03)
    return both.select("window_start", near.alias("close"))


@query(
    "uv_hourly_bitmap",
    """
    with h as (select time_bucket(interval 1 hour, ts) as window_start,
      list_reduce(list_prepend(0::bigint, list_transform(string_split(user_id::varchar, ''),
        lambda c: ascii(c)::bigint)), lambda h, c: (h * 61 + c) & 1073741823) as bit
      from events where event_type = 'view')
    select window_start, window_start + interval 1 hour as window_end, count(distinct bit) as uv from h group by 1""",
)
def uv_hourly_bitmap(spark, folder):
    return bitmap_visitors(events(spark, folder, "view"), "ts", "user_id", "1 hour")
