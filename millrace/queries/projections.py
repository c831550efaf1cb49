"""Projection, filter, routing, partitioning, scalar functions."""

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions.hashing import bitmap_offset
from millrace.functions.times import (
    day_number, from_epoch_seconds, interval, next_midnight, parse_log_time, window_start,
)
from millrace.operators.routing import key_by, map_with_setup, side_output, spread, tag_rows
from millrace.queries.registry import SQL_SECONDS, SQL_SENSORS, events, query, sensors
from millrace.sources.external import register_view
from millrace.sources.tables import table


@query("map_project", SQL_SENSORS)
def map_project(spark, folder):
    return sensors(spark, folder)


@query(
    "map_with_setup",
    "select event_id, case event_type when 'view' then 'pv:' when 'purchase' then 'buy:' else 'other:' end || user_id "
    "as label from events",
)
def map_with_setup_query(spark, folder):
    def label(prefix: dict, batch: pd.DataFrame) -> pd.DataFrame:
        label = batch.event_type.map(prefix).fillna("other:") + batch.user_id.astype(str)
        return pd.DataFrame({"event_id": batch.event_id, "label": label})

    rows = events(spark, folder).select("event_id", "event_type", "user_id")
    prefixes = {"view": "pv:", "purchase": "buy:"}
    return map_with_setup(rows, "event_id long, label string", lambda: dict(prefixes), label, dict.clear)


@query(
    "flat_map_tokens",
    "select doc_id, unnest(string_split(line, ' ')) as word from "
    "(select doc_id, unnest(string_split(text, chr(10))) as line from documents) where trim(line) <> ''",
)
def flat_map_tokens(spark, folder):
    lines = table(spark, folder, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.where(F.trim("line") != "").select("doc_id", F.explode(F.split("line", " ")).alias("word"))


@query("filter_even", "select event_id, user_id from events where user_id % 2 = 0")
def filter_even(spark, folder):
    return events(spark, folder).where(F.col("user_id") % 2 == 0).select("event_id", "user_id")


@query("table_select_where", "select user_id as id, event_id, value as vc from events where user_id = 1")
def table_select_where(spark, folder):
    return events(spark, folder).where(F.col("user_id") == 1).select(
        F.col("user_id").alias("id"), "event_id", F.col("value").alias("vc")
    )


@query("sql_select_where", "select user_id, event_id, value from events where event_type = 'error' and value > 10")
def sql_select_where(spark, folder):
    register_view(events(spark, folder), "event_log")
    return spark.sql("SELECT user_id, event_id, value FROM event_log WHERE event_type = 'error' AND value > 10")


@query(
    "route_multi_tag",
    "select event_id, unnest(case when value < 50 then ['noraml', 'baoku'] when value < 80 then ['warn'] "
    "else ['alarm'] end) as tag from events",
)
def route_multi_tag(spark, folder):
    v = F.col("value")
    # The thresholds and tag names, spelled as users of the routing job select them.
    rules = [(v < 50, ["noraml", "baoku"]), (v < 80, ["warn"])]
    return tag_rows(events(spark, folder).select("event_id", "value"), rules, ["alarm"]).select("event_id", "tag")


@query(
    "side_output_high",
    "select case when value > 50 then 'alert' else 'main' end as output, case when value > 50 then "
    "'high value of user ' || user_id else cast(event_id as varchar) end as text from events",
)
def side_output_high(spark, folder):
    rows = events(spark, folder).select("event_id", "user_id", "value")
    text = F.concat(F.lit("high value of user "), "user_id")
    main, alerts = side_output(rows, F.col("value") > 50, text, "text")
    return main.select(F.lit("main").alias("output"), F.col("event_id").cast("string").alias("text")).unionByName(
        alerts.select(F.lit("alert").alias("output"), "text")
    )


@query(
    "keyed_context",
    "select user_id as current_key, event_id, epoch_us(ts) // 1000 as event_ms, true as processed from events",
)
def keyed_context(spark, folder):
    """Key, event time and processing time of a row are plain columns."""
    return events(spark, folder).select(
        F.col("user_id").alias("current_key"),
        "event_id",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("event_ms"),
        (F.current_timestamp() > F.col("ts").cast("timestamp")).alias("processed"),
    )


@query("key_by_colocation", "select user_id, count(*) as n, cast(1 as bigint) as partitions from events group by user_id")
def key_by_colocation(spark, folder):
    placed = key_by(events(spark, folder).select("user_id"), "user_id").withColumn("part", F.spark_partition_id())
    return placed.groupBy("user_id").agg(
        F.count("*").alias("n"), F.count_distinct("part").alias("partitions")
    )


@query("shuffle_preserves_rows", "select event_id, user_id, value from events")
def shuffle_preserves_rows(spark, folder):
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spread(events(spark, folder).select("event_id", "user_id", "value"), partitions)


@query(
    "scalar_functions",
    f"""
    select event_id,
      string_split(event_id || ',' || event_type, ',')[2] as second_part,
      cast(cast(user_id as varchar) as bigint) as parsed,
      user_id || '_' || event_type as joined,
      (event_type = 'view' and value > 10) or value > 50 as tested,
      user_id % 2 = 0 as is_even,
      to_timestamp({SQL_SECONDS})::timestamp as from_seconds,
      date_trunc('second', ts) as log_time,
      cast(datediff('day', date '1970-01-01', cast(ts as date)) as bigint) as day_number,
      date_trunc('day', ts) + interval 1 day as next_midnight,
      strftime(time_bucket(interval 1 hour, ts) + interval 1 hour, '%Y-%m-%d %H:%M:%S') as window_end_text,
      time_bucket(interval 5 second, ts) as window_start,
      ts + interval 5 second as five_later,
      list_reduce(list_prepend(0::bigint, list_transform(string_split(user_id::varchar, ''),
        lambda c: ascii(c)::bigint)), lambda h, c: (h * 61 + c) & 1073741823) as bit_offset
    from events""",
)
def scalar_functions(spark, folder):
    ts = F.col("ts")
    return events(spark, folder).select(
        "event_id",
        F.get(F.split(F.concat_ws(",", "event_id", "event_type"), ","), F.lit(1)).alias("second_part"),
        F.col("user_id").cast("string").cast("long").alias("parsed"),
        F.concat_ws("_", "user_id", "event_type").alias("joined"),
        (((F.col("event_type") == "view") & (F.col("value") > 10)) | (F.col("value") > 50)).alias("tested"),
        (F.col("user_id") % 2 == 0).alias("is_even"),
        from_epoch_seconds(F.unix_seconds(ts.cast("timestamp"))).cast("timestamp_ntz").alias("from_seconds"),
        parse_log_time(F.date_format("ts", "dd/MM/yyyy:HH:mm:ss")).alias("log_time"),
        day_number(ts).alias("day_number"),
        next_midnight(ts).cast("timestamp_ntz").alias("next_midnight"),
        F.date_format(window_start("ts", "1 hour") + interval("1 hour"), "yyyy-MM-dd HH:mm:ss").alias("window_end_text"),
        window_start("ts", "5 seconds").alias("window_start"),
        (ts + interval("5 seconds")).alias("five_later"),
        bitmap_offset(F.col("user_id")).alias("bit_offset"),
    )
