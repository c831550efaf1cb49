"""Sources and sinks."""

from pyspark.sql import functions as F

from millrace.plans.staging import fresh_dir
from millrace.queries.registry import (
    ORDER, SQL_ITEM, SQL_SECONDS, SQL_SENSORS, behaviour, events, query, sensors,
)
from millrace.plans.skew import small
from millrace.sinks.upserts import read_upserts, upsert_batches
from millrace.sinks.documents import as_document, kafka_payload, write_delimited
from millrace.sources.external import register_delimited, register_view
from millrace.sources.kafka import decode_value
from millrace.sources.tables import table, values
from millrace.sources.text import parse_access_log, parse_delimited, read_lines, split_rejects


def staged_text(spark, folder):
    """The documents as text files."""
    path = fresh_dir(spark, "documents")
    table(spark, folder, "documents").select("text").write.text(path)
    return path


SQL_LINES = "select unnest(string_split(text, chr(10))) as value from documents"


@query("scan_text", SQL_LINES)
def scan_text(spark, folder):
    return read_lines(spark, staged_text(spark, folder))


@query(
    "scan_values",
    "select w.label, count(*) as n from events e join (values ('view', 'pv'), ('click', 'ad'), ('error', 'fail'), "
    "('signup', 'success'), ('purchase', 'pay')) w(event_type, label) on e.event_type = w.event_type group by w.label",
)
def scan_values(spark, folder):
    labels = values(
        spark,
        [("view", "pv"), ("click", "ad"), ("error", "fail"), ("signup", "success"), ("purchase", "pay")],
        "event_type string, label string",
    )
    counts = events(spark, folder).groupBy("event_type").agg(F.count("*").alias("n"))
    return counts.join(small(labels), "event_type").select("label", "n")


def sensor_lines(spark, folder):
    return sensors(spark, folder).select(F.concat_ws(",", "id", "ts", "vc").alias("value"))


@query("parse_delimited", SQL_SENSORS)
def parse_delimited_query(spark, folder):
    return parse_delimited(sensor_lines(spark, folder), "id string, ts long, vc int")


@query(
    "parse_rejects",
    f"select user_id || ',' || {SQL_SECONDS} || ',n/a' as value from events where event_type = 'error'",
)
def parse_rejects(spark, folder):
    reading = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.floor("value").cast("string"))
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    lines = events(spark, folder).select(F.concat_ws(",", "user_id", seconds, reading).alias("value"))
    return split_rejects(lines, "id long, ts long, vc int")[1]


@query(
    "parse_access_log",
    "select '10.0.0.' || (user_id % 256) as ip, cast(user_id as varchar) as user_id, date_trunc('second', ts) as ts, "
    f"'GET' as method, '/item/' || {SQL_ITEM} as url from events",
)
def parse_access_log_query(spark, folder):
    lines = behaviour(spark, folder).select(
        F.concat_ws(
            " ",
            F.concat(F.lit("10.0.0."), F.col("user_id") % 256),
            "user_id",
            F.lit("-"),
            F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"),
            F.lit("+0000"),
            F.lit("GET"),
            F.concat(F.lit("/item/"), "item"),
        ).alias("value")
    )
    return parse_access_log(lines)


@query(
    "decode_kafka_value",
    "select cast(user_id as varchar) as key, user_id || ',' || event_type as value, event_id as \"offset\" from events",
)
def decode_kafka(spark, folder):
    records = events(spark, folder).select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.concat_ws(",", "user_id", "event_type").cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    return decode_value(records).select("key", "value", "offset")


def staged_sensors(spark, folder, sep="|"):
    path = fresh_dir(spark, "sensors")
    write_delimited(sensors(spark, folder), path, sep)
    return path


@query("external_table_scan", f"select id, ts, vc from ({SQL_SENSORS}) where vc > 50")
def external_table_scan(spark, folder):
    path = staged_sensors(spark, folder)
    register_delimited(spark, "sensor_file", path, "id STRING, ts BIGINT, vc INT")
    return spark.sql("SELECT id, ts, vc FROM sensor_file WHERE vc > 50")


@query("view_with_rename", "select event_id as id, value as vc, ts as times from events")
def view_with_rename(spark, folder):
    register_view(events(spark, folder), "readings", "event_id AS id", "value AS vc", "ts AS times")
    return spark.sql("SELECT id, vc, times FROM readings")


@query(
    "encode_kafka_value",
    "select cast(user_id as varchar) as key, "
    "cast(to_json({'user_id': user_id, 'event_type': event_type}) as varchar) as value from events",
)
def encode_kafka(spark, folder):
    return kafka_payload(events(spark, folder).select("user_id", "event_type"), F.col("user_id"))


SQL_LATEST = (
    "select user_id, last_type, last_value from (select user_id, event_type as last_type, value as last_value, "
    "row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1"
)


@query("sink_upsert_latest", SQL_LATEST)
def sink_upsert_latest(spark, folder):
    """Two batches go through the keyed store: the second one overwrites keys of the first."""
    path = fresh_dir(spark, "upsert")
    fields = ["event_type", "value"]
    write = upsert_batches(path, ["user_id"], ORDER, fields)
    rows = events(spark, folder).select("user_id", *ORDER, *fields)
    write(rows.where(F.col("event_type") == "view"), 0)
    write(rows.where(F.col("event_type") != "view"), 1)
    latest = read_upserts(spark, path, ["user_id"], ORDER, fields)
    return latest.select("user_id", F.col("event_type").alias("last_type"), F.col("value").alias("last_value"))


@query("sink_json_docs", f"select '{{\"data\":\"' || id || ',' || ts || ',' || vc || '\"}}' as value from ({SQL_SENSORS})")
def sink_json_docs(spark, folder):
    path = fresh_dir(spark, "documents")
    as_document(sensor_lines(spark, folder)).write.text(path)
    return read_lines(spark, path)


@query("sink_delimited", f"select id || '|' || ts || '|' || vc as value from ({SQL_SENSORS})")
def sink_delimited(spark, folder):
    return read_lines(spark, staged_sensors(spark, folder))


@query("sql_insert_into", f"select id, ts, vc from ({SQL_SENSORS})")
def sql_insert_into(spark, folder):
    path = fresh_dir(spark, "insert")
    write_delimited(sensors(spark, folder).limit(0), path)
    register_delimited(spark, "sensor_sink", path, "id STRING, ts BIGINT, vc INT")
    register_view(sensors(spark, folder), "sensor_source")
    spark.sql("INSERT INTO sensor_sink SELECT * FROM sensor_source")
    return spark.table("sensor_sink")
