"""Watermarks per record, allowed lateness, late rows."""

from pyspark.sql import functions as F

from millrace.functions.times import interval
from millrace.operators.late import late_audit, lateness_firings, watermark_trace
from millrace.queries.registry import events, query

# The test events come in order, so arrival times are derived: up to 96 minutes after the event.
ARRIVAL = ["arrival", "event_id"]
SQL_ARRIVED = (
    "select *, ts + ((event_id * 7919) % 97) * interval 1 minute as arrival from events"
)
SQL_MARKED = f"""
    select *, max(ts) over (order by arrival, event_id rows between unbounded preceding and 1 preceding)
        - interval 30 minute as wm_before,
      max(ts) over (order by arrival, event_id rows unbounded preceding) - interval 30 minute as wm_after,
      time_bucket(interval 1 hour, ts) as window_start,
      time_bucket(interval 1 hour, ts) + interval 1 hour as window_end from ({SQL_ARRIVED})"""
SQL_STATUS = f"""
    select *, case when window_end - interval 1 millisecond + interval 15 minute <= wm_before then 'dropped'
      when window_end - interval 1 millisecond <= wm_before then 'late' else 'on_time' end as status
    from ({SQL_MARKED})"""


def arrived(spark, folder):
    minutes = (F.col("event_id") * 7919) % 97
    return events(spark, folder).select(
        "event_id", "event_type", "ts", (F.col("ts") + minutes * interval("1 minute")).alias("arrival")
    )


@query("wm_per_record_trace", f"select event_id, wm_before, wm_after from ({SQL_MARKED})")
def wm_per_record_trace(spark, folder):
    return watermark_trace(arrived(spark, folder), "ts", ARRIVAL, "30 minutes").select(
        "event_id", "wm_before", "wm_after"
    )


@query("late_data_audit", f"select event_id, window_end, wm_before, status from ({SQL_STATUS}) where status <> 'on_time'")
def late_data_audit(spark, folder):
    audit = late_audit(arrived(spark, folder), "ts", ARRIVAL, "1 hour", "30 minutes", "15 minutes")
    return audit.select("event_id", "window_end", "wm_before", "status")


@query(
    "allowed_lateness_refires",
    f"""
    with k as (select *, count(*) over w as seen,
        sum(case when status = 'late' then 1 else 0 end) over w as lates from ({SQL_STATUS})
      where status <> 'dropped'
      window w as (partition by event_type, window_start order by arrival, event_id rows unbounded preceding))
    select event_type, window_start, window_end, cast(0 as bigint) as firing, count(*) as n from k
      where status = 'on_time' group by all
    union all
    select event_type, window_start, window_end, cast(lates as bigint), seen from k where status = 'late'""",
)
def allowed_lateness_refires(spark, folder):
    return lateness_firings(
        arrived(spark, folder), "ts", ARRIVAL, "1 hour", "30 minutes", "15 minutes", ["event_type"]
    )
