"""Unions, joins, reconciliation, exclusion."""

from pyspark.sql import functions as F

from millrace.operators.joins import exclude, interval_join, reconcile, right_join, window_join
from millrace.operators.routing import connect, union_all
from millrace.queries.registry import events, query
from millrace.sources.external import register_view
from millrace.sources.tables import table

SQL_WINDOW_JOIN = (
    "select v.user_id, date_trunc('day', v.ts)::timestamp as window_start, v.event_id as view_id, p.event_id as purchase_id "
    "from events v join events p on v.user_id = p.user_id and date_trunc('day', v.ts) = date_trunc('day', p.ts) "
    "where v.event_type = 'view' and p.event_type = 'purchase'"
)
SQL_INTERVAL_JOIN = (
    "select v.user_id, v.event_id as view_id, p.event_id as purchase_id "
    "from events v join events p on v.user_id = p.user_id "
    "and p.ts between v.ts - interval 5 hour and v.ts + interval 5 hour "
    "where v.event_type = 'view' and p.event_type = 'purchase'"
)
SQL_UNION = (
    "select event_id, user_id, event_type from events where event_type in ('view', 'click') union all "
    "select event_id, user_id, event_type from events where event_type in ('click', 'purchase')"
)
SQL_PAIRS = """
    with o as (select o_orderkey as order_key, o_orderdate as order_ts,
        row_number() over (partition by o_orderkey order by o_orderdate, o_orderkey) as pair_no from orders),
    l as (select l_orderkey as order_key, l_shipdate as ship_ts,
        row_number() over (partition by l_orderkey order by l_shipdate, l_linenumber) as pair_no from lineitem)
    select coalesce(o.order_key, l.order_key) as order_key, coalesce(o.pair_no, l.pair_no) as pair_no, order_ts, ship_ts,
      case when o.order_key is null then 'right_only' when l.order_key is null then 'left_only' else 'matched' end as side
    from o full join l on o.order_key = l.order_key and o.pair_no = l.pair_no"""


def views_and_purchases(spark, folder):
    views = events(spark, folder, "view").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    bought = events(spark, folder, "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts")
    )
    return views, bought


@query(
    "connect_comap",
    "select 'event' as feed, cast(event_id as varchar) as body from events union all select 'document', lang from documents",
)
def connect_comap(spark, folder):
    return connect(
        events(spark, folder),
        table(spark, folder, "documents"),
        [F.lit("event").alias("feed"), F.col("event_id").cast("string").alias("body")],
        [F.lit("document").alias("feed"), F.col("lang").alias("body")],
    )


@query("union_streams", SQL_UNION)
def union_streams(spark, folder):
    columns = ["event_id", "user_id", "event_type"]
    return union_all(
        *[events(spark, folder, *types).select(*columns) for types in (["view", "click"], ["click", "purchase"])]
    )


@query("sql_union_all", SQL_UNION)
def sql_union_all(spark, folder):
    register_view(events(spark, folder), "feed", "event_id", "user_id", "event_type")
    return spark.sql(
        "SELECT * FROM feed WHERE event_type IN ('view', 'click') UNION ALL "
        "SELECT * FROM feed WHERE event_type IN ('click', 'purchase')"
    )


@query("window_join", SQL_WINDOW_JOIN)
def window_join_query(spark, folder):
    views, bought = views_and_purchases(spark, folder)
    out = window_join(views, bought, ["user_id"], "view_ts", "purchase_ts", "1 day")
    return out.select("user_id", "window_start", "view_id", "purchase_id")


@query("interval_join", SQL_INTERVAL_JOIN)
def interval_join_query(spark, folder):
    views, bought = views_and_purchases(spark, folder)
    out = interval_join(views, bought, ["user_id"], "view_ts", "purchase_ts", "5 hours", "5 hours")
    return out.select("user_id", "view_id", "purchase_id")


def pairs(spark, folder):
    ordered = table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_key"), F.col("o_orderdate").alias("order_ts"))
    shipped = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_shipdate").alias("ship_ts"), "l_linenumber"
    )
    out = reconcile(ordered, shipped, "order_key", ["order_ts"], ["ship_ts", "l_linenumber"])
    return out.select("order_key", "pair_no", "order_ts", "ship_ts", "side")


@query("reconcile_matched", f"select order_key, pair_no, order_ts, ship_ts from ({SQL_PAIRS}) where side = 'matched'")
def reconcile_matched(spark, folder):
    return pairs(spark, folder).where(F.col("side") == "matched").drop("side")


@query("reconcile_unmatched", f"select * from ({SQL_PAIRS}) where side <> 'matched'")
def reconcile_unmatched(spark, folder):
    return pairs(spark, folder).where(F.col("side") != "matched")


SQL_RIGHT_JOIN = (
    "select c.c_custkey as id, e.event_id from (select * from events where event_type = 'purchase') e "
    "right join customer c on e.user_id = c.c_custkey"
)


@query("right_join", SQL_RIGHT_JOIN)
def right_join_query(spark, folder):
    bought = events(spark, folder, "purchase").select(F.col("user_id").alias("id"), "event_id")
    buyers = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    return right_join(bought, buyers, ["id"], ["event_id"], ["id"])


@query("sql_right_join", SQL_RIGHT_JOIN)
def sql_right_join(spark, folder):
    register_view(events(spark, folder, "purchase"), "bought", "user_id", "event_id")
    register_view(table(spark, folder, "customer"), "buyers", "c_custkey AS id")
    return spark.sql("SELECT c.id, b.event_id FROM bought b RIGHT JOIN buyers c ON b.user_id = c.id")


@query(
    "sql_not_in",
    "select c_custkey as id from customer where c_custkey not in (select user_id from events where event_type = 'error')",
)
def sql_not_in(spark, folder):
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    return exclude(customers, events(spark, folder, "error"), "id", "user_id")
