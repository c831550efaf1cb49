"""Top-N per window end."""

from millrace.operators.topn import hot_in_windows
from millrace.plans.skew import salted_join
from millrace.queries.registry import SQL_ITEM, SQL_PROVINCES, behaviour, provinces, query
from millrace.sources.tables import table
from pyspark.sql import functions as F


def sql_hot(source: str, keys: str, size: str, slide: str, back: str, n: int) -> str:
    order = ", ".join(keys.split(", "))
    return f"""
    with s as ({source}),
    e as (select {keys}, unnest(generate_series(time_bucket(interval {slide}, ts) - interval {back},
            time_bucket(interval {slide}, ts), interval {slide})) as window_start from s),
    a as (select window_start + interval {size} as window_end, {keys}, count(*) as n from e group by all)
    select * from (select *, row_number() over (partition by window_end order by n desc, {order}) as rk from a)
    where rk <= {n}"""


SQL_VIEWS = f"select {SQL_ITEM} as item, ts from events where event_type = 'view'"
SQL_CLICKS = f"select user_id, {SQL_ITEM} as ad, ts from events where event_type = 'click'"
SQL_HOT_ITEMS = sql_hot(SQL_VIEWS, "item", "1 hour", "5 minute", "55 minute", 3)


@query("hot_items_topn", SQL_HOT_ITEMS)
def hot_items_topn(spark, folder):
    return hot_in_windows(behaviour(spark, folder, "view"), "ts", "1 hour", "5 minutes", ["item"], 3)


@query(
    "hot_pages_topn",
    sql_hot(
        f"select url, ts from ({SQL_VIEWS}) join pages on item = page_id",
        "url", "10 minute", "5 second", "595 second", 5,
    ),
)
def hot_pages_topn(spark, folder):
    pages = table(spark, folder, "pages").select(F.col("page_id").alias("item"), "url")
    views = behaviour(spark, folder, "view").select("event_id", "item", "ts")
    seen = salted_join(views, pages, ["item"], left_by=["event_id"])
    return hot_in_windows(seen, "ts", "10 minutes", "5 seconds", ["url"], 5)


@query(
    "ad_province_topn",
    sql_hot(
        f"select province, ad, ts from ({SQL_CLICKS}) join ({SQL_PROVINCES}) using (user_id)",
        "province, ad", "1 hour", "5 second", "3595 second", 3,
    ),
)
def ad_province_topn(spark, folder):
    clicks = behaviour(spark, folder, "click").select("event_id", "user_id", F.col("item").alias("ad"), "ts")
    placed = salted_join(clicks, provinces(spark, folder), ["user_id"], left_by=["event_id"])
    return hot_in_windows(placed, "ts", "1 hour", "5 seconds", ["province", "ad"], 3)


@query("ad_user_topn", sql_hot(SQL_CLICKS, "user_id, ad", "1 hour", "5 minute", "55 minute", 3))
def ad_user_topn(spark, folder):
    clicks = behaviour(spark, folder, "click").withColumnRenamed("item", "ad")
    return hot_in_windows(clicks, "ts", "1 hour", "5 minutes", ["user_id", "ad"], 3)
