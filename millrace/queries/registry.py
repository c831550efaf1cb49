"""The query table and the feeds the queries read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.skew import small
from millrace.session import prepare
from millrace.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ORDER = ["ts", "event_id"]

# SQL for the item of an event and for its sensor shape, as `item()` and `sensors()` make them.
SQL_ITEM = "cast(json_extract_string(props, '$.k') as bigint)"
SQL_SECONDS = "(epoch_us(ts) // 1000000)"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(prepare(spark), folder)

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return build

    return register


def events(spark: SparkSession, folder: str, *types: str) -> DataFrame:
    rows = table(spark, folder, "events")
    return rows.where(F.col("event_type").isin(*types)) if types else rows


def item(props: str = "props"):
    return F.get_json_object(props, "$.k").cast("long")


def row_count():
    return F.count("*").alias("n")


def behaviour(spark: SparkSession, folder: str, *types: str) -> DataFrame:
    """User behaviour: who did what to which item."""
    return events(spark, folder, *types).select("event_id", "user_id", item().alias("item"), "event_type", "ts")


def sensors(spark: SparkSession, folder: str) -> DataFrame:
    """Sensor readings: id, epoch seconds, whole value."""
    return events(spark, folder).select(
        F.concat(F.lit("sensor_"), "user_id").alias("id"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"),
        F.floor("value").cast("int").alias("vc"),
    )


SQL_SENSORS = (
    f"select 'sensor_' || user_id as id, {SQL_SECONDS} as ts, cast(floor(value) as integer) as vc from events"
)


def provinces(spark: SparkSession, folder: str) -> DataFrame:
    """User to province: the nation of the customer with that number."""
    nation = small(table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("province")))
    customer = table(spark, folder, "customer")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("user_id"), "province"
    )


SQL_PROVINCES = (
    "select c_custkey as user_id, n_name as province from customer join nation on c_nationkey = n_nationkey"
)


def order_events(spark: SparkSession, folder: str) -> DataFrame:
    """One `create` per order and one `pay` at its first shipment."""
    create = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.lit("create").alias("event_type"), F.col("o_orderdate").alias("ts")
    )
    pay = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.min("l_shipdate").alias("ts"))
        .select("order_id", F.lit("pay").alias("event_type"), "ts")
    )
    return create.unionByName(pay)


SQL_ORDERS = (
    "select o_orderkey as order_id, o_orderdate as create_ts, "
    "(select min(l_shipdate) from lineitem where l_orderkey = o_orderkey) as pay_ts from orders"
)
