"""Event patterns on streams whose events arrive up to 23 hours late, in four micro-batches; a watermark of 24 hours
waits for all of them, so the SQL of the batch form checks them."""

from pyspark.sql import functions as F

from millrace.operators.patterns import Pattern
from millrace.queries.patterns import kind
from millrace.queries.registry import ORACLES, ORDER, query
from millrace.queries.streams import order_feeds, plain_times
from millrace.queries.watermarks import deliver
from millrace.sinks.batches import read_batches
from millrace.streaming.patterns import match_batches
from millrace.streaming.replay import replay

COLUMNS = ("event_id", "user_id", "event_type", "ts")


def find(spark, folder, pattern, delay="24 hours", **names):
    writer = lambda path: match_batches(path, pattern, ["user_id"], ORDER, ["event_id"], delay)
    target = deliver(spark, folder, lambda feed, end: end.follow(feed()), COLUMNS, writer)
    out = read_batches(spark, f"{target}/out")
    return out.select("user_id", *[F.col(f"{step}_event_id").alias(name) for step, name in names.items()])


@query("stream_cep_next", ORACLES["cep_next"])
def stream_cep_next(spark, folder, delay="24 hours"):
    pattern = Pattern.begin("start", kind() == "view").next("then", kind() == "purchase")
    return find(spark, folder, pattern, delay, start="start_id", then="next_id")


@query("stream_cep_followed_by", ORACLES["cep_followed_by"])
def stream_cep_followed_by(spark, folder, delay="24 hours"):
    pattern = Pattern.begin("start", kind() == "view").followed_by("then", kind() == "purchase")
    return find(spark, folder, pattern, delay, start="start_id", then="next_id")


@query("stream_cep_followed_by_any", ORACLES["cep_followed_by_any"])
def stream_cep_followed_by_any(spark, folder):
    pattern = Pattern.begin("start", kind() == "view").followed_by_any("then", kind() == "purchase").within("6 hours")
    return find(spark, folder, pattern, start="start_id", then="next_id")


@query("stream_cep_times", ORACLES["cep_times"])
def stream_cep_times(spark, folder, delay="24 hours"):
    pattern = Pattern.begin("fail", kind() == "error").times(2, 3).within("2 days")
    return find(spark, folder, pattern, delay, fail_1="id_1", fail_2="id_2", fail_3="id_3")


@query(
    "stream_cep_order_timeout",
    "select order_id, create_ts, ship_ts as pay_ts, ship_ts is not null as matched, create_ts + interval 180 day "
    "+ interval 1 millisecond as deadline from (select o_orderkey as order_id, o_orderdate as create_ts, (select min(l_shipdate) "
    "from lineitem where l_orderkey = o_orderkey and l_shipdate >= o_orderdate and l_shipdate <= o_orderdate + interval 180 day) "
    "as ship_ts from orders)",
)
def stream_cep_order_timeout(spark, folder):
    """Each order with its first shipment of the 180 days from it on, or its deadline where none came.  The tables are
    one micro-batch, because their rows are in no order of time."""
    pattern = (
        Pattern.begin("create", kind() == "create").followed_by("pay", kind() == "pay").within("180 days 1 millisecond")
    )

    def build(end):
        create, pay = order_feeds(spark, folder)
        both = create.withColumn("event_type", F.lit("create")).unionByName(pay.withColumn("event_type", F.lit("pay")))
        return end.follow(both.withColumnRenamed("order_key", "order_id"))

    writer = lambda path: match_batches(path, pattern, ["order_id"], ["ts", "event_type"], [], "0 seconds", timeouts=True)
    out = read_batches(spark, f"{replay(spark, 'order-pattern', build, writer=writer)}/out").drop("batch")
    return plain_times(out, "create_ts", "pay_ts", "deadline")
