"""Event patterns."""

from pyspark.sql import functions as F

from millrace.operators.patterns import Pattern, match, match_or_timeout
from millrace.queries.registry import ORDER, SQL_ORDERS, events, order_events, query

W = "window w as (partition by user_id order by ts, event_id)"
SQL_LOGIN = (
    "select user_id, event_id as fail_id, next_id from (select *, lead(event_type) over w as nt, lead(ts) over w as ns, "
    f"lead(event_id) over w as next_id from events {W}) "
    "where event_type = 'error' and nt = 'error' and ns < ts + interval 6 hour"
)


def kind():
    return F.col("event_type")


def rows(spark, folder):
    return events(spark, folder).select("event_id", "user_id", "event_type", "ts", "value")


def find(spark, folder, pattern, **names):
    out = match(rows(spark, folder), pattern, ["user_id"], ORDER, ["event_id"])
    return out.select("user_id", *[F.col(f"{step}_event_id").alias(name) for step, name in names.items()])


@query("cep_single", "select user_id, event_id as start_id from events where event_type = 'view' and value > 50")
def cep_single(spark, folder):
    return find(spark, folder, Pattern.begin("start", kind() == "view").where(F.col("value") > 50), start="start_id")


@query("cep_or", "select user_id, event_id as start_id from events where event_type = 'view' or value > 50")
def cep_or(spark, folder):
    return find(spark, folder, Pattern.begin("start", kind() == "view").or_(F.col("value") > 50), start="start_id")


@query(
    "cep_next",
    "select user_id, event_id as start_id, next_id from (select *, lead(event_type) over w as nt, "
    f"lead(event_id) over w as next_id from events {W}) where event_type = 'view' and nt = 'purchase'",
)
def cep_next(spark, folder):
    pattern = Pattern.begin("start", kind() == "view").next("then", kind() == "purchase")
    return find(spark, folder, pattern, start="start_id", then="next_id")


SQL_FOLLOWED = (
    "select user_id, event_id as start_id, (select min_by(p.event_id, p.ts) from events p where p.user_id = v.user_id "
    "and p.event_type = 'purchase' and p.ts > v.ts) as next_id, (select min(p.ts) from events p where "
    "p.user_id = v.user_id and p.event_type = 'purchase' and p.ts > v.ts) as next_ts, ts from events v "
    "where event_type = 'view'"
)


@query("cep_followed_by", f"select user_id, start_id, next_id from ({SQL_FOLLOWED}) where next_id is not null")
def cep_followed_by(spark, folder):
    pattern = Pattern.begin("start", kind() == "view").followed_by("then", kind() == "purchase")
    return find(spark, folder, pattern, start="start_id", then="next_id")


@query("cep_within", f"select user_id, start_id, next_id from ({SQL_FOLLOWED}) where next_ts < ts + interval 6 hour")
def cep_within(spark, folder):
    pattern = Pattern.begin("start", kind() == "view").followed_by("then", kind() == "purchase").within("6 hours")
    return find(spark, folder, pattern, start="start_id", then="next_id")


@query(
    "cep_followed_by_any",
    "select v.user_id, v.event_id as start_id, p.event_id as next_id from events v join events p on v.user_id = p.user_id "
    "where v.event_type = 'view' and p.event_type = 'purchase' and p.ts > v.ts and p.ts < v.ts + interval 6 hour",
)
def cep_followed_by_any(spark, folder):
    pattern = Pattern.begin("start", kind() == "view").followed_by_any("then", kind() == "purchase").within("6 hours")
    return find(spark, folder, pattern, start="start_id", then="next_id")


@query(
    "cep_times",
    "with f as (select user_id, event_id as id_1, ts, lead(event_id) over w as id_2, lead(ts) over w as ts_2, "
    f"lead(event_id, 2) over w as id_3, lead(ts, 2) over w as ts_3 from events where event_type = 'error' {W}) "
    "select user_id, id_1, id_2, cast(null as bigint) as id_3 from f where ts_2 < ts + interval 2 day union all "
    "select user_id, id_1, id_2, id_3 from f where ts_3 < ts + interval 2 day",
)
def cep_times(spark, folder):
    """Two or three errors of a user, other events between them being skipped, within two days."""
    pattern = Pattern.begin("fail", kind() == "error").times(2, 3).within("2 days")
    return find(spark, folder, pattern, fail_1="id_1", fail_2="id_2", fail_3="id_3")


@query(
    "cep_next_times",
    f"""
    with r as (select *, row_number() over w as rn, lead(event_type) over w as nt, lead(event_id) over w as id_1
      from events {W}),
    e as (select user_id, event_id, lead(event_id) over (partition by user_id order by ts, event_id) as id_2
      from events where event_type = 'error')
    select r.user_id, r.event_id as start_id, r.id_1, e.id_2 from r join e on e.event_id = r.id_1
    where r.event_type = 'view' and r.nt = 'error' and e.id_2 is not null""",
)
def cep_next_times(spark, folder):
    """A loop after a strict step: the first error directly after the view, the second one relaxed."""
    pattern = Pattern.begin("start", kind() == "view").next("fail", kind() == "error").times(2)
    return find(spark, folder, pattern, start="start_id", fail_1="id_1", fail_2="id_2")


@query("cep_login", SQL_LOGIN)
def cep_login(spark, folder):
    pattern = Pattern.begin("fail", kind() == "error").next("again", kind() == "error").within("6 hours")
    return find(spark, folder, pattern, fail="fail_id", again="next_id")


def order_pattern(spark, folder):
    # At most one event of each type per order, so time and type give a unique order.
    pattern = (
        Pattern.begin("create", kind() == "create").followed_by("pay", kind() == "pay").within("180 days 1 millisecond")
    )
    return match_or_timeout(order_events(spark, folder), pattern, ["order_id"], ["ts", "event_type"], ["ts"])


@query(
    "cep_order_match",
    f"select order_id, create_ts, pay_ts from ({SQL_ORDERS}) where pay_ts >= create_ts and pay_ts <= create_ts + interval 180 day",
)
def cep_order_match(spark, folder):
    found, _ = order_pattern(spark, folder)
    return found.select("order_id", F.col("create_ts"), F.col("pay_ts"))


@query(
    "cep_order_timeout",
    "select order_id, create_ts, create_ts + interval 180 day + interval 1 millisecond as deadline "
    f"from ({SQL_ORDERS}) where not coalesce(pay_ts >= create_ts and pay_ts <= create_ts + interval 180 day, false)",
)
def cep_order_timeout(spark, folder):
    return order_pattern(spark, folder)[1]
