"""Keyed state and alerts over tables."""

from pyspark.sql import functions as F

from millrace.operators.alerts import blacklist_alerts, blacklist_pass, login_risk, order_outcomes, rise_alerts
from millrace.operators.rolling import latest_rule, previous_value
from millrace.operators.topn import hot_in_windows
from millrace.queries.registry import ORDER, SQL_ORDERS, events, order_events, query
from millrace.queries.topn import sql_hot

SQL_LAST_VALUE = (
    "select event_id, user_id, value, lag(value) over (partition by user_id order by ts, event_id) as last_value from events"
)
SQL_RISE = """
    with recursive r0 as (
      select user_id, ts, event_id, value > coalesce(lag(value) over w, -1) as rises from events
      window w as (partition by user_id order by ts, event_id)),
    r as (select *, sum(case when rises then 0 else 1 end) over (partition by user_id order by ts, event_id
        rows unbounded preceding) as run from r0),
    breaks as (select user_id, run - 1 as run, ts as broken_at from r where not rises),
    p as (select distinct user_id, run, ts from r where rises),
    nx as (select a.user_id, a.run, a.ts, min(b.ts) as nxt from p a join p b on a.user_id = b.user_id and a.run = b.run
        and b.ts > a.ts + interval 24 hour group by all),
    chain as (
      select user_id, run, min(ts) as ts from p group by user_id, run
      union all
      select c.user_id, c.run, nx.nxt from chain c join nx on c.user_id = nx.user_id and c.run = nx.run and c.ts = nx.ts)
    select c.user_id, c.ts as rise_start, c.ts + interval 24 hour as alert_ts from chain c
    left join breaks using (user_id, run) where broken_at is null or broken_at > c.ts + interval 24 hour"""
SQL_LOGIN_RISK = """
    with recursive r as (
      select *, sum(case when event_type = 'signup' then 1 else 0 end) over (partition by user_id order by ts, event_id
        rows unbounded preceding) as part from events where event_type in ('error', 'signup')),
    good as (select user_id, part - 1 as part, ts as good_at from r where event_type = 'signup'),
    f as (select user_id, part, ts from r where event_type = 'error'),
    p as (select distinct user_id, part, ts from f),
    nx as (select a.user_id, a.part, a.ts, min(b.ts) as nxt from p a join p b on a.user_id = b.user_id and a.part = b.part
        and b.ts > a.ts + interval 6 hour group by all),
    chain as (
      select user_id, part, min(ts) as ts from p group by user_id, part
      union all
      select c.user_id, c.part, nx.nxt from chain c join nx on c.user_id = nx.user_id and c.part = nx.part and c.ts = nx.ts)
    select c.user_id, c.ts as first_fail, count(*) as fails,
      least(any_value(good_at), c.ts + interval 6 hour) as alert_ts
    from chain c join f on f.user_id = c.user_id and f.part = c.part and f.ts between c.ts and c.ts + interval 6 hour
    left join good on good.user_id = c.user_id and good.part = c.part
    group by c.user_id, c.part, c.ts having count(*) >= 2"""
SQL_DAILY = (
    "select event_id, user_id, event_type, ts, date_trunc('day', ts)::timestamp as day, row_number() over "
    "(partition by user_id, event_type, date_trunc('day', ts) order by ts, event_id) as nth from events"
)
SQL_OUTCOME = (
    "select order_id, create_ts, pay_ts, case when pay_ts is null then 'timeout' "
    f"when pay_ts <= create_ts + interval 180 day then 'paid' else 'paid_late' end as outcome from ({SQL_ORDERS})"
)


@query("last_value_state", SQL_LAST_VALUE)
def last_value_state(spark, folder):
    rows = events(spark, folder).select("event_id", "user_id", "ts", "value")
    return previous_value(rows, ["user_id"], ORDER, "value", "last_value").drop("ts")


@query("rise_alert", SQL_RISE)
def rise_alert(spark, folder):
    return rise_alerts(events(spark, folder), ["user_id"], ORDER, "value", "24 hours")


@query("login_risk_state", SQL_LOGIN_RISK)
def login_risk_state(spark, folder):
    kind = F.col("event_type")
    rows = events(spark, folder, "error", "signup")
    return login_risk(rows, ["user_id"], ORDER, kind == "error", kind == "signup", "6 hours")


@query(
    "broadcast_rule_asof",
    "select event_id, switch from (select event_id, event_type, last_value(case when event_type = 'signup' then "
    "case when value > 20 then 'true' else 'false' end end ignore nulls) over (order by ts, event_id "
    "rows unbounded preceding) as switch from events) where event_type <> 'signup'",
)
def broadcast_rule_asof(spark, folder):
    """Each event with the switch as the newest control row before it set it."""
    rows = events(spark, folder).where(F.col("event_type") != "signup").select("event_id", "ts")
    switch = F.when(F.col("value") > 20, "true").otherwise("false").alias("switch")
    control = events(spark, folder, "signup").select("event_id", "ts", switch)
    return latest_rule(rows, control, ORDER, "switch", "switch").select("event_id", "switch")


def clicks(spark, folder):
    return events(spark, folder).select("event_id", "user_id", "event_type", "ts")


@query("blacklist_pass", f"select * from ({SQL_DAILY}) where nth <= 2")
def blacklist_pass_query(spark, folder):
    return blacklist_pass(clicks(spark, folder), ["user_id", "event_type"], ORDER, 2)


@query("blacklist_alerts", f"select user_id, event_type, day, ts as alert_ts from ({SQL_DAILY}) where nth = 3")
def blacklist_alerts_query(spark, folder):
    alerts = blacklist_alerts(clicks(spark, folder), ["user_id", "event_type"], ORDER, 2)
    return alerts.select("user_id", "event_type", "day", F.col("ts").alias("alert_ts"))


@query(
    "blacklist_then_topn",
    sql_hot(f"select * from ({SQL_DAILY}) where nth <= 2", "user_id, event_type", "1 hour", "5 minute", "55 minute", 3),
)
def blacklist_then_topn(spark, folder):
    passed = blacklist_pass(clicks(spark, folder), ["user_id", "event_type"], ORDER, 2)
    return hot_in_windows(passed, "ts", "1 hour", "5 minutes", ["user_id", "event_type"], 3)


@query("order_timeout", SQL_OUTCOME)
def order_timeout(spark, folder):
    kind = F.col("event_type")
    return order_outcomes(order_events(spark, folder), "order_id", "ts", kind == "create", kind == "pay", "180 days")
