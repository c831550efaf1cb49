"""Processors of groups of keys: the same results as a plain simulation key by key, and state that grows with the
groups, not with the keys."""

import random
import time
from collections import defaultdict

import duckdb
import oracle
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from millrace.queries import streams
from millrace.streaming import replay
from millrace.streaming.processors import DAY_US, GROUPS, NO_TIME, DailyLimit, OrderOutcome, Reconcile

HOLD = 50_000


class Group:
    """One group as the stream runs it: rows of a batch, then the timer if the watermark has passed it."""

    def __init__(self, processor):
        self.processor, self.value, self.timers, self.out = processor, None, set(), []
        processor.init(self)

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def getCurrentWatermarkInMs(self):
        return self.mark

    def batch(self, rows, mark):
        self.mark = mark
        cut = len(rows) // 2
        self.take(self.processor.handleInputRows((1,), iter([rows[:cut], rows[cut:]]), self))
        for at in [t for t in self.timers if t < mark]:
            self.take(self.processor.handleExpiredTimer((1,), self, None))
            self.timers.remove(at)

    def take(self, parts):
        for part in parts:
            self.out += [tuple(None if pd.isna(v) else v if isinstance(v, str) else int(v) for v in row) for row in part.itertuples(index=False)]


def to_ms(us):
    return -(-us // 1000)


def orders_by_key(batches, limit):
    out, half = [], {}

    def result(key, create, pay):
        what = "create_missing" if create is None else "timeout" if pay is None else "paid" if pay <= create + limit else "paid_late"
        out.append((key, create, pay, what))

    for rows, mark in batches:
        mine = defaultdict(list)
        for r in rows:
            if r["us"] != NO_TIME:
                mine[r["k"]].append(r)
        for key, some in mine.items():
            create, pay, due = half.pop(key, (None, None, None))
            for r in some:
                if r["left"]:
                    create = r["us"] if create is None else min(create, r["us"])
                else:
                    pay = r["us"] if pay is None else min(pay, r["us"])
            if create is not None and pay is not None:
                result(key, create, pay)
            else:
                half[key] = (create, pay, due or to_ms((pay if create is None else create) + HOLD))
        for key in [k for k, v in half.items() if v[2] < mark]:
            result(key, *half.pop(key)[:2])
    return out


def pairs_by_key(batches):
    out, waiting = [], {}
    known = lambda us: None if us == NO_TIME else us
    for rows, mark in batches:
        for key in {r["k"] for r in rows}:
            both = waiting.pop(key, []) + sorted(((r["us"], r["left"]) for r in rows if r["k"] == key))
            sides = {s: [us for us, left in both if left == s] for s in (True, False)}
            n = min(map(len, sides.values()))
            out += [(key, known(a), known(b), "matched") for a, b in zip(sides[True][:n], sides[False][:n])]
            rest = [(us, s) for s in sides for us in sides[s][n:]]
            if rest:
                waiting[key] = rest
        due = lambda rest: to_ms(max(0 if us == NO_TIME else us for us, _ in rest) + HOLD)
        for key in [k for k, rest in waiting.items() if due(rest) < mark]:
            out += [(key, known(us), None, "left_only") if left else (key, None, known(us), "right_only") for us, left in waiting.pop(key)]
    return out


def limits_by_key(batches, limit):
    out, seen = [], defaultdict(int)
    for rows, mark in batches:
        for r in sorted(rows, key=lambda r: (r["us"], r["id"])):
            day = r["us"] // DAY_US
            seen[r["k"], r["kind"], day] += 1
            nth = seen[r["k"], r["kind"], day]
            if nth <= limit + 1:
                start = None if r["us"] == NO_TIME else day * DAY_US
                out.append((r["id"], r["k"], r["kind"], start, nth, "pass" if nth <= limit else "alert"))
        for g in [g for g in seen if (g[2] + 1) * DAY_US // 1000 < mark]:
            del seen[g]
    return out


@pytest.mark.parametrize("name", ["orders", "pairs", "limits"])
@pytest.mark.parametrize("seed", range(6))
def test_a_group_equals_its_keys(name, seed):
    rng = random.Random(seed)
    span = 2 * DAY_US if name == "limits" else 200_000
    batches, n = [], 0
    for i in range(5):
        rows = []
        for _ in range(rng.randrange(4, 60)):
            us = NO_TIME if rng.random() < 0.05 else rng.randrange(i * span // 4, i * span // 4 + span)
            kind = rng.choice(["a", "b", None])
            rows.append({"id": n, "k": 2**60 + rng.randrange(12), "us": us, "left": rng.random() < 0.4, "kind": kind})
            n += 1
        batches.append((rows, rng.choice([0, i * span // 4000, i * span // 2000])))
    batches = [(rows, max(m for _, m in batches[: i + 1])) for i, (rows, _) in enumerate(batches)]
    batches.append(([batches[0][0][0]], 10**13))
    processor, want = {
        "orders": (OrderOutcome(20_000, HOLD), lambda: orders_by_key(batches, 20_000)),
        "pairs": (Reconcile(HOLD), lambda: pairs_by_key(batches)),
        "limits": (DailyLimit(2), lambda: limits_by_key(batches, 2)),
    }[name]
    group = Group(processor)
    for rows, mark in batches:
        df = pd.DataFrame(rows)
        df["order_id"] = df["order_key"] = df["user_id"] = df.k
        df["event_id"], df["is_left"] = df.id, df.left
        df["event_type"] = df.kind if name == "limits" else df.left.map({True: "create", False: "pay"})
        group.batch(df, mark)
    assert sorted(map(str, group.out)) == sorted(map(str, want()))
    if name != "limits":
        assert group.value is None and not group.timers


KEYS = 4000


@pytest.fixture(scope="module")
def many_keys(spark, tmp_path_factory):
    """Two deliveries of orders, shipments and events with few rows per key."""
    folder = str(tmp_path_factory.mktemp("many"))
    day = lambda n: F.timestamp_seconds(F.lit(1_700_000_000) + n * 86_400).cast("timestamp_ntz")
    key = F.col("id")
    for part in (0, 1):
        here = spark.range(KEYS).where(F.pmod(key, F.lit(2)) == part)
        item = here.where(F.pmod(key, F.lit(5)) > 1).withColumn("n", F.explode(F.sequence(F.lit(0), F.pmod(key, F.lit(3)).cast("int"))))
        tables = {
            "orders": spark.range(KEYS).where(F.lit(part == 0)).select(key.alias("o_orderkey"), day(F.pmod(key, F.lit(9))).alias("o_orderdate")),
            "lineitem": item.select(key.alias("l_orderkey"), F.col("n").alias("l_linenumber"), day(F.pmod(key, F.lit(400)) + F.col("n")).alias("l_shipdate")),
            "events": spark.range(3 * KEYS).select(
                (key + part * 3 * KEYS).alias("event_id"), day(F.lit(part)).alias("ts"), F.pmod(key, F.lit(KEYS)).alias("user_id"),
                F.lit("click").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props")),
        }
        for name, rows in tables.items():
            rows.coalesce(1).write.mode("append").parquet(f"{folder}/{name}.parquet")
        time.sleep(1.1)
    con = duckdb.connect()
    for name in tables:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet/*.parquet')")
    return folder, con


@pytest.mark.parametrize("name", ["stream_reconcile", "stream_blacklist", "stream_order_timeout"])
def test_state_grows_with_groups(spark, many_keys, monkeypatch, name):
    folder, con = many_keys
    monkeypatch.setattr(streams, "MAX_FILES", 1)
    state = []

    def drain(out, write, checkpoint, mode="append"):
        writer = out.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        query = writer.foreachBatch(write).start()
        query.awaitTermination()
        state.extend(s.numRowsTotal for p in query.recentProgress for s in p.stateOperators)

    monkeypatch.setattr(replay, "drain", drain)
    problem = oracle.compare(entry_point.queries()[name](spark, folder), con, entry_point.oracle_sql()[name])
    assert problem is None, problem
    # A value and a timer, which is listed twice; a row or more per open key before.
    assert 0 < max(state) <= 3 * GROUPS
