"""Small hand-checked inputs: sensor readings, clicks, logins, orders and receipts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions.times import from_micros
from millrace.operators.alerts import blacklist_alerts, blacklist_pass, login_risk, order_outcomes, rise_alerts
from millrace.operators.joins import exclude, interval_join, reconcile, window_join
from millrace.operators.patterns import Pattern, match, match_or_timeout
from millrace.operators.rolling import count_changelog, latest_rule, peer_count, rolling_extremes
from millrace.operators.routing import side_output, tag_rows, union_all
from millrace.operators.topn import hot_in_windows
from millrace.operators.windows import count_slide, count_tumble, sessions, slide_count, tumble
from millrace.sinks.documents import write_delimited
from millrace.sources.text import words

T0 = 1549044000
SENSOR = "1:122:10 1:123:20 1:124:30 1:125:40 2:126:50 3:127:60 2:128:70 2:129:80 3:130:90"
SENSOR_CEP = "1:122:10 1:123:20 2:124:30 1:125:40 1:128:50 2:129:60 1:130:70 1:131:80 2:132:90 1:133:100 1:134:110"


def readings(spark, text):
    rows = []
    for i, word in enumerate(text.split()):
        sensor, at, vc = map(int, word.split(":"))
        rows.append((f"sensor_{sensor}", at, vc, i))
    df = spark.createDataFrame(rows, "id string, s long, vc int, event_id long")
    return df.withColumn("ts", from_micros((F.col("s") + T0) * 1_000_000))


@pytest.fixture(scope="module")
def sensor(spark):
    return readings(spark, SENSOR)


@pytest.fixture(scope="module")
def cep(spark):
    return readings(spark, SENSOR_CEP)


def sec(column):
    return (F.unix_seconds(F.col(column).cast("timestamp")) - T0).alias(column)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


N = "count(*)"
ORDER = ["ts", "event_id"]


def test_tumbling_windows_align_to_the_epoch(sensor):
    out = tumble(sensor, "ts", "5 seconds", ["id"], F.count("*").alias("n"))
    assert rows(out.select(F.right("id", F.lit(1)), sec("window_start"), "n")) == [
        ("1", 120, 3), ("1", 125, 1), ("2", 125, 3), ("3", 125, 1), ("3", 130, 1),
    ]


def test_hop_windows(sensor):
    out = slide_count(sensor, "ts", "5 seconds", "2 seconds", ["id"])
    assert rows(out.select(F.right("id", F.lit(1)), sec("window_start"), "n")) == [
        ("1", 118, 1), ("1", 120, 3), ("1", 122, 4), ("1", 124, 2),
        ("2", 122, 1), ("2", 124, 2), ("2", 126, 3), ("2", 128, 2),
        ("3", 124, 1), ("3", 126, 2), ("3", 128, 1), ("3", 130, 1),
    ]


def test_sessions_keep_rows_exactly_one_gap_apart(spark, sensor):
    out = sessions(sensor, "ts", "2 seconds", ["id"], ORDER, F.count("*").alias("n"))
    builtin = sensor.groupBy(F.session_window("ts", "2 seconds").alias("w"), "id").agg(F.count("*").alias("n"))
    assert rows(out.select("id", "session_start", "session_end", "n")) == rows(
        builtin.select("id", "w.start", "w.end", "n")
    )


def test_over_count_and_rolling(sensor):
    out = peer_count(sensor, ["id"], ORDER, "n").select("id", "n")
    assert rows(out) == [("sensor_1", i) for i in (1, 2, 3, 4)] + [("sensor_2", i) for i in (1, 2, 3)] + [
        ("sensor_3", i) for i in (1, 2)
    ]
    out = rolling_extremes(sensor, ["id"], ORDER, "vc").where("id = 'sensor_2'")
    assert rows(out.select("rolling_sum", "rolling_max", "rolling_min")) == [(50, 50, 50), (120, 70, 50), (200, 80, 50)]


def test_peers_count_together(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", 2, 3)], "k string, ts long, event_id long")
    assert rows(peer_count(df, ["k"], ORDER, "n").select("event_id", "n")) == [(1, 2), (2, 2), (3, 3)]


def test_routing(sensor):
    v = F.col("vc")
    tagged = tag_rows(sensor, [(v < 50, ["noraml", "baoku"]), (v < 80, ["warn"])], ["alarm"])
    assert rows(tagged.groupBy("tag").count()) == [("alarm", 2), ("baoku", 4), ("noraml", 4), ("warn", 3)]
    main, alerts = side_output(sensor, v > 50, F.col("id"))
    assert (main.count(), alerts.count()) == (5, 4)


def test_count_windows(cep):
    one = cep.where("id = 'sensor_1'")
    assert rows(count_tumble(one, ["id"], ORDER, 5, F.sum("vc").alias("s")).select("s")) == [(190,)]
    assert rows(count_slide(one, ["id"], ORDER, 5, 2, F.sum("vc").alias("s")).select("s")) == [
        (30,), (120,), (260,), (410,),
    ]


def test_rise_alert(sensor, cep):
    out = rise_alerts(sensor, ["id"], ORDER, "vc", "5 seconds")
    assert rows(out.select(sec("alert_ts"))) == [(127,), (131,), (132,)]
    out = rise_alerts(cep, ["id"], ORDER, "vc", "5 seconds")
    assert rows(out.select("id", sec("alert_ts"))) == [
        ("sensor_1", 127), ("sensor_1", 133), ("sensor_1", 139), ("sensor_2", 129), ("sensor_2", 137),
    ]


def test_rise_alert_is_cancelled_at_the_deadline(spark):
    falls = readings(spark, "1:0:10 1:3:20 1:5:20 1:6:30")
    assert rows(rise_alerts(falls, ["id"], ORDER, "vc", "5 seconds").select(sec("rise_start"))) == [(6,)]
    falls_later = readings(spark, "1:0:10 1:3:20 1:6:20")
    assert rows(rise_alerts(falls_later, ["id"], ORDER, "vc", "5 seconds").select(sec("rise_start"))) == [(0,)]


def one(name="sensor_1"):
    return F.col("id") == name


def test_patterns_without_a_key(cep):
    def found(pattern):
        return match(cep, pattern, [], ORDER, ["s"])

    start = Pattern.begin("start", one())
    out = found(start.next("next", one())).select("start_s", "next_s")
    assert rows(out) == [(122, 123), (125, 128), (130, 131), (133, 134)]
    assert found(start.followed_by("next", one())).count() == 7
    assert found(start.followed_by_any("next", one()).within("1 hour")).count() == 28
    out = found(start.next("next", one()).times(3)).select("start_s")
    assert rows(out) == [(122,), (125,), (130,)]
    assert found(start).count() == 8
    assert found(Pattern.begin("start", one()).or_(F.col("vc") > 80)).count() == 9
    assert found(start.where(F.col("vc") > 80)).count() == 2


def test_times_range_and_within_is_strict(cep):
    loop = Pattern.begin("a", one()).times(1, 2)
    out = match(cep, loop, ["id"], ORDER, ["s"])
    assert out.where("a_2_s IS NULL").count() == 8 and out.where("a_2_s IS NOT NULL").count() == 7
    pair = Pattern.begin("a", one()).followed_by("b", one())
    gaps = lambda limit: rows(match(cep, pair.within(limit), ["id"], ORDER, ["s"]).select("a_s"))
    assert gaps("2 seconds") == [(122,), (130,), (133,)]
    assert gaps("2 seconds 1 millisecond") == [(122,), (123,), (128,), (130,), (131,), (133,)]


def test_pattern_goes_on_after_followed_by_any(cep):
    pattern = Pattern.begin("a", F.col("s") == 122).followed_by_any("b", one()).next("c", one()).within("1 hour")
    out = match(cep, pattern, [], ORDER, ["s"]).select("b_s", "c_s")
    assert rows(out) == [(125, 128), (130, 131), (133, 134)]


def test_followed_by_any_needs_a_limit(cep):
    with pytest.raises(ValueError):
        match(cep, Pattern.begin("a", one()).followed_by_any("b", one()), [], ORDER, ["s"])


def test_window_join(spark):
    left = spark.createDataFrame([(1, 111), (2, 211), (3, 311), (4, 411)], "k long, s long")
    right = spark.createDataFrame([(1, 211, "a"), (2, 211, "b"), (3, 311, "c"), (4, 411, "d")], "k long, s long, x string")
    at = lambda df, name: df.select("k", from_micros(F.col("s") * 1_000_000).alias(name), *df.columns[2:])
    out = window_join(at(left, "lts"), at(right, "rts"), ["k"], "lts", "rts", "10 seconds")
    assert rows(out.select("k", "x")) == [(2, "b"), (3, "c"), (4, "d")]


def feed(spark, rows, names):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{names}, s long, event_id long")
    return df.withColumn("ts", from_micros(F.col("s") * 1_000_000))


@pytest.fixture(scope="module")
def orders(spark):
    """Orders 1..6: in time, exactly at the limit, late, never paid, paid only, paid before creation."""
    return feed(
        spark,
        [(1, "create", 0), (1, "pay", 60), (2, "create", 10), (2, "pay", 910), (3, "create", 20), (3, "pay", 921),
         (4, "create", 30), (5, "pay", 40), (6, "pay", 50), (6, "create", 55)],
        "id long, kind string",
    )


def test_order_outcomes(orders):
    kind = F.col("kind")
    out = order_outcomes(orders, "id", "ts", kind == "create", kind == "pay", "15 minutes")
    assert rows(out.select("id", "outcome")) == [
        (1, "paid"), (2, "paid"), (3, "paid_late"), (4, "timeout"), (5, "create_missing"), (6, "paid"),
    ]


def test_order_pattern_and_timeouts(orders):
    kind = F.col("kind")
    pattern = Pattern.begin("c", kind == "create").followed_by("p", kind == "pay").within("15 minutes 1 millisecond")
    found, late = match_or_timeout(orders, pattern, ["id"], ORDER, ["s"])
    assert rows(found.select("id")) == [(1,), (2,)]
    assert rows(late.select("id", "c_s")) == [(3, 20), (4, 30), (6, 55)]
    assert late.where("id = 4").first()["deadline"] == dt.datetime(1970, 1, 1, 0, 15, 30, 1000)


def test_login_risk(spark):
    logins = feed(
        spark,
        [(1, "fail", 0), (1, "fail", 2), (2, "fail", 0), (2, "success", 1), (2, "fail", 2), (2, "fail", 3),
         (3, "fail", 0), (3, "fail", 1), (3, "success", 1), (4, "fail", 0), (4, "fail", 3), (4, "fail", 4)],
        "user long, kind string",
    )
    kind = F.col("kind")
    out = login_risk(logins, ["user"], ORDER, kind == "fail", kind == "success", "2 seconds")
    at = F.unix_seconds(F.col("alert_ts").cast("timestamp"))
    assert rows(out.select("user", "fails", at)) == [(1, 2, 2), (2, 2, 4), (3, 2, 1), (4, 2, 5)]
    pattern = Pattern.begin("a", kind == "fail").next("b", kind == "fail").within("2 seconds")
    assert rows(match(logins, pattern, ["user"], ORDER, ["s"]).select("user")) == [(2,), (3,), (4,)]


def test_blacklist(spark):
    """One user clicks one ad 121 times in a day, another user once: 101 rows pass, one alert."""
    clicks = spark.range(122).select(
        F.when(F.col("id") < 121, 937166).otherwise(1).alias("user"), F.lit(1715).alias("ad"),
        F.col("id").alias("event_id"), from_micros((F.lit(1511658000) + F.col("id")) * 1_000_000).alias("ts"),
    )
    keys = ["user", "ad"]
    assert blacklist_pass(clicks, keys, ORDER, 100).count() == 101
    assert rows(blacklist_alerts(clicks, keys, ORDER, 100).select("user", "event_id")) == [(937166, 100)]
    plan = blacklist_pass(clicks, keys, ORDER, 100)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_reconcile_uses_every_row_once(spark):
    left = feed(spark, [("a", 1), ("a", 5), ("b", 2), ("c", 3)], "tx string").select("tx", F.col("s").alias("l"))
    right = feed(spark, [("a", 2), ("b", 1), ("b", 9), ("d", 4)], "tx string").select("tx", F.col("s").alias("r"))
    out = reconcile(left, right, "tx", ["l"], ["r"])
    assert {tuple(r) for r in out.select("tx", "l", "r", "side").collect()} == {
        ("a", 1, 2, "matched"), ("b", 2, 1, "matched"), ("a", 5, None, "left_only"), ("c", 3, None, "left_only"),
        ("b", None, 9, "right_only"), ("d", None, 4, "right_only"),
    }


def test_interval_join_takes_both_ends(spark):
    left = feed(spark, [("a", 100)], "k string").select("k", F.col("ts").alias("l"))
    right = feed(spark, [("a", 89), ("a", 90), ("a", 110), ("a", 111), ("b", 100)], "k string").select(
        "k", F.col("ts").alias("r"), "s"
    )
    assert rows(interval_join(left, right, ["k"], "l", "r", "10 seconds", "10 seconds").select("s")) == [(90,), (110,)]


def test_set_operations(spark, sensor, cep):
    assert sensor.join(cep, "id", "right").count() == 41
    assert union_all(sensor, cep).count() == 20
    assert rows(exclude(sensor, cep, "id", "id").select("id")) == [("sensor_3",), ("sensor_3",)]


@pytest.mark.parametrize("left", [[1, 2, None], [1], [None]])
@pytest.mark.parametrize("right", [[], [2], [2, None], [None]])
def test_exclude_follows_not_in(spark, left, right):
    a = spark.createDataFrame([(v,) for v in left], "x int")
    b = spark.createDataFrame([(v,) for v in right], "y int")
    want = spark.sql("SELECT * FROM {a} WHERE x NOT IN (SELECT y FROM {b})", a=a, b=b)
    got = exclude(a, b, "x", "y")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_changelog_retracts_before_it_adds(sensor):
    out = count_changelog(sensor.where("id = 'sensor_3'"), ["id"], ORDER)
    assert rows(out.select("event_id", "is_add", "n")) == [(5, True, 1), (8, False, 1), (8, True, 2)]


def test_latest_rule(spark):
    events = feed(spark, [("x", 1), ("y", 5), ("z", 9)], "name string")
    rules = feed(spark, [("on", 3), ("off", 9)], "switch string").withColumn("event_id", F.col("event_id") + 100)
    out = latest_rule(events, rules, ORDER, "switch", "switch").select("name", "switch")
    assert {tuple(r) for r in out.collect()} == {("x", None), ("y", "on"), ("z", "on")}


def test_words_skip_blank_ends(spark):
    lines = spark.createDataFrame([("hello you  ",), ("",), ("hello\nme",)], "value string")
    assert rows(words(lines).groupBy("word").count()) == [("hello", 2), ("me", 1), ("you", 1)]


def test_delimited_file(spark, sensor, tmp_path):
    write_delimited(sensor.where("id = 'sensor_1'").select("id", F.col("s") + T0, "vc").coalesce(1), str(tmp_path / "out"))
    lines = rows(spark.read.text(str(tmp_path / "out")))
    assert lines == [(f"sensor_1|{T0 + 122 + i}|{10 * (i + 1)}",) for i in range(4)]


@pytest.mark.parametrize("n", [1, 3, 50])
def test_pruned_top_n_equals_ranking_every_window(spark, n):
    """Dense counts: 40 keys over two hours, one of them with a third of all rows."""
    data = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(40))).alias("k"),
        from_micros(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(7_200_000_000))).alias("ts"),
    )
    args = (data, "ts", "10 minutes", "5 seconds", ["k"], n)
    pruned, plain = hot_in_windows(*args, max_copies=1), hot_in_windows(*args, max_copies=10_000)
    assert pruned.exceptAll(plain).count() == plain.exceptAll(pruned).count() == 0


def test_small_slides_of_the_click_job(spark):
    """One-hour windows every five seconds: a click counts in 720 of them."""
    clicks = feed(spark, [("beijing", 0), ("beijing", 10), ("jiangsu", 10)], "province string")
    out = hot_in_windows(clicks, "ts", "1 hour", "5 seconds", ["province"], 1)
    assert rows(out.groupBy("province", "n").count()) == [("beijing", 1, 4), ("beijing", 2, 718)]
