"""State that streams carry themselves: repeated and interrupted batches, folded stores, patterns over random batches."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.alerts import daily_rank, login_risk, rise_alerts
from millrace.operators.counts import bitmap_count, bitmap_rows, bitmap_visitors, merge_bitmaps
from millrace.operators.patterns import Pattern, match, match_or_timeout
from millrace.operators.rolling import previous_value
from millrace.operators.topn import hot_in_windows
from millrace.plans.staging import Folder
from millrace.sinks.batches import read_batches
from millrace.sinks.upserts import UpsertStore
from millrace.streaming import carried
from millrace.streaming.carried import Carried, Release, Watermark
from millrace.streaming.jobs import (
    count_changes, daily_limit_batches, hot_windows, keyed_context_batches, last_value_batches, late_batches,
    login_risk_batches, over_count, refiring_windows, rise_batches,
)
from millrace.streaming.patterns import match_batches

SCHEMA = "user_id long, event_id long, event_type string, ts timestamp"
END = [(None, None, None, carried.END_OF_TIME)]


def frame(spark, rows):
    raw = spark.createDataFrame([(u, e, k, str(t)) for u, e, k, t in rows], "user_id long, event_id long, event_type string, at string")
    ts = F.when(F.col("at").rlike("^[0-9]+$"), F.timestamp_seconds(F.expr("try_cast(at as long)"))).otherwise(F.expr("try_cast(at as timestamp)"))
    return raw.select("user_id", "event_id", "event_type", ts.alias("ts"))


def feed(seed, n=160, users=4, late=30, kinds="abc"):
    """Rows in order of arrival, up to `late` seconds late, many with equal times; one user has a third of them."""
    rng = random.Random(seed)
    rows = [(0 if rng.random() < 0.3 else rng.randrange(users), i, rng.choice(kinds), rng.randrange(3 * n)) for i in range(n)]
    return sorted(rows, key=lambda r: r[3] + rng.randrange(late))


def batches(rows, seed, parts=5):
    rng = random.Random(seed)
    cuts = [0, *sorted(rng.sample(range(1, len(rows)), parts - 1)), len(rows)]
    return [rows[a:b] for a, b in zip(cuts, cuts[1:])]


def run(spark, write, parts):
    for i, rows in enumerate(parts):
        write(frame(spark, rows), i)


def taken(df, *columns):
    return sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))


# ---- carried tables ---------------------------------------------------------------------------------


def test_versions_and_repeats(spark, tmp_path):
    table = Carried(str(tmp_path / "t"))
    for i in range(5):
        old = table.before(spark, i, "n long")
        assert old.count() == i
        table.keep(old.unionByName(spark.range(1).select(F.lit(i).cast("long").alias("n"))), i)
        # A repeated batch starts from the version before it again.
        assert table.before(spark, i, "n long").count() == i
    assert sorted(Folder(spark, table.path).names()) == ["batch=3", "batch=4"]


def test_a_version_that_is_not_whole_is_passed_over(spark, tmp_path):
    table = Carried(str(tmp_path / "t"))
    table.keep(spark.range(3), 0)
    table.keep(spark.range(5), 1)
    Folder(spark, f"{table.path}/batch=1/_SUCCESS").delete()
    assert table.before(spark, 2, "id long").count() == 3


def test_watermark_is_one_row_per_batch(spark, tmp_path):
    mark = Watermark(str(tmp_path / "w"), "ts", "5 seconds")
    s = 1_000_000
    assert mark.advance(frame(spark, []), 0) == (None, None)
    assert mark.advance(frame(spark, [(1, 1, "a", 20)]), 1) == (None, 15 * s)
    assert mark.advance(frame(spark, [(1, 1, "a", 10)]), 2) == (15 * s, 15 * s)
    assert mark.advance(frame(spark, [(1, 1, "a", 10)]), 2) == (15 * s, 15 * s)
    assert mark.advance(frame(spark, [(1, 1, "a", 40)]), 3) == (15 * s, 35 * s)
    assert len(Folder(spark, str(tmp_path / "w")).names()) == 2


def test_release_in_event_time_order(spark, tmp_path):
    release = Release(str(tmp_path / "r"), "ts", "10 seconds")
    seen, top = [], 0
    for i, rows in enumerate([*batches(feed(3, late=20), 3), END]):
        due, _, _ = release.advance(frame(spark, rows), i)
        times = [r.s for r in due.select(F.unix_seconds("ts").alias("s")).collect()]
        assert all(t > top for t in times)
        top = max([top, *times])
        seen += times
    # What is missing was behind the watermark when it came.
    assert 100 < len(seen) < 160


# ---- late rows and windows that fire again ----------------------------------------------------------


def test_refiring_windows(spark, tmp_path):
    """Delay 0, lateness 10: the window [0, 10) fires, takes a late row, and is closed at 20."""
    path = str(tmp_path)
    write = refiring_windows(path, "ts", "10 seconds", "0 seconds", "10 seconds", ["event_type"], {"n": (F.count("*"), "sum"), "low": (F.min("event_id"), "min")})
    parts = [[(1, 5, "a", 1), (1, 6, "a", 2), (1, 7, "b", 12)], [(1, 4, "a", 3), (1, 8, "b", 13)], [(1, 9, "a", 4), (1, 3, "b", 25)], [(1, 2, "a", 5), (1, 1, "b", 14)], END]
    run(spark, write, parts)
    write(frame(spark, parts[-1]), 4)  # once more, as after a failure
    out = read_batches(spark, f"{path}/out").select("batch", "event_type", F.unix_seconds("window_start").alias("s"), "firing", "n", "low")
    assert sorted(tuple(r) for r in out.collect()) == [
        (0, "a", 0, 0, 2, 5), (1, "a", 0, 1, 3, 4), (2, "a", 0, 2, 4, 4), (2, "b", 10, 0, 2, 7), (3, "b", 10, 1, 3, 1), (4, "b", 20, 0, 1, 3)]
    assert [r.event_id for r in read_batches(spark, f"{path}/late").collect()] == [2]


def test_an_interrupted_batch_changes_nothing(spark, tmp_path, monkeypatch):
    parts = [*batches(feed(5, late=60), 5), END]

    def results(path, fail_at=None):
        write = refiring_windows(path, "ts", "20 seconds", "5 seconds", "30 seconds", ["user_id"], {"n": (F.count("*"), "sum")})
        for i, rows in enumerate(parts):
            if i == fail_at:
                with monkeypatch.context() as patch:
                    patch.setattr(Carried, "keep", broken(Carried.keep))
                    with pytest.raises(RuntimeError, match="lost"):
                        write(frame(spark, rows), i)
            write(frame(spark, rows), i)
        return taken(read_batches(spark, f"{path}/out"), "batch", "user_id", "window_start", "firing", "n")

    def broken(keep):
        """The first table is written, the second one is not."""
        calls = []

        def lost(self, table, batch_id):
            calls.append(1)
            if len(calls) > 1:
                raise RuntimeError("lost")
            return keep(self, table, batch_id)

        return lost

    assert results(str(tmp_path / "a")) == results(str(tmp_path / "b"), 2) == results(str(tmp_path / "c"), 4)


def test_late_rows_cost_one_row_of_state(spark, tmp_path):
    write = late_batches(str(tmp_path), "ts", "5 seconds", "3 seconds", "2 seconds")
    for i in range(6):
        write(frame(spark, [(1, i, "a", 10 * i + 1), (1, 100 + i, "a", 2)]), i)
    assert len(Folder(spark, str(tmp_path / "watermark")).names()) == 2
    late = sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "late")).collect())
    assert late == [102, 103, 104, 105]


# ---- the keyed store --------------------------------------------------------------------------------


def test_store_before_during_and_after_a_fold(spark, tmp_path, monkeypatch):
    store = UpsertStore(str(tmp_path / "s"), ["k"], ["at"], ["v"], every=3)
    want, rng = {}, random.Random(1)
    state = lambda: {r.k: r.v for r in store.read(spark, "k long, at long, v string").collect()}
    assert state() == {}
    for i in range(13):
        rows = [(rng.randrange(6), 100 * i + j, f"{i}.{j}") for j in range(4)]
        write = lambda: store.write(spark.createDataFrame(rows, "k long, at long, v string"), i)  # noqa: B023, E731
        if i in (5, 9):  # killed before the manifest, and after it but before the cleaning
            with monkeypatch.context() as patch:
                target = (Folder, "touch") if i == 5 else (UpsertStore, "_clean")
                patch.setattr(*target, lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
                try:
                    write()
                except RuntimeError:
                    pass
            want_now = {**want, **{k: v for k, _, v in rows}}
            assert state() == want_now
        write()  # a batch that ran already is written again in its place
        want |= {k: v for k, _, v in rows}
        assert state() == want
        assert len(store._parts(spark, None)) <= store.every + 3
    assert len(store._numbers(spark, "manifest")) <= 2 and store._numbers(spark, "manifest")[-1] >= 7
    # A repeated batch sees what its first attempt saw.
    assert {r.k: r.v for r in store.read(spark, until=11).collect()} != want


def test_changelog_folds_to_the_counts(spark, tmp_path):
    rows = feed(7)
    parts = batches(rows, 7, 6)
    write = count_changes(str(tmp_path), ["user_id", "event_type"], every=2)
    run(spark, write, parts)
    write(frame(spark, parts[-1]), len(parts) - 1)
    log = read_batches(spark, f"{tmp_path}/out").orderBy("batch", "is_add").collect()
    state = {}
    for r in log:
        key = (r.user_id, r.event_type)
        if r.is_add:
            assert key not in state
            state[key] = r.n
        else:
            assert state.pop(key) == r.n
    want = {}
    for u, _, k, _ in rows:
        want[u, k] = want.get((u, k), 0) + 1
    assert state == want


def test_over_count_counts_peers_together(spark, tmp_path):
    rows = feed(9, late=40)
    run(spark, over_count(str(tmp_path), ["user_id"], ["ts", "event_id"], "100 seconds", "n", every=2), [*batches(rows, 9), [(None, 999, "a", 5)], END])
    got = {r.event_id: r.n for r in read_batches(spark, f"{tmp_path}/out").collect()}
    assert got == {e: sum(v == u and s <= t for v, _, _, s in rows) for u, e, _, t in rows}


def test_keyed_context(spark, tmp_path):
    run(spark, keyed_context_batches(str(tmp_path), "user_id", "ts", "2 seconds"), [[(1, 1, "a", 10)], [(2, 2, "a", 4)], [(2, 3, "a", 20)]])
    got = read_batches(spark, f"{tmp_path}/out").orderBy("event_id").collect()
    assert [(r.current_key, r.event_ms, r.watermark_ms) for r in got] == [(1, 10_000, None), (2, 4_000, 8_000), (2, 20_000, 8_000)]
    assert got[0].processing_ms < got[1].processing_ms < got[2].processing_ms


# ---- Top-N, login risk, bitmaps ---------------------------------------------------------------------


@pytest.mark.parametrize("chunks", [False, True])
def test_hot_windows_match_the_batch_form(spark, tmp_path, request, chunks):
    if chunks:
        request.getfixturevalue("small_chunks")
    rows = feed(11, kinds="abcdef")
    write = hot_windows(str(tmp_path), "ts", "60 seconds", "1 second", ["event_type"], 2, "40 seconds")
    run(spark, write, [[], *batches(rows, 11), END])
    columns = ["window_end", "event_type", "n", "rk"]
    want = hot_in_windows(frame(spark, rows), "ts", "60 seconds", "1 second", ["event_type"], 2)
    assert taken(read_batches(spark, f"{tmp_path}/out"), *columns) == taken(want, *columns)


def test_hot_windows_keep_only_open_panes(spark, tmp_path):
    write = hot_windows(str(tmp_path), "ts", "60 seconds", "1 second", ["event_type"], 2, "10 seconds")
    run(spark, write, batches(sorted(feed(12), key=lambda r: r[3]), 12, 6))
    panes = spark.read.parquet(f"{tmp_path}/panes/batch=5")
    assert 0 < panes.count() <= 4 * 80 and panes.columns == ["_pane", "event_type", "n"]


def test_login_risk_matches_the_batch_form(spark, tmp_path):
    rows = feed(13, n=300, kinds="aaab")
    bad, good = F.col("event_type") == "a", F.col("event_type") == "b"
    write = login_risk_batches(str(tmp_path), ["user_id"], ["ts", "event_id"], bad, good, "15 seconds", "40 seconds")
    parts = [*batches(rows, 13, 4), END]
    run(spark, write, parts)
    write(frame(spark, END), len(parts) - 1)
    want = login_risk(frame(spark, rows), ["user_id"], ["ts", "event_id"], bad, good, "15 seconds")
    assert taken(read_batches(spark, f"{tmp_path}/out").drop("batch"), *want.columns) == taken(want, *want.columns)


def valued(df):
    """A value that mostly rises, with equal values, falls and nulls; ids are in order of arrival."""
    h = F.pmod(F.xxhash64("event_id"), F.lit(20))
    value = F.when(h < 2, F.lit(None)).when(h < 5, F.lit(1.0)).otherwise(F.unix_seconds("ts") + F.pmod(h, F.lit(3)) * 4.0)
    return df.withColumn("value", value.cast("double"))


KEY, TIMES = ["user_id"], ["ts", "event_id"]


def test_rises_match_the_batch_form(spark, tmp_path, small_chunks):
    rows = feed(14, n=140)
    write = rise_batches(str(tmp_path), KEY, TIMES, "value", "25 seconds", "40 seconds", every=1)
    parts = [*batches(rows, 14, 2), END]
    for i, part in enumerate(parts):
        write(valued(frame(spark, part)), i)
    write(valued(frame(spark, END)), len(parts) - 1)  # a batch that is repeated
    want = rise_alerts(valued(frame(spark, rows)), KEY, TIMES, "value", "25 seconds")
    assert taken(read_batches(spark, f"{tmp_path}/out").drop("batch"), *want.columns) == taken(want, *want.columns) != []
    assert spark.read.parquet(f"{tmp_path}/pending/batch={len(parts) - 1}").count() == 0


def test_rises_over_batches(spark, tmp_path):
    """A timer goes on over batches, breaks exactly at the deadline, and fires without another row of its key."""
    rows = [[(1, 0, "5", 10), (1, 1, "6", 12), (2, 2, "1", 13)], [(1, 3, "7", 18), (1, 4, "7", 20), (1, 5, "8", 21)], [(2, 6, "2", 60), (None, 7, "9", 61)]]
    typed = lambda df: df.withColumn("value", F.col("event_type").cast("double"))
    write = rise_batches(str(tmp_path), KEY, TIMES, "value", "10 seconds", "0 seconds")
    for i, part in enumerate(rows):
        write(typed(frame(spark, part)), i)
    waiting = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/pending/batch=2").select("user_id", F.unix_seconds("ts")).collect()]
    assert waiting == [(2, 60)]
    write(typed(frame(spark, END)), len(rows))
    out = read_batches(spark, f"{tmp_path}/out").select("user_id", F.unix_seconds("rise_start"), F.unix_seconds("alert_ts"), "batch")
    assert sorted(map(tuple, out.collect())) == [(1, 21, 31, 2), (2, 13, 23, 2), (2, 60, 70, 3)]


def test_last_values_match_the_batch_form(spark, tmp_path, small_chunks):
    rows = feed(15)
    write = last_value_batches(str(tmp_path), KEY, TIMES, "value", "last_value", "40 seconds", every=1)
    for i, part in enumerate([[], *batches(rows, 15, 3), END]):
        write(valued(frame(spark, part)), i)
    want = previous_value(valued(frame(spark, rows)), KEY, TIMES, "value", "last_value")
    columns = ["user_id", "event_id", "value", "last_value"]
    assert taken(read_batches(spark, f"{tmp_path}/out"), *columns) == taken(want, *columns)


def test_daily_limits_match_the_batch_form(spark, tmp_path):
    days = lambda df: df.withColumn("ts", F.timestamp_seconds(F.unix_seconds("ts") * 900))
    rows = feed(16, n=260)
    keys = ["user_id", "event_type"]
    write = daily_limit_batches(str(tmp_path), keys, TIMES, 3, "10 hours")
    parts = [*batches([*rows, (None, 900, "a", rows[-1][3]), (None, 901, "a", rows[-1][3])], 16, 3)]
    for i, part in enumerate(parts):
        write(days(frame(spark, part)), i)
    kept = spark.read.parquet(f"{tmp_path}/counts/batch=2")
    assert kept.select("day").distinct().count() <= 2  # days behind the watermark are forgotten
    write(frame(spark, END), 3)
    write(frame(spark, END), 3)
    want = daily_rank(days(frame(spark, [r for p in parts for r in p])), keys, TIMES).where("nth <= 4")
    columns = [*keys, "event_id", "day", "nth"]
    got = read_batches(spark, f"{tmp_path}/out")
    assert taken(got, *columns) == taken(want, *columns)
    assert got.where((F.col("output") == "alert") != (F.col("nth") == 4)).count() == 0


def test_bitmaps_merge(spark):
    rows = frame(spark, [(u % 70_000, i, "a", i * 40) for i, u in enumerate(range(0, 210_000, 97))]).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    parts = [bitmap_rows(rows.where(F.col("event_id") % 3 == k), "ts", "user_id", "1 hour") for k in range(3)]
    hours = merge_bitmaps(parts[0].unionByName(parts[1]).unionByName(parts[2]), "1 hour")
    days = merge_bitmaps(hours, "1 day")
    for merged, size in ((hours, "1 hour"), (days, "1 day")):
        want = bitmap_visitors(rows, "ts", "user_id", size)
        assert taken(bitmap_count(merged), "window_start", "uv") == taken(want, "window_start", "uv")


# ---- patterns ---------------------------------------------------------------------------------------

NAMES = ["next", "next_three", "followed", "mixed", "mixed_back", "any", "any_twice", "times", "single"]


def kinds():
    return [F.col("event_type") == k for k in "abc"]


def pattern_of(name):
    a, b, c = kinds()
    return {
        "next": lambda: Pattern.begin("x", a).next("y", b),
        "next_three": lambda: Pattern.begin("x", a).next("y", b).next("z", a | c).within("20 seconds"),
        "followed": lambda: Pattern.begin("x", a).followed_by("y", b).followed_by("z", c),
        "mixed": lambda: Pattern.begin("x", a).followed_by("y", b).next("z", c).within("40 seconds"),
        "mixed_back": lambda: Pattern.begin("x", a).next("y", b).followed_by("z", a),
        "any": lambda: Pattern.begin("x", a).followed_by_any("y", b).within("30 seconds"),
        "any_twice": lambda: Pattern.begin("x", a).next("w", b).followed_by_any("y", c).followed_by("v", a).followed_by_any("z", b).within("50 seconds"),
        "times": lambda: Pattern.begin("x", a).times(2, 3).within("30 seconds"),
        "single": lambda: Pattern.begin("x", a),
    }[name]()


@pytest.mark.parametrize("name, seed", [(n, s) for s, n in enumerate(NAMES)])
def test_patterns_match_the_batch_form(spark, tmp_path, request, name, seed):
    if seed in (3, 6):
        request.getfixturevalue("small_chunks")
    rows, pattern = feed(20 + seed), pattern_of(name)
    write = match_batches(str(tmp_path), pattern, ["user_id"], ["ts", "event_id"], ["event_id"], "35 seconds")
    run(spark, write, [*batches(rows, seed, 4), END])
    want = match(frame(spark, rows), pattern, ["user_id"], ["ts", "event_id"], ["event_id"])
    got = read_batches(spark, f"{tmp_path}/out")
    assert taken(got, *sorted(want.columns)) == taken(want, *sorted(want.columns)) and want.count()


def test_pattern_timeouts_match_the_batch_form(spark, tmp_path):
    rows = feed(31)
    a, b, c = kinds()
    pattern = Pattern.begin("x", a).followed_by("y", b).next("z", c).within("25 seconds")
    write = match_batches(str(tmp_path), pattern, ["user_id"], ["ts", "event_id"], ["event_id"], "35 seconds", timeouts=True)
    parts = [*batches(rows, 31, 4), END]
    run(spark, write, parts)
    write(frame(spark, END), len(parts) - 1)  # a repeated batch gives the same rows
    found, late = match_or_timeout(frame(spark, rows), pattern, ["user_id"], ["ts", "event_id"], ["event_id"])
    got = read_batches(spark, f"{tmp_path}/out")
    whole = ["user_id", "x_event_id", "y_event_id", "z_event_id"]
    assert taken(got.where("matched"), *whole) == taken(found, *whole) and found.count()
    assert taken(got.where("not matched"), "x_event_id", "deadline") == taken(late, "x_event_id", "deadline")
    assert got.where("not matched and y_event_id is not null").count() == 0


def test_what_patterns_carry_is_bounded(spark, tmp_path):
    """Rows behind the watermark are gone, and partial matches whose time is over too."""
    a, b, _ = kinds()
    pattern = Pattern.begin("x", a).followed_by("y", b).within("5 seconds")
    write = match_batches(str(tmp_path), pattern, ["user_id"], ["ts", "event_id"], ["event_id"], "2 seconds")
    for i in range(5):
        write(frame(spark, [(1, 100 * i + j, "a", 100 * i + j) for j in range(50)]), i)
    partial = spark.read.parquet(f"{tmp_path}/partial-0/batch=4")
    assert partial.where("_state = 0").count() <= 5
    assert spark.read.parquet(f"{tmp_path}/waiting/batch=4").count() <= 60
    with pytest.raises(ValueError, match="within"):
        match_batches(str(tmp_path), Pattern.begin("x", a).followed_by_any("y", b), ["user_id"], ["ts", "event_id"], [], "1 second")
    with pytest.raises(ValueError, match="timeouts"):
        match_batches(str(tmp_path), pattern_of("next"), ["user_id"], ["ts", "event_id"], [], "1 second", timeouts=True)
