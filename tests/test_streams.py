"""Streams over several micro-batches: state, timers and watermarks go from one batch to the next."""

import time

import duckdb
import oracle
import pytest
from conftest import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from millrace.queries import streams
from millrace.sources.external import register_view
from millrace.sources.tables import table
from millrace.operators.windows import tumble_processing_time
from millrace.streaming.jobs import late_batches, rule_batches
from millrace.streaming.replay import drain

PARTS = 4


@pytest.fixture(scope="module")
def pieces(spark, tmp_path_factory):
    """The events as files in time order, one micro-batch each."""
    folder = str(tmp_path_factory.mktemp("pieces"))
    rows = table(spark, SF_SMALL, "events").withColumn("part", F.ntile(PARTS).over(
        Window.orderBy("ts", "event_id")))
    for part in range(1, PARTS + 1):
        piece = rows.where(F.col("part") == part).drop("part").coalesce(1)
        piece.write.mode("append").parquet(f"{folder}/events.parquet")
        time.sleep(1.1)
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{folder}/events.parquet/*.parquet')")
    return folder, con


@pytest.mark.parametrize(
    "name",
    [
        "stream_win_tumble", "stream_win_session", "stream_uv_hourly", "stream_pv_hourly", "stream_hot_items_topn",
        "stream_interval_outer_join", "stream_upsert_latest", "stream_rolling", "stream_last_value",
        "stream_win_count", "state_kinds", "event_timer", "stream_rise_alert", "stream_blacklist", "stream_cep_login",
    ],
)
def test_several_batches(spark, pieces, monkeypatch, name):
    folder, con = pieces
    monkeypatch.setattr(streams, "MAX_FILES", 1)
    problem = oracle.compare(entry_point.queries()[name](spark, folder), con, entry_point.oracle_sql()[name])
    assert problem is None, problem


def test_batches_really_are_separate(spark, pieces, monkeypatch, tmp_path):
    folder, _ = pieces
    monkeypatch.setattr(streams, "MAX_FILES", 1)
    sizes = []
    drain(streams.feed(spark, folder), lambda batch, batch_id: sizes.append(batch.count()), str(tmp_path / "cp"))
    assert len(sizes) == PARTS and sum(sizes) == table(spark, SF_SMALL, "events").count()


def test_failed_batch_is_written_again_in_place(spark, tmp_path):
    """A batch that dies after its write is repeated on restart and replaces its first output."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    spark.range(100).write.parquet(source)
    stream = lambda: spark.readStream.schema("id long").parquet(source)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def write_then_die(batch, batch_id):
        write(batch, batch_id)
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        drain(stream(), write_then_die, checkpoint)
    drain(stream(), write, checkpoint)
    assert spark.read.parquet(out).select("id").distinct().count() == spark.read.parquet(out).count() == 100


def test_view_over_a_stream(spark, pieces):
    folder, _ = pieces
    view = register_view(streams.feed(spark, folder), "live", "user_id AS id", "ts AS rt")
    assert view.isStreaming and view.columns == ["id", "rt"]


def test_late_rows_go_to_their_own_output(spark, tmp_path):
    """Batch 1 closes the window of second 3, so that row is late in batch 2; second 8 is still accepted."""
    seconds = lambda *values: spark.createDataFrame([(v,) for v in values], "s long").select(
        "s", F.timestamp_seconds("s").alias("ts")
    )
    write = late_batches(str(tmp_path), "ts", "5 seconds", "3 seconds", "2 seconds")
    write(seconds(1, 12), 0)
    write(seconds(3, 8, 13), 1)
    write(seconds(8, 20), 2)
    write(seconds(8, 21), 3)
    got = {name: sorted(r.s for r in spark.read.parquet(str(tmp_path / name)).collect()) for name in ("main", "late")}
    assert got == {"main": [1, 8, 8, 12, 13, 20, 21], "late": [3, 8]}


def test_processing_time_windows(spark):
    out = tumble_processing_time(spark.range(10), "1 day", [], F.count("*").alias("n"))
    assert out.agg(F.sum("n")).first()[0] == 10


def test_rules_are_read_for_every_batch(spark, tmp_path):
    switch = {"now": "off"}
    rules = lambda: spark.createDataFrame([(1, switch["now"])], "k long, switch string")
    write = rule_batches(str(tmp_path / "out"), rules, ["k"])
    write(spark.createDataFrame([(1, "a")], "k long, x string"), 0)
    switch["now"] = "on"
    write(spark.createDataFrame([(1, "b"), (2, "c")], "k long, x string"), 1)
    rows = spark.read.parquet(str(tmp_path / "out")).select("x", "switch").collect()
    assert {tuple(r) for r in rows} == {("a", "off"), ("b", "on"), ("c", None)}
