"""The chunked path must give what one plain window gives, also for hot keys and without a key."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.plans.chunks import (
    CHUNK, layout, run_count, run_first, run_last, run_max, run_min, run_sum,
)
from millrace.plans.skew import salted_join
from millrace.queries import QUERIES


@pytest.fixture(scope="module")
def rows(spark):
    # Key 1 holds a third of all rows; many rows share one instant; some values are null.
    return spark.range(6000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.pmod(F.xxhash64("id"), F.lit(500))).alias("ts"),
        F.when(F.col("id") % 5 != 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000))).alias("v"),
    ).cache()


def _same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("reverse", [False, True])
def test_running_equals_plain_window(spark, rows, small_chunks, keys, reverse):
    plan = layout(rows, keys, ["ts", "event_id"])
    assert plan.chunked
    assert plan.assign(rows).groupBy(*keys, CHUNK).count().count() > 60
    got = plan.running(
        rows, reverse=reverse,
        n=run_count(), odd=run_count(F.col("v") % 2 == 1), s=run_sum(F.col("v")), prev=run_last(F.col("v"), strict=True),
        hi=run_max(F.col("v"), strict=True), lo=run_min(F.col("v")), one=run_first(F.col("v")),
    )
    order = [F.col(c).desc() if reverse else F.col(c) for c in ("ts", "event_id")]
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    want = rows.select(
        "*",
        F.count("*").over(upto).alias("n"),
        F.count(F.when(F.col("v") % 2 == 1, 1)).over(upto).alias("odd"),
        F.sum("v").over(upto).alias("s"),
        F.last("v", True).over(before).alias("prev"),
        F.max("v").over(before).alias("hi"),
        F.min("v").over(upto).alias("lo"),
        F.first("v", True).over(upto).alias("one"),
    )
    _same(got.select(sorted(got.columns)), want.select(sorted(want.columns)))


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("ahead", [False, True])
def test_neighbour_equals_lag_and_lead(rows, small_chunks, keys, ahead):
    plan = layout(rows, keys, ["ts", "event_id"])
    got = plan.neighbour(rows, "p", ["event_id", "v"], ahead=ahead).select("event_id", "p.event_id", "p.v")
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("ts", "event_id")
    pick = F.lead if ahead else F.lag
    want = rows.select("event_id", pick("event_id").over(w).alias("p"), pick("v").over(w).alias("v"))
    got = got.toDF("event_id", "p", "v")
    _same(got, want)


def test_small_input_uses_one_plain_window(rows):
    assert layout(rows, ["k"], ["ts", "event_id"]).splits is None


def test_no_chunk_is_far_above_the_rate(rows, small_chunks):
    sizes = layout(rows, ["k"], ["ts", "event_id"]).assign(rows).groupBy("k", CHUNK).count()
    assert sizes.agg(F.max("count")).first()[0] < small_chunks * 12


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, rows, how):
    left = rows.select("k", F.col("event_id").alias("a")).where("a < 900")
    right = rows.select("k", F.col("event_id").alias("b")).where("b % 7 = 0 and k < 30")
    got = salted_join(left, right, ["k"], how, left_by=["a"], right_by=["b"], cell_rows=20)
    _same(got.select("k", "a", "b"), left.join(right, ["k"], how).select("k", "a", "b"))
    bounded = F.col("b").between(F.col("a") - 100, F.col("a") + 100)
    got = salted_join(left, right, ["k"], how, bounded, ["a"], ["b"], cell_rows=20)
    want = left.join(right.withColumnRenamed("k", "k2"), (F.col("k") == F.col("k2")) & bounded, how).drop("k2")
    _same(got.select("k", "a", "b"), want.select("k", "a", "b"))


@pytest.mark.parametrize("keys", [["k"], []])
def test_null_times_are_split_too(spark, rows, small_chunks, keys):
    """Nine tenths of the rows have no time: no chunk may hold a large share, and the answer stays."""
    sparse = rows.withColumn("ts", F.when(F.col("event_id") % 10 == 0, F.col("ts")))
    plan = layout(sparse, keys, ["ts", "event_id"])
    largest = plan.assign(sparse).where("k = 1" if keys else "true").groupBy(CHUNK).count().agg(F.max("count")).first()[0]
    assert largest < 600
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("ts", "event_id")
    want = sparse.withColumn("n", F.count("*").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    got = plan.running(sparse, n=run_count())
    _same(got.select(sorted(got.columns)), want.select(sorted(want.columns)))


UNKEYED = ["pv_running", "uv_running", "broadcast_rule_asof", "wm_per_record_trace", "late_data_audit", "allowed_lateness_refires"]


@pytest.mark.parametrize("name", UNKEYED)
def test_ordered_work_without_key_has_no_nested_loop(spark, small_chunks, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
