"""Greedy chains of time spans: the sequential part of timer logic, without a sequential task.

In each group a span [t, t + reach] opens at the first instant and again at the first instant after the
previous span.  Which instants open a span depends on all earlier ones, so it is no window function; but
- an instant more than `reach` after its predecessor always opens a span, so a group falls into independent
  sessions, and
- short sessions fold in one expression, while sessions of any length are solved by pointer doubling: each
  instant points to the one that would open the next span, and following 1, 2, 4, ... pointers from the
  session start marks a chain of n spans in log2(n) joins on unique keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import interval
from millrace.plans.chunks import CHUNK, Layout, layout, run_count, run_last
from millrace.plans.skew import small
from millrace.plans.staging import staged

FOLD_LIMIT = 2_000


def span_starts(df: DataFrame, plan: Layout, reach: str, fold_limit: int = FOLD_LIMIT) -> DataFrame:
    """Distinct (group columns, start) of all spans, the groups being the keys of `plan`."""
    ts, group = plan.order[0], plan.keys
    rows = df if CHUNK in df.columns else plan.assign(df)
    rows = plan.neighbour(rows, "_before", [ts])
    opens = F.col("_before").isNull() | (F.col(ts) > F.col(f"_before.{ts}") + interval(reach))
    rows = plan.running(rows, _session=run_count(opens))
    # One struct as the group: its null fields compare equal in joins.
    instants = rows.select(F.struct(*group, "_session").alias("_g"), F.col(ts).alias("_at")).distinct()
    if plan.rows <= fold_limit:
        starts = _fold(instants, reach)
    else:
        instants = staged(instants, "instants")
        long = instants.groupBy("_g").count().where(F.col("count") > fold_limit).select("_g")
        if long.limit(1).count() == 0:
            starts = _fold(instants, reach)
        else:
            long = small(long)
            starts = _fold(instants.join(long, "_g", "left_anti"), reach).unionByName(
                _double(instants.join(long, "_g", "left_semi"), reach)
            )
    return starts.select(*[F.col(f"_g.{c}").alias(c) for c in group], "start")


def _fold(instants: DataFrame, reach: str) -> DataFrame:
    """Sessions of bounded size: one pass over the sorted instants."""
    times = F.array_sort(F.collect_list("_at"))
    begin = F.slice(F.col("_times"), 1, 1)
    starts = F.aggregate(
        F.slice(F.col("_times"), F.lit(2), F.greatest(F.size("_times") - 1, F.lit(0))),
        begin,
        lambda acc, at: F.when(at > F.element_at(acc, -1) + interval(reach), F.concat(acc, F.array(at))).otherwise(acc),
    )
    sized = instants.groupBy("_g").agg(times.alias("_times"))
    return sized.select("_g", F.explode(starts).alias("start"))


def _double(instants: DataFrame, reach: str) -> DataFrame:
    """Sessions of any size."""
    jump = staged(_next_opening(instants, reach), "jump")
    marks = staged(instants.groupBy("_g").agg(F.min("_at").alias("_at")), "marks")
    while jump.limit(1).count():
        reached = marks.join(jump, ["_g", "_at"]).select("_g", F.col("_to").alias("_at"))
        marks = staged(marks.unionByName(reached).distinct(), "marks")
        onward = jump.select("_g", F.col("_at").alias("_to"), F.col("_to").alias("_next"))
        twice = jump.join(onward, ["_g", "_to"]).select("_g", "_at", F.col("_next").alias("_to"))
        jump = staged(twice, "jump")
    return marks.select("_g", F.col("_at").alias("start"))


def _next_opening(instants: DataFrame, reach: str) -> DataFrame:
    """For each instant the first one later than its span, found by merging span ends into the order."""
    ends = instants.select("_g", (F.col("_at") + interval(reach)).alias("_when"), F.lit(1).alias("_kind"), "_at")
    begins = instants.select("_g", F.col("_at").alias("_when"), F.lit(0).alias("_kind"), "_at")
    merged = begins.unionByName(ends)
    plan = layout(merged, ["_g"], ["_when", "_kind"])
    later = plan.running(merged, reverse=True, _to=run_last(F.when(F.col("_kind") == 0, F.col("_at")), strict=True))
    return later.where((F.col("_kind") == 1) & F.col("_to").isNotNull()).select("_g", "_at", "_to")
