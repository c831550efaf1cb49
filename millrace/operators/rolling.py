"""Running results: one output row per input row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.chunks import layout, run_count, run_first, run_last, run_max, run_min, run_sum


def rolling_extremes(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Running sum, max and min per key; `first_<ts>` is the key's first event time, which the other
    fields of a rolling aggregate keep."""
    v = F.col(value)
    return layout(df, keys, order).running(
        df,
        rolling_sum=run_sum(v),
        rolling_max=run_max(v),
        rolling_min=run_min(v),
        first_ts=run_first(F.col(order[0])),
    )


def rolling_reduce(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Reduce by addition; the first record of a key passes unchanged."""
    return layout(df, keys, order).running(df, **{out: run_sum(F.col(value))})


def running_count(df: DataFrame, keys: list[str], order: list[str], out: str = "n") -> DataFrame:
    return layout(df, keys, order).running(df, **{out: run_count()})


def running_distinct(df: DataFrame, item: str, order: list[str], out: str = "n") -> DataFrame:
    """Distinct items seen so far, after each row: count the rows that are the first of their item."""
    per_item, overall = layout(df, [item], order), layout(df, [], order)
    seen = per_item.settle(per_item.running(df, _nth=run_count()))
    return overall.running(seen, **{out: run_count(F.col("_nth") == 1)}).drop("_nth")


def peer_count(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """`count(*) OVER (PARTITION BY keys ORDER BY ts)`: rows of the same time count together.

    The running number of the last peer is handed back to the earlier ones, so equal times may be split
    over chunks.
    """
    plan = layout(df, keys, order)
    ts = order[0]
    rows = plan.running(plan.assign(df), _nth=run_count())
    rows = plan.settle(plan.neighbour(rows, "_after", [ts], ahead=True))
    last_peer = F.col("_after").isNull() | (F.col(f"_after.{ts}") != F.col(ts))
    rows = plan.running(rows, reverse=True, **{out: run_last(F.when(last_peer, F.col("_nth")))})
    return rows.select(*df.columns, out)


def previous_value(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """The value of the key's preceding row, null for its first row."""
    rows = layout(df, keys, order).neighbour(df, "_before", [value])
    return rows.withColumn(out, F.col(f"_before.{value}")).drop("_before")


def count_changelog(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Grouped count as changes: each row retracts the old count, if any, and adds the new one."""
    n = F.col("_nth")
    entry = lambda add, count: F.struct(F.lit(add).alias("is_add"), count.alias("n"))
    changes = F.when(n == 1, F.array(entry(True, n))).otherwise(F.array(entry(False, n - 1), entry(True, n)))
    return running_count(df, keys, order, "_nth").select(*df.columns, F.inline(changes))


def latest_rule(
    events: DataFrame, rules: DataFrame, order: list[str], rule: str, out: str
) -> DataFrame:
    """Attach to each event the newest rule row before it; rules may be as many as events.

    Both feeds go through one ordered scan without a key, so neither side is broadcast.
    """
    both = events.withColumn("_rule", F.lit(None).cast(rules.schema[rule].dataType)).withColumn("_is_rule", F.lit(False))
    control = rules.select(
        *[F.col(c) if c in order else F.lit(None).cast(events.schema[c].dataType).alias(c) for c in events.columns],
        F.col(rule).alias("_rule"),
        F.lit(True).alias("_is_rule"),
    )
    merged = both.unionByName(control)
    ordered = layout(merged, [], order).running(merged, **{out: run_last(F.col("_rule"))})
    return ordered.where(~F.col("_is_rule")).drop("_rule", "_is_rule")
