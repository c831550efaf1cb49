"""Top-N per group and per window."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.times import from_micros, span_us
from millrace.operators.windows import pane_counts, slide_count
from millrace.plans.chunks import layout, run_sum
from millrace.plans.skew import salted_join
from millrace.plans.staging import staged

# Up to so many windows per row, copying pane counts into each window is the cheapest plan.
MAX_COPIES = 24


def top_n(df: DataFrame, group: list[str], by: list[Column], n: int) -> DataFrame:
    """The first `n` rows per group.  Spark trims each group to n rows per task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*by)).cast("long")
    return df.withColumn("rk", rank).where(F.col("rk") <= n)


def hot_in_windows(
    df: DataFrame, ts: str, size: str, slide_by: str, keys: list[str], n: int, max_copies: int = MAX_COPIES
) -> DataFrame:
    """The `n` most frequent keys of each sliding window; ties go to the smaller key.

    The plan depends on size and slide only, never on the data.
    """
    if span_us(size) <= max_copies * span_us(slide_by):
        by = [F.col("n").desc(), *[F.col(k).asc() for k in keys]]
        return top_n(slide_count(df, ts, size, slide_by, keys), ["window_end"], by, n).select("window_end", *keys, "n", "rk")
    return hot_in_panes(staged(pane_counts(df, ts, size, slide_by, keys), "panes"), size, slide_by, keys, n)


def hot_in_panes(
    panes: DataFrame, size: str, slide_by: str, keys: list[str], n: int, span: tuple[int | None, int | None] = (None, None)
) -> DataFrame:
    """The same from a written table of pane counts, for the windows that start in `span` (microseconds on the grid)."""
    by = [F.col("n").desc(), *[F.col(k).asc() for k in keys]]
    # Between two change points of a cell the ranking stands still, so only its first n become windows.
    width, step = span_us(size), span_us(slide_by)
    best = top_n(_contenders(panes, size, slide_by, keys, n, span), ["_cell", "_from"], by, n)
    starts = F.sequence(F.col("_from"), F.col("_to") - step, F.lit(step).cast("long"))
    ranked = best.withColumn("_start", F.explode(starts)).withColumn("window_end", from_micros(F.col("_start") + width))
    return ranked.select("window_end", *keys, "n", "rk")


def slide_stretches(
    panes: DataFrame, size: str, slide_by: str, keys: list[str], span: tuple[int | None, int | None] = (None, None)
) -> DataFrame:
    """Sliding window counts as stretches: the windows starting in [_from, _to) all count `n` rows.

    A pane raises the count at the first window that holds it and lowers it after the last one, so there
    are at most two stretches per pane, however many windows a pane is in.
    """
    width, step = span_us(size), span_us(slide_by)
    on_grid = lambda at: at - F.pmod(at, F.lit(step))
    change = lambda at, n: F.struct(at.alias("_from"), n.alias("_change"))
    pane = F.col("_pane")
    both = F.array(
        change(on_grid(pane - width) + step, F.col("n")), change(on_grid(pane) + step, -F.col("n"))
    )
    changes = panes.select(*keys, F.inline(both)).groupBy(*keys, "_from").agg(F.sum("_change").alias("_change"))
    plan = layout(changes, keys, ["_from"])
    rows = plan.running(plan.assign(changes), n=run_sum(F.col("_change")))
    rows = plan.neighbour(rows, "_next", ["_from"], ahead=True)
    begin, end = F.col("_from"), F.col("_next._from")
    begin = begin if span[0] is None else F.greatest(begin, F.lit(span[0]).cast("long"))
    end = end if span[1] is None else F.least(end, F.lit(span[1]).cast("long"))
    rows = rows.where(F.col("n") > 0).select(*keys, begin.alias("_from"), end.alias("_to"), "n")
    return rows if span == (None, None) else rows.where(F.col("_from") < F.col("_to"))


def _contenders(
    panes: DataFrame, size: str, slide_by: str, keys: list[str], n: int, span: tuple[int | None, int | None]
) -> DataFrame:
    """Counts of all keys that can be among the top `n` of a window, and of few others, as stretches that start and
    end together: windows of one cell starting in [_from, _to) have the same keys and counts.

    Time is cut into cells of several windows.  In a cell a key has a lowest count, if it is present
    throughout, and a highest one.  The n-th best lowest count is a bar: a key whose highest count is below
    it is beaten by n keys in every window of the cell, and is dropped.
    """
    width, step = span_us(size), span_us(slide_by)
    cell_us = step * math.ceil(math.sqrt(2 * width / step))
    cell_of = lambda at: at - F.pmod(at, F.lit(cell_us))
    stretches = slide_stretches(panes, size, slide_by, keys, span)
    touched = F.sequence(cell_of(F.col("_from")), cell_of(F.col("_to") - step), F.lit(cell_us).cast("long"))
    begin, end = F.greatest("_from", "_cell"), F.least(F.col("_to"), F.col("_cell") + cell_us)
    # A fixed number of partitions, which are not merged for being small: each row will become many stretches.
    partitions = int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = stretches.withColumn("_cell", F.explode(touched)).repartition(partitions, "_cell", *keys)
    # The pieces of a key in a cell are at most as many as the cell has windows.
    cells = pieces.groupBy("_cell", *keys).agg(
        F.sum(end - begin).alias("_covered"),
        F.min("n").alias("_low"),
        F.max("n").alias("_high"),
        F.collect_list(F.struct(begin.alias("_from"), end.alias("_to"), "n")).alias("_pieces"),
    )
    cells = staged(cells, "cells")
    throughout = cells.where(F.col("_covered") == cell_us).select("_cell", "_low", *keys)
    best = top_n(throughout, ["_cell"], [F.col("_low").desc(), *[F.col(k).asc() for k in keys]], n)
    bar = best.where(F.col("rk") == n).select(
        "_cell", F.col("_low").alias("_bar"), F.struct(*keys).alias("_bar_key")
    )
    open_cells = salted_join(cells, bar, ["_cell"], "left", left_by=keys)
    kept = open_cells.where(
        F.col("_bar").isNull()
        | (F.col("_high") > F.col("_bar"))
        | ((F.col("_high") == F.col("_bar")) & (F.struct(*keys) <= F.col("_bar_key")))
    )
    runs = kept.select("_cell", *keys, F.inline("_pieces"))
    # At most one change point per window of the cell, and its end.
    points = runs.select("_cell", F.explode(F.array("_from", "_to")).alias("_at")).groupBy("_cell").agg(
        F.array_sort(F.collect_set("_at")).alias("_points")
    )
    runs = salted_join(staged(runs, "runs"), staged(points, "points"), ["_cell"], left_by=[*keys, "_from"])
    inside = F.filter("_points", lambda at: (at >= F.col("_from")) & (at <= F.col("_to")))
    pairs = F.arrays_zip(
        F.slice(inside, 1, F.size(inside) - 1).alias("_from"), F.slice(inside, 2, F.size(inside) - 1).alias("_to")
    )
    return runs.select("_cell", *keys, "n", F.explode(pairs).alias("_part")).select(
        "_cell", *keys, "n", F.col("_part._from").alias("_from"), F.col("_part._to").alias("_to")
    )
