"""Joins that stay balanced when one key holds a large share of either side."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.chunks import default_chunk_rows
from millrace.plans.staging import staged

MAX_HOT_KEYS = 100_000
MAX_BROADCAST_ROWS = 100_000


def small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only if `df` is counted to be small; otherwise leave the join to a shuffle."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    where: Column | None = None,
    left_by: list[str] | None = None,
    right_by: list[str] | None = None,
    cell_rows: int | None = None,
) -> DataFrame:
    """Equi-join on `on` (plus an optional extra condition), splitting hot keys into a grid of cells.

    A key with l rows left and r rows right becomes ceil(l/cell_rows) x ceil(r/cell_rows) tasks' worth
    of cells: each left row meets every right slice once, so the result is the plain join.  `left_by` and
    `right_by` name columns that tell rows of one key apart and decide their slice.  A left outer join
    slices the left side only, since a left row copied over right slices could look unmatched in some.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join does inner and left joins, not {how}")
    cell_rows = cell_rows or default_chunk_rows(left)
    left_rows, right_rows = left.count(), right.count()
    if left_rows <= cell_rows and right_rows <= cell_rows:
        return _join(left, right, on, how, where)

    # At most MAX_HOT_KEYS keys per side can be over the limit.
    limit = max(cell_rows, math.ceil(max(left_rows, right_rows) / MAX_HOT_KEYS))
    hot = _slices(left, on, limit, "_ls").join(_slices(right, on, limit, "_rs"), on, "full")
    hot = hot.select(
        *on,
        F.coalesce("_ls", F.lit(1)).alias("_ls"),
        (F.coalesce("_rs", F.lit(1)) if how == "inner" else F.lit(1)).alias("_rs"),
    )
    hot = staged(hot, "hot")
    if hot.limit(1).count() == 0:
        return _join(left, right, on, how, where)

    def cut(df: DataFrame, by: list[str] | None, mine: str, other: str, mine_at: str, other_at: str):
        marked = df.join(F.broadcast(hot), on, "left")
        own = F.pmod(F.xxhash64(*(by or df.columns)), F.coalesce(mine, F.lit(1)))
        copies = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
        return marked.withColumn(mine_at, own.cast("int")).withColumn(other_at, copies).drop("_ls", "_rs")

    cells = ["_cell_l", "_cell_r"]
    joined = _join(
        cut(left, left_by, "_ls", "_rs", *cells),
        cut(right, right_by, "_rs", "_ls", *reversed(cells)),
        [*on, *cells],
        how,
        where,
    )
    return joined.drop(*cells)


def _slices(df: DataFrame, on: list[str], limit: int, name: str) -> DataFrame:
    counts = df.groupBy(*on).count().where(F.col("count") > limit)
    return counts.select(*on, F.ceil(F.col("count") / limit).cast("int").alias(name))


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str, where: Column | None) -> DataFrame:
    if where is None:
        return left.join(right, on, how)
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    equal = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_r_{c}") for c in on])
    return left.join(renamed, equal & where, how).drop(*[f"_r_{c}" for c in on])
