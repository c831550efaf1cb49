"""Running aggregates per key that do not put a whole key into one task.

A window `PARTITION BY key ORDER BY ts` sends all rows of a key to one task, which fails when a single
key (or, without a key, the whole table) holds a large share of the data.  A `Layout` cuts the ordered
rows of such keys into chunks at split points taken from the data, runs the window per (key, chunk), and
adds what earlier chunks contribute:

    rows --assign--> (key, chunk) --one shuffle--> local window --+
      \\-- partial aggregate per (key, chunk), hot keys only       |--> result
             -> prefix over the few chunk summaries --broadcast---+

Split points are the rows whose hash is 0 modulo `rate`, so they are a fixed function of the data: a
recomputed task or a second scan gets the same chunks.  About rows/rate <= MAX_SPLITS of them exist, which
bounds both broadcasts (split points and chunk summaries) whatever the size of the table.  Work without any
key has no split points to look up: its rows are dealt out by range of the order, written once, and the
range is the chunk.  An input that fits in one chunk skips all of this and runs the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.staging import staged

CHUNK = "_chunk"
CHUNK_ROWS_CONF = "millrace.chunkRows"
DEFAULT_CHUNK_ROWS = 2_000_000
MAX_SPLITS = 1 << 17
_SPLITS = "_splits"
_AXIS = "_axis"
_COLD = -1


@dataclass(frozen=True)
class Running:
    """One running aggregate; `strict` leaves the current row out."""

    kind: str
    value: Column
    strict: bool = False


def run_count(condition: Column | None = None, strict: bool = False) -> Running:
    return Running("count", F.lit(1) if condition is None else F.when(condition, 1), strict)


def run_sum(value: Column, strict: bool = False) -> Running:
    return Running("sum", value, strict)


def run_max(value: Column, strict: bool = False) -> Running:
    return Running("max", value, strict)


def run_min(value: Column, strict: bool = False) -> Running:
    return Running("min", value, strict)


def run_first(value: Column, strict: bool = False) -> Running:
    """Earliest non-null value so far."""
    return Running("first", value, strict)


def run_last(value: Column, strict: bool = False) -> Running:
    """Latest non-null value so far."""
    return Running("last", value, strict)


_LOCAL = {
    "count": F.count,
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "first": lambda c: F.first(c, ignorenulls=True),
    "last": lambda c: F.last(c, ignorenulls=True),
}

# How the prefix over chunk summaries folds, and how a carried value meets the local one.
_FOLD = {**_LOCAL, "count": F.sum}
_MEET = {
    "count": lambda local, carry: local + F.coalesce(carry, F.lit(0)),
    "sum": lambda local, carry: F.coalesce(local + carry, local, carry),
    "max": lambda local, carry: F.greatest(local, carry),
    "min": lambda local, carry: F.least(local, carry),
    "first": lambda local, carry: F.coalesce(carry, local),
    "last": lambda local, carry: F.coalesce(local, carry),
}


def default_chunk_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(CHUNK_ROWS_CONF, str(DEFAULT_CHUNK_ROWS)))


class Layout:
    """Order of rows per key, plus the split points of keys too large for one task."""

    def __init__(
        self, keys: list[str], order: list[str], splits: DataFrame | None, rows: int, steps: int = 0, ranges: int = 0
    ):
        self.keys = keys
        self.order = order
        self.splits = splits
        self.rows = rows
        self.steps = steps
        self.ranges = ranges

    @property
    def chunked(self) -> bool:
        return self.splits is not None or self.ranges > 0

    def refine(self, group: list[str]) -> Layout:
        """The same chunks for a finer grouping whose groups are unbroken runs of a key's order.

        Use it on rows that this layout has assigned: it saves planning anew, and no shuffle is added.
        """
        return Layout(group, self.order, self.splits, self.rows, self.steps, self.ranges)

    # -- chunk numbers ---------------------------------------------------------------------------

    def assign(self, df: DataFrame) -> DataFrame:
        """Add the chunk number: with keys by one broadcast lookup and no shuffle, without by range.

        Ranges hold equal shares of the rows, null times too, as the whole order decides.  They are written,
        so that a recomputed task cannot cut them differently.
        """
        if not self.chunked:
            return df.withColumn(CHUNK, F.lit(_COLD))
        if self.ranges:
            dealt = df.repartitionByRange(self.ranges, *self.order)
            return staged(dealt.withColumn(CHUNK, F.spark_partition_id()), "ranges")
        right = self.splits.select(*[F.col(k).alias(f"_s_{k}") for k in self.keys], _SPLITS, _AXIS)
        joined = df.join(F.broadcast(right), _null_safe(self.keys, "_s_"), "left")
        # Search the plain first order column; full positions matter only next to a split point's own value.
        # Nulls come first, as in the window.
        first, axis, before = F.col(self.order[0]), F.col(_AXIS), F.col("_before_axis")
        earlier = lambda at: F.coalesce(at < first, at.isNull() & first.isNotNull())
        joined = joined.withColumn("_before_axis", F.when(axis.isNotNull(), _search(axis, earlier, self.steps)))
        exact = _search(F.col(_SPLITS), lambda at: at <= _point(self.order), self.steps)
        place = F.when(F.get(axis, before).eqNullSafe(first), exact).otherwise(before)
        return (
            joined.withColumn(CHUNK, F.coalesce(F.when(axis.isNotNull(), place), F.lit(_COLD)))
            .drop(_SPLITS, _AXIS, "_before_axis", *[f"_s_{k}" for k in self.keys])
        )

    def settle(self, df: DataFrame) -> DataFrame:
        """Write rows that several later steps build on, if there are chunks.

        Each running step on split keys reads its input twice, for the rows and for the summaries, so a
        chain of steps would compute its beginning over and over.
        """
        return staged(df, "rows") if self.chunked else df

    # -- windows ---------------------------------------------------------------------------------

    def _sorted(self, reverse: bool) -> list[Column]:
        return [F.col(c).desc() if reverse else F.col(c).asc() for c in self.order]

    def _window(self, reverse: bool = False):
        return Window.partitionBy(*self.keys, CHUNK).orderBy(*self._sorted(reverse))

    def running(self, df: DataFrame, reverse: bool = False, **runs: Running) -> DataFrame:
        """Add running aggregates per key, in order or against it."""
        if CHUNK not in df.columns:
            return self.running(self.assign(df), reverse, **runs).drop(CHUNK)
        base = self._window(reverse)
        local = {
            name: _LOCAL[run.kind](run.value).over(
                base.rowsBetween(Window.unboundedPreceding, -1 if run.strict else 0)
            )
            for name, run in runs.items()
        }
        rows = df.withColumns(local)
        if not self.chunked:
            return rows
        rows = self._with_carry(df, rows, runs, reverse)
        return rows.withColumns(
            {n: _MEET[r.kind](F.col(n), F.col(f"_carry_{n}")) for n, r in runs.items()}
        ).drop(*[f"_carry_{n}" for n in runs])

    def neighbour(self, df: DataFrame, name: str, columns: list[str], ahead: bool = False) -> DataFrame:
        """Add a struct of `columns` from the row before (or ahead of) each row of its key."""
        if CHUNK not in df.columns:
            return self.neighbour(self.assign(df), name, columns, ahead).drop(CHUNK)
        picked = F.struct(*columns)
        rows = df.withColumn(name, F.lag(picked).over(self._window(reverse=ahead)))
        if not self.chunked:
            return rows
        runs = {name: run_last(picked)}
        rows = self._with_carry(df, rows, runs, reverse=ahead)
        return rows.withColumn(name, F.coalesce(name, f"_carry_{name}")).drop(f"_carry_{name}")

    def _with_carry(self, df, rows, runs: dict[str, Running], reverse: bool) -> DataFrame:
        at = F.struct(*self.order)
        earliest, latest = (F.max_by, F.min_by) if reverse else (F.min_by, F.max_by)

        def summarise(run: Running) -> Column:
            if run.kind in ("first", "last"):
                pick = earliest if run.kind == "first" else latest
                return pick(run.value, F.when(run.value.isNotNull(), at))
            return _LOCAL[run.kind](run.value)

        names = [*self.keys, CHUNK]
        summary = (
            df.where(F.col(CHUNK) != _COLD)
            .groupBy(*names)
            .agg(*[summarise(run).alias(f"_sum_{n}") for n, run in runs.items()])
        )
        chunk_order = F.col(CHUNK).desc() if reverse else F.col(CHUNK).asc()
        # A key has at most one summary per split point, so this window stays small.
        before = (
            Window.partitionBy(*(self.keys or [F.lit(0)]))
            .orderBy(chunk_order)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carry = summary.select(
            *[F.col(n).alias(f"_c_{n}") for n in names],
            *[_FOLD[run.kind](F.col(f"_sum_{n}")).over(before).alias(f"_carry_{n}") for n, run in runs.items()],
            F.count("*").over(before).alias("_earlier"),
        )
        # Only groups that go on from an earlier chunk: at most one per split point.
        carry = carry.where(F.col("_earlier") > 0).drop("_earlier")
        return rows.join(F.broadcast(carry), _null_safe(names, "_c_"), "left").drop(
            *[f"_c_{n}" for n in names]
        )


def layout(
    df: DataFrame, keys: list[str], order: list[str], chunk_rows: int | None = None
) -> Layout:
    """Plan chunks for ordered work over `df`, or over any subset of its rows.

    `order` must end in a column that makes it unique per key.  Costs one count (Parquet footers for a
    plain scan) and, only for inputs above `chunk_rows`, one scan of the key and order columns.
    """
    chunk_rows = chunk_rows or default_chunk_rows(df)
    rows = df.count()
    if rows <= chunk_rows:
        return Layout(keys, order, None, rows)
    if not keys:
        return Layout(keys, order, None, rows, ranges=min(math.ceil(rows / chunk_rows), MAX_SPLITS))
    rate = max(chunk_rows, math.ceil(rows / MAX_SPLITS))
    splits = (
        df.select(*dict.fromkeys([*keys, *order]))
        .where(F.pmod(F.xxhash64(*keys, *order), F.lit(rate)) == 0)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(_point(order))).alias(_SPLITS))
    )
    axis = F.transform(_SPLITS, lambda at: at["o0"]).alias(_AXIS)
    # Written once, as every step and its summaries look the split points up.
    splits = staged(splits.select(*keys, _SPLITS, axis), "splits")
    longest = splits.agg(F.max(F.size(_SPLITS))).first()[0]
    if not longest:
        return Layout(keys, order, None, rows)
    return Layout(keys, order, splits, rows, longest.bit_length())


def _point(order: list[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])


def _null_safe(names: list[str], prefix: str) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{prefix}{n}")) for n in names]
    )


def _search(splits: Column, passes: Callable[[Column], Column], steps: int) -> Column:
    """How many leading elements of a sorted array pass, found by halving steps."""
    sizes = F.array(*[F.lit(1 << b) for b in range(steps - 1, -1, -1)])
    return F.aggregate(
        sizes,
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= F.size(splits)) & passes(F.get(splits, at + step - 1)), at + step
        ).otherwise(at),
    )
