"""Streaming jobs made of the operators that batch tables use."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import interval, span_us
from millrace.operators.alerts import daily_rank, login_risk, rise_spans, utc_day
from millrace.operators.rolling import peer_count, previous_value
from millrace.operators.topn import hot_in_panes, top_n
from millrace.operators.windows import pane_counts
from millrace.plans.skew import salted_join, small
from millrace.sinks.batches import BatchWriter, latest_per_key, parquet_batches, split_batches
from millrace.sinks.upserts import UpsertStore, with_order
from millrace.streaming.carried import Carried, Release, Watermark, at_or_before, held, us, without_marker

MS = 1000


def top_n_batches(path: str, group: list[str], by: list[Column], n: int) -> BatchWriter:
    """Rank inside each micro-batch.  In append mode all rows of a window leave together, when the
    watermark passes its end, so the ranking of a batch is complete for the windows in it."""
    return parquet_batches(path, lambda batch: top_n(batch, group, by, n))


def watermarked_pairs(df: DataFrame, ts: str, size: str, key: str) -> DataFrame:
    """First row of each (window, key): the streaming form of an exact distinct count per window."""
    window = F.window(ts, size)
    return df.select(window.alias("window"), F.col(key)).dropDuplicates(["window", key])


def rule_batches(path: str, rules: Callable[[], DataFrame], on: list[str]) -> BatchWriter:
    """Join each micro-batch with the rules as they stand when it runs; a changed rule table counts from the
    next micro-batch on.  The rules are broadcast if they are counted to be few."""
    return parquet_batches(path, lambda batch: batch.join(small(rules()), on, "left"))


def late_batches(path: str, ts: str, size: str, delay: str, lateness: str) -> BatchWriter:
    """Send rows whose window had closed before their micro-batch to `late`, the others to `main`.

    A window [s, e) closes when the watermark reaches e - 1 ms plus the lateness.  The watermark of the batches before
    is one row, so a batch costs the same however many went before, and a restarted query goes on with it.
    """
    mark = Watermark(f"{path}/watermark", ts, delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        with held(batch):
            before, _ = mark.advance(batch, batch_id)
            late = at_or_before(window_us(ts, size) + span_us(size) - MS + span_us(lateness), before)
            routes = {"main": lambda rows: rows.where(~late), "late": lambda rows: rows.where(late)}
            split_batches(path, routes)(batch, batch_id)

    return write


def keyed_context_batches(path: str, key: str, ts: str, delay: str) -> BatchWriter:
    """Each row with what a keyed function can ask for: `current_key`, `event_ms`, the watermark its batch meets
    (`watermark_ms`, null at first) and the time it is processed (`processing_ms`)."""
    mark = Watermark(f"{path}/watermark", ts, delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        with held(batch):
            before, _ = mark.advance(batch, batch_id)
            context = {
                "current_key": F.col(key), "event_ms": F.floor(us(ts) / 1000),
                "watermark_ms": F.lit(None if before is None else before // 1000).cast("long"),
                "processing_ms": F.unix_millis(F.current_timestamp()),
            }
            batch.withColumns(context).write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")

    return write


def window_us(ts: str, size: str) -> Column:
    at = us(ts)
    return at - F.pmod(at, F.lit(span_us(size)))


def refiring_windows(
    path: str, ts: str, size: str, delay: str, lateness: str, keys: list[str], aggs: dict[str, tuple[Column, str]]
) -> BatchWriter:
    """Tumbling windows with allowed lateness: `out` gets each result of a window, `late` the rows that came too late.

    A window fires once the watermark reaches its last millisecond (`firing` 0), and again in every later micro-batch
    that brings rows for it, until the lateness is over.  State is one row per open window and key: its aggregates,
    firings so far and closing time; it goes when the window closes.  `aggs` maps a name to the aggregate of new rows
    and the function that merges two of them (sum, min, max).
    """
    width, extra = span_us(size), span_us(lateness)
    mark, table = Watermark(f"{path}/watermark", ts, delay), Carried(f"{path}/windows")
    merge = {"sum": F.sum, "min": F.min, "max": F.max}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with held(batch):
            before, after = mark.advance(batch, batch_id)
            rows = without_marker(batch, ts)
            start = window_us(ts, size)
            late = at_or_before(start + width - MS + extra, before)
            new = rows.where(~late).groupBy(*keys, start.alias("_start")).agg(*[a.alias(n) for n, (a, _) in aggs.items()])
            new = new.withColumns({"_fired": F.lit(0).cast("long"), "_new": F.lit(True), "_now": F.lit(False)})
            old = table.before(spark, batch_id, new.schema)
            old = old.where(~at_or_before(F.col("_start") + width - MS + extra, before)).withColumn("_new", F.lit(False))
            both = old.unionByName(new).groupBy(*keys, "_start").agg(
                *[merge[how](n).alias(n) for n, (_, how) in aggs.items()],
                F.max("_fired").alias("_fired"), F.max("_new").alias("_new"),
            )
            fires = at_or_before(F.col("_start") + width - MS, after) & (F.col("_new") | (F.col("_fired") == 0))
            both = both.withColumn("_now", fires).withColumn("_fired", F.col("_fired") + fires.cast("long"))
            kept = table.keep(both.select(new.columns), batch_id)
            stamps = [F.timestamp_micros(F.col("_start") + d).alias(n) for n, d in (("window_start", 0), ("window_end", width))]
            out = kept.where("_now").select(*keys, *stamps, (F.col("_fired") - 1).alias("firing"), *aggs)
            out.write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")
            rows.where(late).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")

    return write


def count_changes(path: str, keys: list[str], every: int = 16) -> BatchWriter:
    """Grouped count as a changelog: for each key of a micro-batch (is_add false, old count), if there was one, and
    (is_add true, new count).

    The counts are an `UpsertStore`: a batch reads it as the batch before left it and adds the counts that changed.
    """
    store = UpsertStore(f"{path}/counts", keys, ["_batch"], ["n"], every)

    def write(batch: DataFrame, batch_id: int) -> None:
        new = batch.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("_more"))
        before = _as_of(store, batch, batch_id, keys, "n long")
        changed = new.join(before, keys, "left").select(*keys, F.col("n").alias("_old"), (F.coalesce("n", F.lit(0)) + F.col("_more")).alias("n"))
        entry = lambda add, n: F.struct(F.lit(add).alias("is_add"), F.col(n).alias("n"))
        steps = F.when(F.col("_old").isNull(), F.array(entry(True, "n"))).otherwise(F.array(entry(False, "_old"), entry(True, "n")))
        target = f"{path}/out/batch={batch_id}"
        changed.select(*keys, F.inline(steps)).write.mode("overwrite").parquet(target)
        added = batch.sparkSession.read.parquet(target).where("is_add").select(*keys, "n")
        store.write(with_order(added, batch_id), batch_id)

    return write


def _as_of(store: UpsertStore, batch: DataFrame, batch_id: int, keys: list[str], fields: str) -> DataFrame:
    types = ", ".join(f"`{k}` {batch.schema[k].dataType.simpleString()}" for k in keys)
    return store.read(batch.sparkSession, f"{types}, {fields}, _batch long", until=batch_id - 1)


def over_count(path: str, keys: list[str], order: list[str], delay: str, out: str, every: int = 16) -> BatchWriter:
    """`count(*) OVER (PARTITION BY keys ORDER BY ts)` on a stream whose rows come up to `delay` late.

    Rows are released in event-time order, so those of a batch follow all rows before: their number is the count of
    their peers and predecessors in the batch plus what their key had reached, which an `UpsertStore` keeps.  Rows
    without a key, and rows behind the watermark, are left out.
    """
    release = Release(path, order[0], delay)
    store = UpsertStore(f"{path}/counts", keys, ["_batch"], ["n"], every)

    def write(batch: DataFrame, batch_id: int) -> None:
        with held(batch):
            due, *_ = release.advance(batch, batch_id, lambda rows: rows.dropna(subset=keys))
            before = _as_of(store, batch, batch_id, keys, "n long").withColumnRenamed("n", "_had")
            counted = peer_count(due, keys, order, "_here")
            rows = salted_join(counted, before, keys, "left", left_by=order)
            total = (F.col("_here") + F.coalesce("_had", F.lit(0))).alias(out)
            target = f"{path}/out/batch={batch_id}"
            rows.select(*due.columns, total).write.mode("overwrite").parquet(target)
            reached = batch.sparkSession.read.parquet(target).groupBy(*keys).agg(F.max(out).alias("n"))
            store.write(with_order(reached, batch_id), batch_id)

    return write


def hot_windows(
    path: str, ts: str, size: str, slide_by: str, keys: list[str], n: int, delay: str,
    shape: Callable[[DataFrame], DataFrame] | None = None,
) -> BatchWriter:
    """The `n` most frequent keys of each sliding window, written once the watermark has passed its end.

    State is one count per pane and key, for the panes that windows still open can hold.  The windows that end between
    two watermarks are made from them by `hot_in_panes`, without a copy of a row or pane per window.  `shape` makes the
    keys of the rows of a micro-batch, by a join for example.  Rows whose pane is behind the watermark are late and go.
    """
    width, step = span_us(size), span_us(slide_by)
    mark, table = Watermark(f"{path}/watermark", ts, delay), Carried(f"{path}/panes")

    def first_open(at: int | None) -> int | None:
        """Start of the first window that ends after `at`."""
        return None if at is None else (at - width) // step * step + step

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with held(batch):
            before, after = mark.advance(batch, batch_id)
            rows = without_marker(batch, ts)
            new = pane_counts(shape(rows) if shape else rows, ts, size, slide_by, keys)
            pane = math.gcd(width, step)
            new = new.where(~at_or_before(F.col("_pane") + pane, before))
            old = table.before(spark, batch_id, new.schema)
            lo, hi = first_open(before), first_open(after)
            if lo is not None:
                old = old.where(F.col("_pane") >= lo)
            panes = old.unionByName(new).groupBy(*new.columns[:-1]).agg(F.sum("n").alias("n")).select(new.columns)
            kept = table.keep(panes, batch_id)
            if hi is None:
                kept = kept.limit(0)  # no event time yet
            hot_in_panes(kept, size, slide_by, keys, n, (lo, hi)).write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")

    return write


def login_risk_batches(
    path: str, keys: list[str], order: list[str], failed: Column, succeeded: Column, reach: str, delay: str, least: int = 2
) -> BatchWriter:
    """`operators.alerts.login_risk` on a stream: the same buckets of failures, across micro-batches.

    Rows are released in event-time order and joined by the failures of the bucket that their key had open.  A bucket is
    final once a success has ended it or the watermark has passed its reach; the failures of the one that is not wait
    for the next batch.
    """
    ts = order[0]
    release, table, buckets = Release(path, ts, delay), Carried(f"{path}/open"), Carried(f"{path}/buckets")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with held(batch):
            shape = lambda rows: rows.select(*keys, *order, failed.alias("_bad"), succeeded.alias("_good"))
            due, _, after = release.advance(batch, batch_id, shape)
            rows = due.unionByName(table.before(spark, batch_id, due.schema))
            found = buckets.keep(login_risk(rows, keys, order, F.col("_bad"), F.col("_good"), reach, 1), batch_id)
            end = F.col("first_fail") + interval(reach)
            final = (F.col("alert_ts") < end) | at_or_before(us(end), after)
            found.where(final & (F.col("fails") >= least)).write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")
            # A key has at most one bucket that is not final, its last.
            open_ = found.where(~final).select(*keys, "first_fail")
            waiting = rows.where("_bad").join(open_, keys).where(F.col(ts) >= F.col("first_fail"))
            table.keep(waiting.select(due.columns), batch_id)

    return write


def _newest(store: UpsertStore, due: DataFrame, batch_id: int, keys: list[str]) -> DataFrame:
    """The newest row, before this batch, of the keys that have rows in it."""
    before = store.read(due.sparkSession, due.schema, until=batch_id - 1)
    return before.join(due.select(*keys).distinct(), keys, "left_semi")


def last_value_batches(
    path: str, keys: list[str], order: list[str], value: str, out: str, delay: str, every: int = 16
) -> BatchWriter:
    """`operators.rolling.previous_value` on a stream whose rows come up to `delay` late.

    Rows are released in event-time order; an `UpsertStore` has the newest row of each key, which goes ahead of the key's
    rows of the batch.  Rows without a key, and rows behind the watermark, are left out.
    """
    release = Release(path, order[0], delay)
    store = UpsertStore(f"{path}/last", keys, order, [*order, value], every)

    def write(batch: DataFrame, batch_id: int) -> None:
        with held(batch):
            shape = lambda rows: rows.dropna(subset=keys).select(*keys, *order, value)
            due, *_ = release.advance(batch, batch_id, shape)
            ahead = _newest(store, due, batch_id, keys).withColumn("_new", F.lit(False))
            rows = due.withColumn("_new", F.lit(True)).unionByName(ahead)
            found = previous_value(rows, keys, order, value, out).where("_new").drop("_new")
            found.write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")
            store.write(due, batch_id)

    return write


def rise_batches(
    path: str, keys: list[str], order: list[str], value: str, hold: str, delay: str, floor: float = -1, every: int = 16
) -> BatchWriter:
    """`operators.alerts.rise_alerts` on a stream whose rows come up to `delay` late: an alert is written once its row of
    the deadline is passed by the watermark or by a later break.

    Rows are released in event-time order.  What went before a batch is two rows per key at most: where its pending timer
    started and its newest row (carried while the timer runs), or its newest row alone, which says whether the next one
    rises (in an `UpsertStore`, as that is one row per key ever seen).  The rows of a hot key are cut into chunks.  Rows
    without a key, and rows behind the watermark, are left out.
    """
    ts, unique = order
    release, pending, spans = Release(path, ts, delay), Carried(f"{path}/pending"), Carried(f"{path}/spans")
    store = UpsertStore(f"{path}/last", keys, order, [*order, value], every)

    def write(batch: DataFrame, batch_id: int) -> None:
        with held(batch):
            shape = lambda rows: rows.dropna(subset=keys).select(*keys, *order, value)
            due, _, after = release.advance(batch, batch_id, shape)
            rows = due.withColumn("_known", F.lit(None).cast("boolean"))
            timed = pending.before(batch.sparkSession, batch_id, rows.schema)
            # Without a timer the newest row starts none: it was dealt with in its own batch.
            idle = _newest(store, due, batch_id, keys).join(timed.select(*keys).distinct(), keys, "left_anti")
            rows = rows.unionByName(timed).unionByName(idle.withColumn("_known", F.lit(False)))
            found = spans.keep(rise_spans(rows, keys, order, value, hold, floor, "_known"), batch_id)
            passed = at_or_before(us("alert_ts"), after)
            fires = F.coalesce(F.col("broken_at") > F.col("alert_ts"), passed)
            found.where(fires).drop("broken_at").write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")
            # A key has at most one timer that still runs, its last.
            running = found.where(F.col("broken_at").isNull() & ~passed).select(*keys, "rise_start")
            entry = lambda at: F.struct(at.alias(ts), F.col(unique), F.col(value), F.lit(True).alias("_known"))
            start, newest = entry(F.col("rise_start")), entry(F.col(ts))
            both = F.when(F.col("rise_start") < F.col(ts), F.array(start, newest)).otherwise(F.array(newest))
            carried = latest_per_key(rows, keys, order, [*order, value]).join(running, keys)
            pending.keep(carried.select(*keys, F.inline(both)).select(rows.columns), batch_id)
            store.write(due, batch_id)

    return write


def daily_limit_batches(path: str, keys: list[str], order: list[str], limit: int, delay: str) -> BatchWriter:
    """The first `limit` rows of each key and UTC day to `out` as `pass`, the one after them as `alert`, over rows that
    come up to `delay` late.

    State is one count per key and day, for days that the watermark has not passed.  A batch trims each key and day to
    limit + 1 rows per task before its shuffle.  Rows behind the watermark are left out.
    """
    ts = order[0]
    release, counts = Release(path, ts, delay), Carried(f"{path}/counts")
    group = [*keys, "day"]
    together = lambda df, name: df.select(F.struct(*group).alias("_g"), F.col("n").alias(name))

    def write(batch: DataFrame, batch_id: int) -> None:
        with held(batch):
            due, _, after = release.advance(batch, batch_id)
            first = daily_rank(due, keys, order).where(F.col("nth") <= limit + 1)
            new = due.withColumn("day", utc_day(ts)).groupBy(*group).agg(F.count("*").alias("n"))
            old = counts.before(batch.sparkSession, batch_id, new.schema)
            # As one struct, as null keys compare equal in it.
            rows = first.withColumn("_g", F.struct(*group)).join(together(old, "_had"), "_g", "left").drop("_g")
            rows = rows.withColumn("nth", F.col("nth") + F.coalesce("_had", F.lit(0))).where(F.col("nth") <= limit + 1)
            output = F.when(F.col("nth") <= limit, "pass").otherwise("alert").alias("output")
            rows.drop("_had").select("*", output).write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")
            totals = old.unionByName(new).groupBy(*group).agg(F.sum("n").alias("n"))
            day_end = us(F.col("day").cast("timestamp")) + span_us("1 day") - 1
            counts.keep(totals.where(~at_or_before(day_end, after)), batch_id)

    return write
