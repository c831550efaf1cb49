"""Event patterns on streams: the `Pattern` of batch tables, matched micro-batch by micro-batch.

Rows wait until the watermark has passed them, so a batch continues the event-time order of the batches before it.  The
rows that are due are matched by window functions as in batch tables (`operators/patterns.py`), with one difference: a
row that fits a step also learns how far the rest of the pattern came when the batch ended.  What is still open is
carried to the next batch as a table of partial matches, one row each, and meets the new rows through one aggregate per
key: for every step, the first new row that fits it and what follows from there.  Hot keys are cut into chunks by the
windows, partially aggregated for the heads, and split by the join.

A partial match goes when a row breaks it or `within` is over; without `within` it stays until a row does either.
`followed_by_any` cuts a pattern into segments.  A segment is matched as above; complete first segments wait until
`within` is over, and each later segment that completes is paired with those that ended before it began.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import interval, span_us
from millrace.operators.joins import interval_join
from millrace.operators.patterns import FOLLOWED_BY_ANY, NEXT, Pattern, Step
from millrace.plans.chunks import CHUNK, layout, run_last
from millrace.plans.skew import salted_join
from millrace.sinks.batches import BatchWriter
from millrace.streaming.carried import Carried, Release, at_or_before, held, us

OPEN, DONE, DEAD = 0, 1, -1


def _segments(steps: list[Step]) -> list[list[int]]:
    """Step numbers between the cuts that `followed_by_any` makes."""
    cuts = [0, *[i for i, s in enumerate(steps) if s.link == FOLLOWED_BY_ANY], len(steps)]
    return [list(range(a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]


def _reach(path: Column, state: Column) -> Column:
    return F.struct(path.alias("_path"), state.alias("_state"))


class _Matcher:
    """One variant of a pattern over the rows of one micro-batch."""

    def __init__(self, steps: list[Step], fits: list[str], keys: list[str], order: list[str], columns: list[str]):
        self.steps, self.fits, self.keys, self.order = steps, fits, keys, order
        self.row = list(dict.fromkeys([*order, *columns]))

    def progress(self, due: DataFrame) -> DataFrame:
        """Each row with `_m<i>` for every step it fits: the rows matched from there to the end of the segment, and
        whether they end it, wait for more rows, or cannot go on."""
        plan = layout(due, self.keys, self.order)
        rows = plan.assign(due)
        own = F.array(F.struct(*[F.col(c) for c in self.row]))
        for segment in _segments(self.steps):
            for i in reversed(segment):
                reach = _reach(own, F.lit(DONE))
                if i != segment[-1]:
                    name, fit = f"_m{i + 1}", self.fits[i + 1]
                    longer = lambda at: _reach(F.concat(own, at["_path"]), at["_state"])
                    if self.steps[i + 1].link == NEXT:
                        rows = plan.neighbour(rows, "_rest", [fit, name], ahead=True)
                        goes_on = F.when(F.col(f"_rest.{fit}"), longer(F.col(f"_rest.{name}"))).otherwise(_reach(own, F.lit(DEAD)))
                    else:
                        found = F.when(F.col(fit), F.struct(F.col(name)))
                        rows = plan.running(rows, reverse=True, _rest=run_last(found, strict=True))
                        goes_on = longer(F.col(f"_rest.{name}"))
                    reach = F.when(F.col("_rest").isNull(), _reach(own, F.lit(OPEN))).otherwise(goes_on)
                rows = rows.withColumn(f"_m{i}", F.when(F.col(self.fits[i]), reach))
                rows = plan.settle(rows.drop("_rest")) if i % 2 else rows.drop("_rest")
        return plan.settle(rows).drop(CHUNK)

    def begun(self, rows: DataFrame) -> DataFrame:
        """Partial and complete matches of each segment that start in this batch."""
        parts = [
            rows.where(F.col(f"_m{segment[0]}").isNotNull()).select(
                *self.keys, F.lit(k).alias("_segment"), F.col(f"_m{segment[0]}._path").alias("_path"), F.col(f"_m{segment[0]}._state").alias("_state")
            )
            for k, segment in enumerate(_segments(self.steps))
        ]
        return reduce(DataFrame.unionByName, parts)

    def continued(self, rows: DataFrame, partial: DataFrame) -> DataFrame:
        """Open matches of earlier batches after the rows of this one."""
        waiting = [i for segment in _segments(self.steps) for i in segment[1:]]
        if not waiting:
            return partial
        at = F.struct(*self.order)
        heads = []
        for i in waiting:
            if self.steps[i].link == NEXT:
                heads.append(F.min_by(F.struct(F.col(self.fits[i]).alias("fits"), F.col(f"_m{i}").alias("reach")), at).alias(f"_h{i}"))
            else:
                found = F.struct(F.lit(True).alias("fits"), F.col(f"_m{i}").alias("reach"))
                heads.append(F.min_by(found, F.when(F.col(self.fits[i]), at)).alias(f"_h{i}"))
        joined = salted_join(partial, rows.groupBy(*self.keys).agg(*heads), self.keys, "left", left_by=["_path"])
        now = _reach(F.col("_path"), F.lit(OPEN))
        for k, segment in enumerate(_segments(self.steps)):
            for n, i in enumerate(segment[1:], 1):
                head = F.col(f"_h{i}")
                longer = _reach(F.concat("_path", head["reach"]["_path"]), head["reach"]["_state"])
                stuck = _reach(F.col("_path"), F.lit(DEAD))
                after = F.when(head["fits"], longer).when(head.isNotNull(), stuck).otherwise(_reach(F.col("_path"), F.lit(OPEN)))
                now = F.when((F.col("_segment") == k) & (F.size("_path") == n), after).otherwise(now)
        return joined.select(*self.keys, "_segment", now.alias("_now")).select(*self.keys, "_segment", "_now._path", "_now._state")


def match_batches(
    path: str, pattern: Pattern, keys: list[str], order: list[str], columns: list[str], delay: str, timeouts: bool = False
) -> BatchWriter:
    """`operators.patterns.match` on a stream: the keys and, for each step, `<step>_<column>`, below `<path>/out`.

    `order` is the event time and a column that makes it unique; rows come up to `delay` late, later ones and rows
    without a first key are left out.  With `timeouts` each first event gives one row: `matched` tells whether its match
    was complete in time, `deadline` when the time is over, and the steps that are missing are null; this is for patterns
    with `within` and one variant whose steps are linked by `next` and `followed_by`.
    """
    variants = pattern.variants()
    cut = any(s.link == FOLLOWED_BY_ANY for steps in variants for s in steps)
    if pattern.limit is None and cut:
        raise ValueError("followed_by_any needs within(...), which bounds the pairs of a row")
    if timeouts and (pattern.limit is None or len(variants) > 1 or cut):
        raise ValueError("timeouts need within(...), and neither times(m, n) nor followed_by_any")
    ts, columns = order[0], list(dict.fromkeys([order[0], *columns]))
    conditions: dict[str, Column] = {s.name: s.condition for steps in variants for s in steps}
    fits = {name: f"_fits{i}" for i, name in enumerate(conditions)}
    release = Release(path, ts, delay)
    limit = span_us(pattern.limit) if pattern.limit else None

    def shape(rows: DataFrame) -> DataFrame:
        tests = [F.coalesce(c, F.lit(False)).alias(fits[name]) for name, c in conditions.items()]
        return rows.where(F.col(keys[0]).isNotNull()).select(*dict.fromkeys([*keys, *order, *columns]), *tests)

    def first(place: Column) -> Column:
        return us(F.get(place, F.lit(0))[ts])

    def last(place: Column) -> Column:
        return us(F.element_at(place, -1)[ts])

    def pair(heads: DataFrame, tails: DataFrame) -> DataFrame:
        """Later segments with the matches before them that ended before they began, the whole within the limit."""
        ends = F.element_at("_path", -1)
        a = heads.select(*keys, F.col("_path").alias("_head"), ends[ts].alias("_ended"))
        b = tails.select(*keys, F.col("_path").alias("_tail"), F.get("_path", F.lit(0))[ts].alias("_began"))
        near = interval_join(a, b, keys, "_ended", "_began", "0 seconds", pattern.limit)
        place = lambda row: F.struct(*[row[c].alias(c) for c in order])
        follows = place(F.get("_tail", F.lit(0))) > place(F.element_at("_head", -1))
        in_time = last(F.col("_tail")) < first(F.col("_head")) + limit
        return near.where(follows & in_time).select(*keys, F.concat("_head", "_tail").alias("_path"))

    def run_variant(number: int, steps: list[Step], due: DataFrame, batch_id: int, marks: tuple) -> DataFrame:
        """Complete matches of this batch (DONE) and, without followed_by_any, those that failed (DEAD)."""
        before, after = marks
        spark = due.sparkSession
        matcher = _Matcher(steps, [fits[s.name] for s in steps], keys, order, columns)
        rows = matcher.progress(due)
        new = matcher.begun(rows)
        table = Carried(f"{path}/partial-{number}")
        old = table.before(spark, batch_id, new.schema)
        both = new.unionByName(matcher.continued(rows, old.where(F.col("_state") == OPEN)))
        if limit is not None:
            over = at_or_before(first(F.col("_path")) + limit, after)
            too_late = last(F.col("_path")) >= first(F.col("_path")) + limit
            state = F.when((F.col("_state") == OPEN) & over, DEAD).when((F.col("_state") == DONE) & too_late, DEAD).otherwise(F.col("_state"))
            both = both.withColumn("_state", state)
        kept = table.keep(both, batch_id)
        segments = _segments(steps)
        if len(segments) == 1:
            return kept.where(F.col("_state") != OPEN).select(*keys, "_path", "_state")
        # A match of earlier batches whose time was over before this one can take no more rows.
        alive = lambda df: df.where(~at_or_before(first(F.col("_path")) + limit, before))
        found = kept.where(F.col("_segment") == 0)
        for k in range(len(segments)):
            fresh = kept.where((F.col("_segment") == k) & (F.col("_state") == DONE)).select(*keys, "_path")
            found = fresh if k == 0 else pair(found, fresh)
            if k < len(segments) - 1:
                # What is complete so far waits for the segments to come.
                whole = Carried(f"{path}/whole-{number}-{k}")
                found = whole.keep(alive(whole.before(spark, batch_id, found.schema)).unionByName(found), batch_id)
        return found.withColumn("_state", F.lit(DONE))

    def named(steps: list[Step], rows: DataFrame) -> DataFrame:
        cells = [F.get("_path", F.lit(i))[c].alias(f"{s.name}_{c}") for i, s in enumerate(steps) for c in columns]
        if not timeouts:
            return rows.where(F.col("_state") == DONE).select(*keys, *cells)
        # Of a failed match only the first event counts; what it had found is out of time or order.
        found = F.when(F.col("_state") == DONE, F.col("_path")).otherwise(F.slice("_path", 1, 1))
        deadline = F.get("_path", F.lit(0))[ts] + interval(pattern.limit)
        ends = [(F.col("_state") == DONE).alias("matched"), deadline.alias("deadline")]
        rows = rows.select(*keys, found.alias("_path"), *ends)
        return rows.select(*keys, "matched", *cells, "deadline")

    def write(batch: DataFrame, batch_id: int) -> None:
        with held(batch):
            due, *marks = release.advance(batch, batch_id, shape)
            parts = [named(steps, run_variant(n, steps, due, batch_id, tuple(marks))) for n, steps in enumerate(variants)]
            out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
            out.write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")

    return write
