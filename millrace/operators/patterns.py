"""Event patterns over ordered rows.

A pattern is a chain of steps.  Matching walks it from the last step to the first: every row learns what
the rest of the pattern would match after it, using only the next row (`next`) or the first later row that
fits (`followed_by`).  Both are running aggregates, so hot keys and patterns without a key are split.
`followed_by_any` pairs the matches of the two halves around it with a time-bounded join.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import interval
from millrace.operators.joins import interval_join
from millrace.plans.chunks import Layout, layout, run_last

NEXT, FOLLOWED_BY, FOLLOWED_BY_ANY = "next", "followed_by", "followed_by_any"


@dataclass(frozen=True)
class Step:
    name: str
    condition: Column
    link: str = ""
    at_least: int = 1
    at_most: int = 1


@dataclass(frozen=True)
class Pattern:
    """`Pattern.begin("a", cond).next("b", cond).times(2).within("10 seconds")`."""

    steps: tuple[Step, ...]
    limit: str | None = None

    @staticmethod
    def begin(name: str, condition: Column) -> Pattern:
        return Pattern((Step(name, condition),))

    def _then(self, name: str, condition: Column, link: str) -> Pattern:
        return replace(self, steps=(*self.steps, Step(name, condition, link)))

    def _last(self, **changes) -> Pattern:
        return replace(self, steps=(*self.steps[:-1], replace(self.steps[-1], **changes)))

    def next(self, name: str, condition: Column) -> Pattern:
        """The directly following row."""
        return self._then(name, condition, NEXT)

    def followed_by(self, name: str, condition: Column) -> Pattern:
        """The first later row that fits."""
        return self._then(name, condition, FOLLOWED_BY)

    def followed_by_any(self, name: str, condition: Column) -> Pattern:
        """Every later row that fits; needs `within`."""
        return self._then(name, condition, FOLLOWED_BY_ANY)

    def where(self, condition: Column) -> Pattern:
        """A further condition on the last step."""
        return self._last(condition=self.steps[-1].condition & condition)

    def or_(self, condition: Column) -> Pattern:
        """An alternative condition for the last step."""
        return self._last(condition=self.steps[-1].condition | condition)

    def times(self, at_least: int, at_most: int | None = None) -> Pattern:
        """The last step n times, or m to n times, other rows in between being skipped."""
        return self._last(at_least=at_least, at_most=at_most or at_least)

    def within(self, limit: str) -> Pattern:
        """Last minus first event time must be below `limit`."""
        return replace(self, limit=limit)

    def variants(self) -> list[list[Step]]:
        """The pattern with loops written out, one step list per number of repetitions."""
        out: list[list[Step]] = [[]]
        for step in self.steps:
            longer = []
            for n in range(step.at_least, step.at_most + 1):
                names = [step.name] if step.at_most == 1 else [f"{step.name}_{i + 1}" for i in range(n)]
                loop = [Step(x, step.condition, step.link if i == 0 else FOLLOWED_BY) for i, x in enumerate(names)]
                longer += [[*head, *loop] for head in out]
            out = longer
        return out


def match(
    df: DataFrame, pattern: Pattern, keys: list[str], order: list[str], columns: list[str], plan: Layout | None = None
) -> DataFrame:
    """One row per match: the keys and, for each step, `<step>_<column>`.  Overlapping matches all count.

    `order` is the event time and a column that makes it unique; without keys the pattern runs over all
    rows in order.
    """
    plan = plan or layout(df, keys, order)
    columns = list(dict.fromkeys([order[0], *columns]))
    results = [_match_variant(df, steps, pattern.limit, plan, columns) for steps in pattern.variants()]
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def _match_variant(df, steps: list[Step], limit: str | None, plan: Layout, columns: list[str]) -> DataFrame:
    cuts = [i for i, s in enumerate(steps) if s.link == FOLLOWED_BY_ANY]
    if cuts and limit is None:
        raise ValueError("followed_by_any needs within(...), which bounds the pairs of a row")
    bounds = [0, *cuts, len(steps)]
    ts = plan.order[0]
    found = None
    for start, end in zip(bounds[:-1], bounds[1:], strict=True):
        part = _chain(df, steps[start:end], plan, columns).where("_done").drop("_done")
        first, last = steps[start].name, steps[end - 1].name
        if found is None:
            found = part
        else:
            found, part = plan.settle(found), plan.settle(part)
            # The later half starts after the earlier one ends, and within the limit of it.
            near = interval_join(found, part, plan.keys, f"{previous}_{ts}", f"{first}_{ts}", "0 seconds", limit)
            found = near.where(_position(plan, first) > _position(plan, previous))
        previous = last
    if limit:
        begin, finish = F.col(f"{steps[0].name}_{ts}"), F.col(f"{steps[-1].name}_{ts}")
        found = found.where(finish < begin + interval(limit))
    wanted = [f"{s.name}_{c}" for s in steps for c in columns]
    return found.select(*plan.keys, *wanted)


def _position(plan: Layout, step: str) -> Column:
    return F.struct(*[F.col(f"{step}_{c}").alias(c) for c in plan.order])


def _chain(df: DataFrame, steps: list[Step], plan: Layout, columns: list[str]) -> DataFrame:
    """Rows that fit the first step, with the rows of steps linked by `next` and `followed_by`; `_done`
    tells whether all steps were found."""
    carried = list(dict.fromkeys([*plan.order, *columns]))
    conditions = {f"_is{i}": s.condition for i, s in enumerate(steps)}
    rows = plan.assign(df.select("*", *[c.alias(n) for n, c in conditions.items()]))
    own = F.struct(*[F.col(c).alias(c) for c in carried])
    for i in range(len(steps) - 1, -1, -1):
        found = F.struct(own.alias("at"))
        if i < len(steps) - 1:
            rest = f"_m{i + 1}"
            if steps[i + 1].link == NEXT:
                rows = plan.neighbour(rows, "_rest", [rest], ahead=True)
            else:
                fits = F.when(F.col(f"_is{i + 1}"), F.struct(F.col(rest).alias(rest)))
                rows = plan.running(rows, reverse=True, _rest=run_last(fits, strict=True))
            after = F.col(f"_rest.{rest}")
            found = F.when(after.isNotNull(), F.struct(own.alias("at"), after.alias("rest")))
        rows = rows.withColumn(f"_m{i}", F.when(F.col(f"_is{i}"), found)).drop("_rest", f"_m{i + 1}")
        if 0 < i < len(steps) - 1 and i % 2 == 0:
            rows = plan.settle(rows)
    out = [F.col(c).alias(f"{steps[0].name}_{c}") for c in carried]
    path = "_m0"
    for step in steps[1:]:
        path += ".rest"
        out += [F.col(f"{path}.at.{c}").alias(f"{step.name}_{c}") for c in carried]
    return rows.where("_is0").select(*plan.keys, *out, F.col("_m0").isNotNull().alias("_done"))


def match_or_timeout(
    df: DataFrame, pattern: Pattern, keys: list[str], order: list[str], columns: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Matches, and the first events whose match was not complete in time, with their deadline.

    For patterns with `within` whose steps are linked by `next` and `followed_by`.
    """
    steps = pattern.variants()[0]
    if pattern.limit is None or len(pattern.variants()) > 1 or any(s.link == FOLLOWED_BY_ANY for s in steps):
        raise ValueError("timeouts need within(...), and neither times(m, n) nor followed_by_any")
    columns = list(dict.fromkeys([order[0], *columns]))
    ts, first, last = order[0], steps[0].name, steps[-1].name
    rows = _chain(df, steps, layout(df, keys, order), columns)
    deadline = F.col(f"{first}_{ts}") + interval(pattern.limit)
    in_time = F.col("_done") & (F.col(f"{last}_{ts}") < deadline)
    found = rows.where(in_time).select(*keys, *[f"{s.name}_{c}" for s in steps for c in columns])
    late = rows.where(~F.coalesce(in_time, F.lit(False)))
    return found, late.select(*keys, *[f"{first}_{c}" for c in columns], deadline.alias("deadline"))
