"""The plan of a query as text, and what a reader looks for in it first."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

MODES = ("simple", "extended", "codegen", "cost", "formatted")


def explained(df: DataFrame, mode: str = "formatted") -> str:
    """What `df.explain(mode)` prints."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@dataclass(frozen=True)
class PlanSummary:
    """`exchanges` move rows; `pushed` and `read` are the filters and columns that reach the scans."""

    exchanges: int
    broadcasts: int
    joins: tuple[str, ...]
    python_steps: int
    pushed: tuple[str, ...]
    read: tuple[str, ...]


def summary(df: DataFrame) -> PlanSummary:
    """The physical plan before it runs, in figures: adaptive execution may still change joins and partitions."""
    text = explained(df, "simple")
    count = lambda what: len(re.findall(what, text))
    return PlanSummary(
        count(r"(?<!Broadcast)(?<!Reused)Exchange (?:hash|range|Single|Round)"),
        count(r"BroadcastExchange"),
        tuple(re.findall(r"(\w+Join|CartesianProduct)\b", text)),
        count(r"MapInArrow|MapInPandas|FlatMap\w+|ArrowEvalPython|BatchEvalPython"),
        tuple(re.findall(r"PushedFilters: \[([^\]]*)\]", text)),
        tuple(re.findall(r"ReadSchema: struct<([^>]*)>", text)),
    )
