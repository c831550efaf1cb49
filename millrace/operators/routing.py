"""Routing rows to tagged outputs, per-task setup, unions of feeds, redistribution."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_rows(df: DataFrame, rules: list[tuple[Column, list[str]]], otherwise: list[str]) -> DataFrame:
    """First matching rule decides; a rule may carry several tags.  One output row per tag."""
    labels = [F.array(*map(F.lit, tags)) for _, tags in rules]
    chosen = F.when(rules[0][0], labels[0])
    for (condition, _), label in zip(rules[1:], labels[1:], strict=True):
        chosen = chosen.when(condition, label)
    chosen = chosen.otherwise(F.array(*map(F.lit, otherwise)))
    return df.withColumn("tag", F.explode(chosen))


def select_tag(df: DataFrame, *tags: str) -> DataFrame:
    return df.where(F.col("tag").isin(*tags)).drop("tag")


def side_output(
    df: DataFrame, condition: Column, alert: Column, alert_name: str = "alert"
) -> tuple[DataFrame, DataFrame]:
    """Rows outside the condition stay in the main output; the others become alert texts."""
    main = df.where(~condition | condition.isNull())
    return main, df.where(condition).select(alert.alias(alert_name))


def map_with_setup(
    df: DataFrame, schema: str, setup: Callable[[], object], apply: Callable, teardown: Callable | None = None
) -> DataFrame:
    """Map whole Arrow batches with a resource that is opened once per task and closed at its end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup()
        try:
            for batch in batches:
                yield apply(resource, batch)
        finally:
            if teardown:
                teardown(resource)

    return df.mapInPandas(run, schema)


def union_all(*feeds: DataFrame) -> DataFrame:
    """Feeds of the same columns, duplicates kept; a missing column is an error."""
    return reduce(DataFrame.unionByName, feeds)


def connect(left: DataFrame, right: DataFrame, left_map: list[Column], right_map: list[Column]) -> DataFrame:
    """Two feeds of different types, each mapped to the common columns of the result."""
    return left.select(*left_map).unionByName(right.select(*right_map))


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Even redistribution without a key."""
    return df.repartition(partitions)


def key_by(df: DataFrame, *keys: str) -> DataFrame:
    """All rows of a key in one partition.  Only for keys of bounded size; aggregations need no such step."""
    return df.repartition(*keys)
