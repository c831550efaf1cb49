"""User-defined aggregates that merge: partial states per task, then one state per key.

The contract is create / add / result / merge on pandas data.  `add` folds one batch of a key's rows into a
state row, so a key with very many rows is reduced to one state per Arrow batch and key where the rows are,
and only states are shuffled.  It is meant for aggregates that Spark lacks; a plain count or sum should use
Spark's own.

Columns keep their Arrow types (pandas alone would make a long column with nulls a float one, which merges
keys beyond 2**53); nulls are a key of their own, as in `groupBy`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

MAX_BATCH_ROWS = 200_000
MAX_HELD_KEYS = 100_000


@dataclass(frozen=True)
class Aggregate:
    """`create()` -> state tuple; `add(state, rows)`; `merge(a, b)`; `result(state)` -> result tuple."""

    state_schema: str
    result_schema: str
    create: Callable[[], tuple]
    add: Callable[[tuple, pd.DataFrame], tuple]
    merge: Callable[[tuple, tuple], tuple]
    result: Callable[[tuple], tuple]


COUNT = Aggregate(
    state_schema="n long",
    result_schema="n long",
    create=lambda: (0,),
    add=lambda state, rows: (state[0] + len(rows),),
    merge=lambda a, b: (a[0] + b[0],),
    result=lambda state: state,
)


def aggregate_with(df: DataFrame, keys: list[str], agg: Aggregate, columns: list[str]) -> DataFrame:
    key_fields = df.select(*keys).schema.fields
    partial_schema = StructType([*key_fields, *StructType.fromDDL(agg.state_schema).fields])
    result_schema = StructType([*key_fields, *StructType.fromDDL(agg.result_schema).fields])
    state_names = StructType.fromDDL(agg.state_schema).names
    partial_arrow, result_arrow = to_arrow_schema(partial_schema), to_arrow_schema(result_schema)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in _larger(batches):
            for key, rows in _groups(batch, keys):
                held[key] = agg.add(held.get(key) or agg.create(), rows)
            if len(held) > MAX_HELD_KEYS:
                yield _batch(held, partial_arrow)
                held = {}
        if held:
            yield _batch(held, partial_arrow)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by key, so only the last key of a batch can go on in the next one.
        open_key, open_state = None, None
        for batch in batches:
            done: dict[tuple, tuple] = {}
            columns = batch.to_pydict()
            for key, row in zip(zip(*(columns[k] for k in keys)), zip(*(columns[n] for n in state_names)), strict=True):
                if key != open_key:
                    if open_key is not None:
                        done[open_key] = agg.result(open_state)
                    open_key, open_state = key, agg.create()
                open_state = agg.merge(open_state, row)
            if done:
                yield _batch(done, result_arrow)
        if open_key is not None:
            yield _batch({open_key: agg.result(open_state)}, result_arrow)

    states = df.select(*dict.fromkeys([*keys, *columns])).mapInArrow(partial, partial_schema)
    together = states.repartition(*keys).sortWithinPartitions(*keys)
    return together.mapInArrow(final, result_schema)


def _groups(batch: pa.Table, keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    for key, rows in batch.to_pandas(types_mapper=pd.ArrowDtype).groupby(keys, sort=False, dropna=False):
        yield tuple(None if v is pd.NA else v for v in key), rows


def _larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Join Arrow batches up to a fixed size, so that a key is visited less often."""
    waiting, rows = [], 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= MAX_BATCH_ROWS:
            yield pa.Table.from_batches(waiting)
            waiting, rows = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def _batch(held: dict[tuple, tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*((*k, *v) for k, v in held.items()))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
