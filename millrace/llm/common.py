"""What several operators of this package share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.staging import staged
from millrace.session import prepare
from millrace.sources.tables import table


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A whole table, with the session set up for Arrow batches of bounded size."""
    return table(settle(spark), folder, name)


def settle(spark: SparkSession) -> SparkSession:
    """Small Arrow batches: texts can be long."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def finish(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and let Spark drop the shuffle files of everything behind it.

    Spark's cleaner removes a shuffle once the driver's collector finds that no plan refers to it any more.
    """
    out = staged(df, label)
    del df
    out.sparkSession.sparkContext._jvm.System.gc()
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that `finish` wrote, once nothing will read it again."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def worker_memo(name: str, make: Callable[[], object]):
    """A value that one Python worker makes once and keeps for its later tasks."""
    module = sys.modules.setdefault("_millrace_worker", types.ModuleType("_millrace_worker"))
    if not hasattr(module, name):
        setattr(module, name, make())
    return getattr(module, name)


def raw(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary()).to_pylist()


def slim(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that other columns of the input cannot clash with an operator's own."""
    return docs.select(*[F.col(f"`{n}`") for n in names])


def pieces(batches: Iterable[pa.RecordBatch], rows: int = 200) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
