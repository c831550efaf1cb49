"""Run a stream over all data that is there, including the windows its watermark would hold back.

A watermark only moves with data, so `availableNow` leaves the last windows open.  A bounded stream ends
with an end marker instead: one row in the far future, read from its own small folder, which arrives in a
second run from the same checkpoint, after all data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.staging import fresh_dir
from millrace.sinks.batches import BatchWriter, parquet_batches, read_batches
from millrace.streaming.carried import END_OF_TIME

_SCHEMA = "end timestamp"


class EndMarker:
    """The folder that will hold the marker row."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        spark.createDataFrame([], _SCHEMA).write.parquet(path)

    def follow(self, feed: DataFrame, ts: str = "ts", **values) -> DataFrame:
        """`feed`, and the marker once it is set: null in every column but the event time and `values`.

        The join key of an outer join needs a value: the join drops null keys ahead of the watermark.
        """
        marker = self.spark.readStream.schema(_SCHEMA).parquet(self.path)
        columns = [
            F.col("end").alias(f.name) if f.name == ts else F.lit(values.get(f.name)).cast(f.dataType).alias(f.name)
            for f in feed.schema
        ]
        return feed.unionByName(marker.select(*columns))

    def set(self) -> None:
        row = self.spark.range(1).select(F.lit(END_OF_TIME).cast("timestamp").alias("end"))
        row.write.mode("append").parquet(self.path)


def drain(out: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append") -> None:
    """Process what is there, then stop.  Started again with the same checkpoint it goes on from there, and
    a batch that was interrupted is written again in the place of its first attempt."""
    query = (
        out.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def replay(
    spark: SparkSession,
    label: str,
    build: Callable[[EndMarker], DataFrame],
    mode: str = "append",
    writer: Callable[[str], BatchWriter] = parquet_batches,
) -> str:
    """Drain the stream that `build` makes up to its end marker; returns the folder of its output."""
    folder = fresh_dir(spark, label)
    marker = EndMarker(spark, f"{folder}/end")
    target, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
    drain(build(marker), writer(target), checkpoint, mode)
    marker.set()
    drain(build(marker), writer(target), checkpoint, mode)
    return target


def replayed(
    spark: SparkSession, label: str, build: Callable[[EndMarker], DataFrame], mode: str = "append"
) -> DataFrame:
    """What the stream wrote, without rows of the marker's own time."""
    return read_batches(spark, replay(spark, label, build, mode)).drop("batch")


def replayed_latest(
    spark: SparkSession, label: str, build: Callable[[EndMarker], DataFrame], keys: list[str], mode: str = "update"
) -> DataFrame:
    """The last update of each key."""
    rows = read_batches(spark, replay(spark, label, build, mode))
    fields = [c for c in rows.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*fields), "batch")
    return rows.groupBy(*keys).agg(newest.alias("_newest")).select(*keys, "_newest.*")
