"""What a stream of micro-batches carries from one batch to the next in the shared folder.

Each batch writes a new version of its tables and reads only the version of the batch before, so a batch that is
repeated after a failure starts from the same state as its first attempt, and what a batch costs does not depend on how
many went before.  Versions older than the one before are deleted.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.times import span_us, to_micros
from millrace.plans.staging import Folder

# The end marker of a bounded stream (see `replay`).
END_OF_TIME = "2200-01-01 00:00:00"
END_US = int(datetime.fromisoformat(END_OF_TIME).replace(tzinfo=timezone.utc).timestamp()) * 1_000_000


class Carried:
    """A table with one version per batch."""

    def __init__(self, path: str):
        self.path = path

    def _versions(self, spark: SparkSession) -> list[int]:
        names = Folder(spark, self.path).names()
        whole = [n for n in names if n.startswith("batch=") and Folder(spark, f"{self.path}/{n}/_SUCCESS").exists()]
        return sorted(int(n.removeprefix("batch=")) for n in whole)

    def before(self, spark: SparkSession, batch_id: int, schema) -> DataFrame:
        """The table as the batch before left it; empty for the first batch."""
        older = [v for v in self._versions(spark) if v < batch_id]
        if not older:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.path}/batch={older[-1]}")

    def keep(self, table: DataFrame, batch_id: int) -> DataFrame:
        """Write the version of this batch and read it back."""
        spark = table.sparkSession
        target = f"{self.path}/batch={batch_id}"
        table.write.mode("overwrite").parquet(target)
        for version in self._versions(spark):
            if version < batch_id - 1:
                Folder(spark, f"{self.path}/batch={version}").delete()
        return spark.read.schema(table.schema).parquet(target)


class Watermark:
    """Highest event time so far less the delay: one row per batch."""

    def __init__(self, path: str, ts: str, delay: str):
        self.table, self.ts, self.delay = Carried(path), ts, span_us(delay)

    def advance(self, batch: DataFrame, batch_id: int) -> tuple[int | None, int | None]:
        """The watermark, in microseconds, that earlier batches have reached, and the one after this batch; None as
        long as there was no event time."""
        spark, top = batch.sparkSession, "top long"
        older = self.table.before(spark, batch_id, top)
        new = batch.agg(F.max(to_micros(self.ts)).alias("top"))
        both = older.withColumn("_old", F.lit(True)).unionByName(new.withColumn("_old", F.lit(False)))
        old, now = both.agg(F.max(F.when(F.col("_old"), F.col("top"))), F.max("top")).first()
        self.table.keep(spark.createDataFrame([(now,)], top).coalesce(1), batch_id)
        less = lambda at: None if at is None else at - self.delay
        return less(old), less(now)


def us(ts: str | Column) -> Column:
    return to_micros(ts)


def at_or_before(at: Column, mark: int | None) -> Column:
    return F.lit(False) if mark is None else F.coalesce(at <= F.lit(mark).cast("long"), F.lit(False))


@contextmanager
def held(batch: DataFrame):
    """A micro-batch that several steps read."""
    batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()


def without_marker(batch: DataFrame, ts: str) -> DataFrame:
    return batch.where(F.coalesce(us(ts) < END_US, F.lit(False)))


class Release:
    """Hands rows on once the watermark has passed them, so later steps see event-time order: all rows of a batch are
    later than those of the batches before.  Rows at or before the watermark of the earlier batches are late and go."""

    def __init__(self, path: str, ts: str, delay: str):
        self.ts, self.mark, self.waiting = ts, Watermark(f"{path}/watermark", ts, delay), Carried(f"{path}/waiting")

    def advance(
        self, batch: DataFrame, batch_id: int, shape: Callable[[DataFrame], DataFrame] | None = None
    ) -> tuple[DataFrame, int | None, int | None]:
        """The rows that are due, and the watermarks before and after this batch; `shape` projects the rows kept."""
        before, after = self.mark.advance(batch, batch_id)
        rows = without_marker(batch, self.ts).where(~at_or_before(us(self.ts), before))
        rows = shape(rows) if shape else rows
        pending = self.waiting.before(batch.sparkSession, batch_id, rows.schema).unionByName(rows)
        due = at_or_before(us(self.ts), after)
        # The version holds both, so what is due is read from a written table too.
        kept = self.waiting.keep(pending.where(~at_or_before(us(self.ts), before)), batch_id)
        return kept.where(due), before, after
