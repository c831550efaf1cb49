"""A keyed store that a stream updates and that stays cheap to read.

Each batch adds its latest row per key as a delta.  After `every` deltas they are folded into a snapshot:

    deltas/batch=<b>      the latest row per key of batch b
    snapshots/upto=<b>    the latest row per key of all batches up to b
    manifest/<b>          an empty file: snapshot b is whole

Readers take the newest manifest, its snapshot and the deltas after it, so a read folds one row per key and at most
`every` deltas, however long the stream runs.  A batch only folds batches before it, which are committed for good: a
batch that is repeated finds the store as its first attempt did.  A run killed between two of these steps leaves a
snapshot that no manifest names, written again later, or deltas that are covered already and read no more.  Files of
the snapshot before stay until the next fold, for readers that started with it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.staging import Folder
from millrace.sinks.batches import BatchWriter, latest_per_key


class UpsertStore:
    def __init__(self, path: str, keys: list[str], order: list[str], fields: list[str], every: int = 16):
        self.path, self.keys, self.order, self.fields, self.every = path, keys, order, fields, every
        self.carried = list(dict.fromkeys([*order, *fields]))

    def _numbers(self, spark: SparkSession, folder: str, prefix: str = "") -> list[int]:
        names = Folder(spark, f"{self.path}/{folder}").names()
        return sorted(int(n.removeprefix(prefix)) for n in names if n.removeprefix(prefix).isdigit())

    def _parts(self, spark: SparkSession, until: int | None) -> list[str]:
        """The snapshot and the deltas after it, up to the batch `until`."""
        done = [b for b in self._numbers(spark, "manifest") if until is None or b <= until]
        base = done[-1] if done else -1
        deltas = [b for b in self._numbers(spark, "deltas", "batch=") if b > base and (until is None or b <= until)]
        return [f"{self.path}/snapshots/upto={base}"] * bool(done) + [f"{self.path}/deltas/batch={b}" for b in deltas]

    def read(self, spark: SparkSession, schema=None, until: int | None = None) -> DataFrame:
        """The latest row per key.  `schema`, of keys and carried columns, is needed only while the store is empty."""
        parts = self._parts(spark, until)
        if not parts:
            return spark.createDataFrame([], schema).select(*self.keys, *self.fields)
        return latest_per_key(self._rows(spark, parts), self.keys, self.order, self.fields)

    def _rows(self, spark: SparkSession, parts: list[str]) -> DataFrame:
        # A folder alone, as partition columns of paths have no place in the rows.
        return reduce(DataFrame.unionByName, [spark.read.parquet(p).select(*self.keys, *self.carried) for p in parts])

    def write(self, batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(batch, self.keys, self.order, self.carried)
        rows.write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch_id}")
        spark = batch.sparkSession
        if len(self._parts(spark, batch_id - 1)) > self.every:
            self.compact(spark, batch_id - 1)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold all batches up to `upto` into a snapshot."""
        old = self._numbers(spark, "manifest")
        if old and old[-1] >= upto:
            return
        merged = latest_per_key(self._rows(spark, self._parts(spark, upto)), self.keys, self.order, self.carried)
        merged.write.mode("overwrite").parquet(f"{self.path}/snapshots/upto={upto}")
        Folder(spark, f"{self.path}/manifest/{upto}").touch()
        self._clean(spark, old)

    def _clean(self, spark: SparkSession, old: list[int]) -> None:
        """Drop what only snapshots before the last one needed."""
        for b in old[:-1]:
            Folder(spark, f"{self.path}/manifest/{b}").delete()
        for b in self._numbers(spark, "snapshots", "upto="):
            if old and b < old[-1]:
                Folder(spark, f"{self.path}/snapshots/upto={b}").delete()
        for b in self._numbers(spark, "deltas", "batch="):
            if old and b <= old[-1]:
                Folder(spark, f"{self.path}/deltas/batch={b}").delete()


def upsert_batches(path: str, keys: list[str], order: list[str], fields: list[str]) -> BatchWriter:
    """Writer of a store in `path`."""
    return UpsertStore(path, keys, order, fields).write


def read_upserts(spark: SparkSession, path: str, keys: list[str], order: list[str], fields: list[str]) -> DataFrame:
    return UpsertStore(path, keys, order, fields).read(spark)


def with_order(batch: DataFrame, batch_id: int, name: str = "_batch") -> DataFrame:
    """The batch number as the order of a store whose newest batch always wins."""
    return batch.withColumn(name, F.lit(batch_id).cast("long"))
