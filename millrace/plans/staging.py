"""Folders for written intermediates and stream checkpoints, on storage every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_MADE: list[str] = []  # folders of this driver, for `sweep`


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Only a local session, where every task runs on this machine, may fall back to a temporary folder.
    """
    root = spark.conf.get(_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CONF} to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set(_CONF, root)
    return root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used before."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def sweep(spark: SparkSession) -> None:
    """Delete the folders that this driver has made so far.  For the time when no result that reads them is needed any
    more, between two jobs of a long session for example."""
    while _MADE:
        Folder(spark, _MADE.pop()).delete()


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: later plans start from the table, compute nothing
    twice, know its size, and do not depend on executors that are gone."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Folder:
    """A folder or file of any store that Spark can reach, seen from the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        self.store = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.store.exists(self.path)

    def names(self) -> list[str]:
        return [f.getPath().getName() for f in self.store.listStatus(self.path)] if self.exists() else []

    def delete(self) -> None:
        self.store.delete(self.path, True)

    def uri(self) -> str:
        """The path with the scheme of its store."""
        return self.store.makeQualified(self.path).toUri().toString()

    def touch(self) -> None:
        """An empty file; stores make it visible at once or not at all."""
        self.store.create(self.path, True).close()
