"""Session settings the operators rely on."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Settings that can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A broadcast of few rows may come from a scan of everything.
    "spark.sql.broadcastTimeout": "7200",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Settings that only count when the session starts.
STARTUP_CONF = {
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Start a session; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STARTUP_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else started."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    context, partitions = spark.sparkContext, "spark.sql.shuffle.partitions"
    untouched = spark.conf.get(partitions) == "200" and partitions not in dict(context.getConf().getAll())
    if context.master.startswith("local") and untouched:
        # The built-in 200 is for clusters; on one machine it means 200 state stores per stateful operator.
        spark.conf.set(partitions, str(context.defaultParallelism))
    # Functions sent to Python workers travel by value, so executors need no installed package.
    cloudpickle.register_pickle_by_value(sys.modules["millrace"])
    return spark
