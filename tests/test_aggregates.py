"""User-defined aggregates keep keys exactly as `groupBy` does."""

from datetime import datetime

from pyspark.sql import functions as F

from millrace.operators.aggregates import COUNT, Aggregate, aggregate_with

def span():
    """Greatest less least value; made here, as workers cannot import this module."""

    def join(a, b):
        return b if a[0] is None else a if b[0] is None else (min(a[0], b[0]), max(a[1], b[1]), a[2] + b[2])

    return Aggregate(
        state_schema="low double, high double, n long",
        result_schema="span double, n long",
        create=lambda: (None, None, 0),
        add=lambda s, rows: join(s, (rows["v"].min(), rows["v"].max(), len(rows))),
        merge=join,
        result=lambda s: (s[1] - s[0], s[2]),
    )


def test_null_large_and_text_keys(spark):
    big = 2**53
    rows = [(big + 1, "a", 1.0), (big, "a", 2.0), (None, "a", 3.0), (None, None, 4.0), (None, "a", 5.0), (-big - 1, "", 6.0)]
    df = spark.createDataFrame(rows * 3, "k long, s string, v double").withColumn("t", F.lit(datetime(2020, 1, 1, 0, 0, 0, 7)))
    keys = ["k", "s", "t"]
    for parts in (1, 5):
        got = aggregate_with(df.repartition(parts), keys, COUNT, ["v"])
        want = df.groupBy(*keys).agg(F.count("*").alias("n"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        got = aggregate_with(df.repartition(parts), ["k"], span(), ["v"])
        want = df.groupBy("k").agg((F.max("v") - F.min("v")).alias("span"), F.count("*").alias("n"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert aggregate_with(df.limit(0), ["k"], COUNT, ["v"]).count() == 0
