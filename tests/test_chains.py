"""Greedy spans: fold and pointer doubling against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.times import from_micros
from millrace.operators.chains import span_starts
from millrace.plans.chunks import layout


def by_loop(rows, reach):
    out, open_until = set(), {}
    for key, at, _ in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        if key not in open_until or at > open_until[key]:
            out.add((key, at))
            open_until[key] = at + reach
    return out


@pytest.mark.parametrize("fold_limit", [1_000_000, 5])
@pytest.mark.parametrize("chunks", [None, 50])
def test_spans(spark, fold_limit, chunks):
    rng = random.Random(7)
    keys = ["hot"] * 6 + ["a", "b", None]
    # The hot key has a row nearly every second, so its spans form one long chain.
    data = [(rng.choice(keys), rng.randrange(600), i) for i in range(900)]
    df = spark.createDataFrame(data, "k string, s long, event_id long").withColumn(
        "ts", from_micros(F.col("s") * 1_000_000)
    )
    plan = layout(df, ["k"], ["ts", "event_id"], chunks)
    starts = span_starts(df.select("k", "ts", "event_id"), plan, "7 seconds", fold_limit)
    got = {(r[0], r[1]) for r in starts.select("k", F.unix_seconds(F.col("start").cast("timestamp"))).collect()}
    assert got == by_loop(data, 7)
    assert starts.count() == len(got)
