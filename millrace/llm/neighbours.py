"""Hand sorted ranges of rows to tasks, together with the first row after and the last row before each range.

A global `lead` or `lag` without a key would put the whole table into one task.  Here the sort keys alone are dealt
out by range first; the least and greatest key of each range (two per partition) come to the driver; then every row
goes to its range once, and a row that begins or ends a range is also copied to the range before or after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.staging import staged

BEFORE, OWN, AFTER = -1, 0, 1


def _literal(row, fields) -> Column:
    return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in fields])


def _count_at_most(edges: list[Column], key: Column) -> Column:
    """How many of the sorted edges are <= key, by halving steps."""
    array = F.array(*edges)
    steps = F.array(*[F.lit(1 << b) for b in range(len(edges).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(array, at + s - 1) <= key, at + s).otherwise(at))


def ranged(
    rows: DataFrame, key: dict[str, Column], partitions: int | None = None, wrap: bool = False, before: bool = False,
    alike: tuple[str, ...] = (),
) -> DataFrame:
    """Rows in sorted ranges, one range per partition, in order of (`_range`, `_side`, key).

    `key` names the sort columns (no nulls in them) and is added to the rows.  `_side` is 0 for a row of the range
    and 1 for the row that follows it; with `before`, -1 for the row before it.  With `wrap` the first row of all
    also follows the last range.  Rows with equal keys stay together, so the key should end in a tie-break.
    With `alike`, names of key columns, a range also gets the nearest rows before and after it that differ in one of
    these from the last row before and the first row after, however many ranges of equal rows lie between.
    """
    spark = rows.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = list(key)
    only = rows.select(F.struct(*[key[c].alias(c) for c in names]).alias("k"))
    dealt = only.repartitionByRange(n, "k").withColumn("p", F.spark_partition_id())
    if alike:
        # Borders come from a sample, which another run of this plan would draw anew; the keys are read twice.
        dealt = staged(dealt, "ranges")
    ends = dealt.groupBy("p").agg(F.min("k").alias("least"), F.max("k").alias("most")).orderBy("p").collect()
    marked = rows.withColumns(key)
    if not ends:
        return marked.withColumn("_range", F.lit(0)).withColumn("_side", F.lit(OWN))
    fields = only.schema["k"].dataType.fields
    least, most = ([_literal(e[name], fields) for e in ends] for name in ("least", "most"))
    k = F.struct(*names)
    marked = marked.withColumn("_range", (_count_at_most(least, k) - 1).cast("int"))
    home = F.col("_range")
    places = [F.struct(home.alias("_range"), F.lit(OWN).alias("_side"))]
    follows = F.struct((home - 1).alias("_range"), F.lit(AFTER).alias("_side"))
    places.append(F.when((home > 0) & (F.get(F.array(*least), home) == k), follows))
    if wrap:
        last = F.struct(F.lit(len(ends) - 1).alias("_range"), F.lit(AFTER).alias("_side"))
        places.append(F.when((home == 0) & (least[0] == k), last))
    if before:
        leads = F.struct((home + 1).alias("_range"), F.lit(BEFORE).alias("_side"))
        places.append(F.when((home < len(ends) - 1) & (F.get(F.array(*most), home) == k), leads))
    copies = F.filter(F.array(*places), lambda p: p.isNotNull())
    if alike:
        copies = F.concat(copies, *_beyond(dealt, ends, fields, alike, home, k))
    marked = marked.withColumn("_place", F.explode(copies)).select(
        *[c for c in marked.columns if c != "_range"], "_place.*"
    )
    dealt = marked.repartitionById(len(ends), F.col("_range"))
    return dealt.sortWithinPartitions("_range", "_side", *names)


def _beyond(dealt: DataFrame, ends: list, fields, alike: tuple[str, ...], home: Column, k: Column) -> list[Column]:
    """Places of the rows that end a stretch of alike rows in other ranges than it began (two rows per range at most)."""
    def same(a, b):
        return all(a[c] == b[c] for c in alike)

    def differs(end):
        return F.struct(*[F.col(f"k.{c}") for c in alike]) != F.struct(*[F.col(f"{end}.{c}") for c in alike])

    edges = F.broadcast(dealt.groupBy("p").agg(F.min("k").alias("least"), F.max("k").alias("most")))
    turns = dealt.join(edges, "p").groupBy("p").agg(
        F.min(F.when(differs("least"), F.col("k"))).alias("first"), F.max(F.when(differs("most"), F.col("k"))).alias("last")
    )
    turns = {r["p"]: r for r in turns.collect()}
    n, out = len(ends), []
    for edge, turn, step, side in (("least", "first", 1, AFTER), ("most", "last", -1, BEFORE)):
        wanted: dict[tuple[int, str], list[int]] = {}
        other = "most" if step > 0 else "least"
        # From the far end inwards: where the stretch that begins at a range's edge ends.
        stop: list = [None] * n
        for j in range(n - 1, -1, -1) if step > 0 else range(n):
            i = j + step
            if turns[ends[j]["p"]][turn] is not None:
                stop[j] = (j, turn)
            elif 0 <= i < n:
                stop[j] = stop[i] if same(ends[j][edge], ends[i][edge]) else (i, edge)
        for r in range(n):
            j = r + step
            if 0 <= j < n and same(ends[r][other], ends[j][edge]) and stop[j]:
                wanted.setdefault(stop[j], []).append(r)
        for name in (edge, turn):
            if not any(at[1] == name for at in wanted):
                continue
            rows = [ends[j][name] if name == edge else turns[ends[j]["p"]][name] for j in range(n)]
            none = F.lit(None).cast("struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in fields) + ">")
            keys = F.array(*[_literal(x, fields) if (j, name) in wanted else none for j, x in enumerate(rows)])
            targets = F.array(*[F.array(*[F.lit(r) for r in wanted.get((j, name), [])]).cast("array<int>") for j in range(n)])
            copies = F.transform(F.get(targets, home), lambda t: F.struct(t.alias("_range"), F.lit(side).alias("_side")))
            out.append(F.when(F.get(keys, home) == k, copies).otherwise(F.array().cast("array<struct<_range:int,_side:int>>")))
    return out
