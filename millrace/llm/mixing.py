"""Mix sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Every source gets a budget of words.  Whole epochs come first: a source whose budget is twice its size is taken twice.
The rest of the budget is filled by a weighted sample without replacement: each document gets the exponential key
-ln(u) / quality, with u from a hash of its id; documents are taken in order of the key until the words before them
reach the budget, and the last one is taken in part.

Prefix sums per source do not put a source into one task: its keys are cut into slots of about `slot_rows` documents
by their rank in the exponential distribution, slots are summed first, and the window runs per (source, slot).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.staging import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, share: float, epochs: float, weights: tuple[float, ...]) -> DataFrame:
    """Budget of each source, from one row per source (`source`, `source_size`).

    Sources in code point order, null last, weigh `weights`, repeating.  They share `share` of all sizes; a source
    stops at `epochs` times its size and its excess goes to the others by weight.  That is one water level: sources
    in order of epochs * size / weight are full as long as the level is above them.  The windows here have no key,
    but see one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight)
    rows = rows.withColumn("cap", F.lit(epochs) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    rows = rows.withColumns({
        "_total": F.sum("source_size").over(Window.partitionBy()) * F.lit(share),
        "_full": F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "_open": F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
    })
    # The level if exactly the sources before this one are full.  It rises as long as that is too few and falls once
    # it is too many, so the true level is the greatest.
    level = (F.col("_total") - F.col("_full")) / F.col("_open")
    rows = rows.withColumn("_level", F.max(level).over(Window.partitionBy()))
    target = F.least(F.col("cap"), F.col("_level") * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def uniform(key: Column) -> Column:
    """In (0, 1], from 52 bits of a digest, so that other engines get the same number."""
    return (F.conv(F.substring(F.sha2(key, 256), 1, 13), 16, 10).cast("double") + 1) / F.lit(float(1 << 52))


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    share: float = 1.5,
    epochs: float = 2.0,
    weights: tuple[float, ...] = WEIGHTS,
    slot_rows: int = 20_000,
) -> DataFrame:
    """How many words of each document the mix takes.

    `docs` has doc_id, text, source; `quality` has doc_id and a positive `quality` (unknown: 1).  Returns doc_id,
    source, size, source_size, target, taken, and `copies` (whole copies), `part` (words of one more, cut copy).
    Null texts have size 0 and are not taken.  Null sources are one source.  Rows that repeat a doc_id are documents
    of their own; ties of the key are cut by the text's digest, and equal rows are interchangeable.
    """
    sized = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("_tie"),
    )
    if quality is not None:
        # One row per id, whatever the quality table repeats.
        weight = quality.where("quality > 0").groupBy("doc_id").agg(F.max("quality").cast("double").alias("quality"))
        sized = sized.join(weight, "doc_id", "left")
        sized = sized.withColumn("quality", F.coalesce("quality", F.lit(1.0)))
    else:
        sized = sized.withColumn("quality", F.lit(1.0))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    sized = sized.withColumn("_key", -F.log(uniform(name)) / F.col("quality"))
    sized = staged(sized, "sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_docs"))
    budget = targets(per_source.select("source", "source_size"), share, epochs, weights)
    plan = per_source.select(F.col("source").alias("_s"), "_docs").join(
        budget, F.col("_s").eqNullSafe(F.col("source")), "inner"
    ).drop("source")
    plan = staged(plan, "targets")
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("_s")), "inner").drop("_s")
    slots = F.ceil(F.col("_docs") / F.lit(slot_rows))
    rank = F.lit(1.0) - F.exp(-F.col("_key"))
    rows = rows.withColumn("_slot", F.floor(rank * slots).cast("long"))
    rows = staged(rows, "slots")
    sums = rows.groupBy("source", "_slot").agg(F.sum("size").alias("_slot_size"))
    earlier = Window.partitionBy("source").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("_s"), F.col("_slot").alias("_at"),
        F.coalesce(F.sum("_slot_size").over(earlier), F.lit(0)).alias("_before_slot"),
    )
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_slot") == F.col("_at")), "inner")
    inside = (
        Window.partitionBy("source", "_slot").orderBy("_key", "doc_id", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.col("_before_slot") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    rows = rows.withColumn("_before", before)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor(F.col("target") - whole * F.col("source_size")).cast("long")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("_before")))
    rows = rows.withColumns({"_whole": whole, "_part": part})
    full = (F.col("_part") == F.col("size")) & (F.col("size") > 0)
    return rows.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("_whole") * F.col("size") + F.col("_part")).alias("taken"),
        F.when(F.col("size") > 0, F.col("_whole") + full.cast("long")).otherwise(0).alias("copies"),
        F.when(full, 0).otherwise(F.col("_part")).alias("part"),
        F.col("_tie").alias("text_sha256"),
    )


def label_quality(labels: DataFrame) -> DataFrame:
    """Sampling weights from quality labels: good rows come twice as early, poor ones half as early."""
    return labels.where("quality is not null").select(
        "doc_id", F.when(F.col("quality") > 0, F.lit(2.0)).otherwise(F.lit(0.5)).alias("quality")
    )


_LETTERS = "[^\\x20\\x09-\\x0D]+"
ORACLE = f"""
with q as (select doc_id, max(case when quality > 0 then 2.0 else 0.5 end)::double as quality from labels
    where quality is not null group by doc_id),
d as (select documents.doc_id, source, coalesce(len(regexp_extract_all(text, '{_LETTERS}')), 0)::bigint as size,
    sha256(coalesce(text, '')) as tie, coalesce(q.quality, 1.0) as quality,
    (('0x' || substr(sha256(coalesce(documents.doc_id::varchar, '')), 1, 13))::bigint::double + 1) / 4503599627370496.0 as u
    from documents left join q on documents.doc_id = q.doc_id),
k as (select *, -ln(u) / quality as key from d),
s as (select source, sum(size)::bigint as source_size,
    list_element([3.0::double, 1.0, 2.0], ((row_number() over (order by source asc nulls last) - 1) % 3 + 1)::bigint) as weight
    from d group by source),
r as (select *, 2.0::double * source_size as cap, 2.0::double * source_size / weight as ratio from s),
l as (select *, ((sum(source_size) over ())::double * 1.5 - coalesce(sum(cap) over
    (order by ratio, source asc nulls last rows between unbounded preceding and 1 preceding), 0)) /
    sum(weight) over (order by ratio, source asc nulls last rows between current row and unbounded following) as level from r),
t as (select source, source_size,
    least(cap, max(level) over () * weight) as target from l),
w as (select k.*, source_size, target, coalesce(sum(size) over (partition by k.source order by key, doc_id, tie
    rows between unbounded preceding and 1 preceding), 0)::bigint as before
    from k join t on k.source is not distinct from t.source),
e as (select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from w)
select doc_id, size, source_size, target,
  whole * size + greatest(0, least(size, floor(target - whole * source_size)::bigint - before)) as taken from e
"""
