"""Training-data pipeline over `documents`: drop toxic texts, exact copies and near copies, mix the sources to their
target weights, and pack what is left into sequences.

Each stage reads all rows its predecessor wrote.  Documents keep their columns until the last stage, which returns
the packing.  In the mix a document taken twice is two rows, and the last document of a budget is cut to the words
that the budget still holds.  SQL cannot express the classifier, the near copies or the tokenizer, so ORACLE_SQL is
None and tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import load, settle
from millrace.llm.exact_dedup import digest, exact_duplicates
from millrace.llm.minhash import near_duplicates
from millrace.llm.mixing import WORD, label_quality, mix
from millrace.llm.packing import pack
from millrace.llm.toxicity import accepted, fit
from millrace.plans.staging import staged

ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    settle(spark)
    return accepted(docs, fit(docs, load(spark, sf_dir, "labels")))


def _keyed(docs: DataFrame, **keys: Column) -> DataFrame:
    """Keys beside the whole row, so that no column of the documents can clash with them."""
    return docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in keys.items()])


def _id() -> Column:
    return F.coalesce(F.col("doc_id"), F.lit(-(2**63)))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in lower case) the row with the largest id, once."""
    settle(spark)
    kept = exact_duplicates(docs).where("kept").select(_id().alias("id"), F.col("text_sha256").alias("text_digest")).distinct()
    rows = _keyed(docs, id=_id(), text_digest=digest(F.col("text"))).dropDuplicates(["id", "text_digest"])
    return rows.join(kept, ["id", "text_digest"], "left_semi").select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, that with the smallest id."""
    settle(spark)
    kept = near_duplicates(docs).where("kept").select(_id().alias("id")).distinct()
    return _keyed(docs, id=_id()).join(kept, "id", "left_semi").select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last of a budget in part."""
    settle(spark)
    result = mix(docs, label_quality(load(spark, sf_dir, "labels")))
    source = F.struct(F.col("source"))  # a struct of a null is not null, so null sources join
    taken = result.select(_id().alias("id"), F.col("text_sha256").alias("text_digest"), source.alias("origin"), "copies", "part")
    keys = ["id", "text_digest", "origin"]
    taken = taken.groupBy(*keys).agg(F.sum("copies").alias("copies"), F.sum("part").alias("part"))
    # Equal rows are one here, with their copies added up.
    rows = _keyed(docs, id=_id(), text_digest=F.sha2(F.coalesce("text", F.lit("")), 256), origin=source).dropDuplicates(keys)
    rows = rows.join(taken.where("copies + part > 0"), keys)
    wholes = F.array_repeat(F.lit(True), F.col("copies").cast("int"))
    parts = F.array_repeat(F.lit(False), (F.col("part") > 0).cast("int"))
    rows = rows.withColumn("whole", F.explode(F.concat(wholes, parts)))
    words = F.regexp_extract_all(F.col("row.text"), F.lit(f"({WORD})"), F.lit(1))
    cut = F.when(~F.col("whole"), F.array_join(F.slice(words, F.lit(1), F.col("part").cast("int")), " "))
    columns = []
    for field in docs.schema.fields:
        value = F.col("row").getField(field.name)
        if field.name in ("text", "n_chars"):
            new = cut if field.name == "text" else F.length(cut).cast(field.dataType)
            value = F.when(F.col("whole"), value).otherwise(new)
        columns.append(value.alias(field.name))
    return rows.select(*columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and place in it."""
    return pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("minhash_near_dedup", without_near_copies),
    ("source_mixing", mixed),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each stage's rows are written to the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
