"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by the digest of the normalised text.  A new batch is aggregated to one row
per digest, checked against the index by a sort-merge anti-join, and its new digests are appended.  Both sides of
that join are unique by digest, so a text with very many copies is one row on either side; the index side needs no
shuffle and no sort beyond its buckets.  Everything runs in DataFrame functions.

Normalised: A-Z in lower case, nothing else; a null text counts as the empty text.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.staging import fresh_dir, staged


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


class DigestIndex:
    """Digests seen so far, in a bucketed table of the session's catalog.

    The table has `text_sha256`, `keep_id` (id of the row that stays), `group_size` (copies in the batch that
    brought the digest) and `batch`.  Its files lie in `path`, by default below the shared folder.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int = 64, path: str | None = None):
        self.spark = spark
        self.name = name or f"millrace_digests_{uuid.uuid4().hex}"
        self.buckets = buckets
        self.path = path or fresh_dir(spark, "digests")

    def attach(self) -> DigestIndex:
        """Make the table, or name files that an earlier session left in `path` in this session's catalog."""
        columns = "text_sha256 string, keep_id bigint, group_size bigint, batch string"
        self.spark.sql(
            f"create table if not exists `{self.name}` ({columns}) using parquet clustered by (text_sha256) "
            f"sorted by (text_sha256) into {self.buckets} buckets location '{self.path}'"
        )
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, rows: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """Deduplicate `rows` against each other and the index, and append what is new.

        Returns one row per input row: the id, `text_sha256`, `keep_id`, `group_size` (rows of this batch with an
        equal text) and `kept`.  Of equal texts in the batch the row with the largest id stays; if the digest was
        in the index before, none does and `keep_id` is the id in the index.  Repeated rows with equal id and text
        are all kept or all dropped (`distinct` them before, if one shall go).  A null id is smaller than all
        others; a group of null ids only has a null `keep_id` and its rows are kept.  Empty input gives empty output.
        """
        digests = rows.select(F.col(id_column).alias("_id"), digest(F.col(text_column)).alias("text_sha256"))
        # Hashing whole texts is the costly part: done once, 72 bytes a row stay.
        digests = staged(digests, "digests-in")
        batch = digests.groupBy("text_sha256").agg(F.max("_id").alias("keep_id"), F.count("*").alias("group_size"))
        self.attach()
        known = self.read().select("text_sha256")
        # The anti-join decides what is new, for the index and for the result alike; it is written before the index grows.
        new = staged(batch.hint("merge").join(known.hint("merge"), "text_sha256", "left_anti"), "new")
        (
            new.withColumn("batch", F.lit(uuid.uuid4().hex))
            .repartition(self.buckets, "text_sha256")
            .write.format("parquet").bucketBy(self.buckets, "text_sha256").sortBy("text_sha256")
            .option("path", self.path).mode("append").saveAsTable(self.name)
        )
        # The index has every digest of the batch by now, with the id that stays.  One row per digest on the right: the
        # adaptive join splits a digest with very many rows on the left.
        stays = batch.select("text_sha256", "group_size").join(self.read().select("text_sha256", "keep_id"), "text_sha256")
        fresh = new.select("text_sha256", F.lit(True).alias("_new"))
        out = digests.join(stays.join(fresh, "text_sha256", "left"), "text_sha256")
        kept = F.col("_new").isNotNull() & F.col("_id").eqNullSafe(F.col("keep_id"))
        return out.select(F.col("_id").alias(id_column), "keep_id", "group_size", kept.alias("kept"), "text_sha256")

    def drop(self) -> None:
        """Take the table out of the catalog; its files stay in `path`."""
        self.spark.sql(f"drop table if exists `{self.name}`")


def exact_duplicates(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Duplicates of a table by itself, through an index (by default a new one, which leaves no table in the catalog)."""
    if index:
        return index.add(docs)
    index = DigestIndex(docs.sparkSession)
    try:
        return staged(index.add(docs), "exact")
    finally:
        index.drop()


ORACLE = """
select doc_id, max(doc_id) over (partition by h) as keep_id, count(*) over (partition by h) as group_size,
  coalesce(doc_id = max(doc_id) over (partition by h), true) as kept, h as text_sha256
from (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
  as h from documents)
"""
