"""The operators of this package bound to the test tables, one query each, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import divergence, exact_dedup, hard_negatives, mixing, secrets, warc
from millrace.llm.common import load
from millrace.llm.exact_dedup import exact_duplicates
from millrace.llm.html_text import main_texts
from millrace.llm.minhash import near_duplicates
from millrace.llm.mixing import label_quality, mix
from millrace.llm.packing import pack
from millrace.llm.recompression import remove_repeats
from millrace.llm.token_counts import token_counts
from millrace.llm.toxicity import toxicity
from millrace.llm.warc import archive_pages
from millrace.llm.winnowing import edited_fingerprints


def near(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(load(spark, folder, "documents"))


def main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_texts(load(spark, folder, "pages"))


def toxic(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(load(spark, folder, "documents"), load(spark, folder, "labels"))


def repeats(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(load(spark, folder, "documents"))


def exact(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(load(spark, folder, "documents"))


def winnow(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(load(spark, folder, "documents"))


def archives(spark: SparkSession, folder: str) -> DataFrame:
    rows = archive_pages(spark, load(spark, folder, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def mixture(spark: SparkSession, folder: str) -> DataFrame:
    rows = mix(load(spark, folder, "documents"), label_quality(load(spark, folder, "labels")))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def packed(spark: SparkSession, folder: str) -> DataFrame:
    return pack(load(spark, folder, "documents"))


def counted(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(load(spark, folder, "documents"))


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.document_secrets(load(spark, folder, "documents"))


def divergent(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.source_divergence(load(spark, folder, "documents"))


def negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(load(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": near,
    "op2_html_main_text": main_text,
    "op3_toxicity": toxic,
    "op4_substring_dedup": repeats,
    "op5_exact_dedup": exact,
    "op6_winnowing": winnow,
    "op7_warc_normalise": archives,
    "op8_source_mixing": mixture,
    "op9_best_fit_packing": packed,
    "op10_token_counts": counted,
    "op11_secret_scan": secret_scan,
    "op12_source_divergence": divergent,
    "op13_hard_negatives": negatives,
}

ORACLES: dict[str, str] = {
    "op5_exact_dedup": exact_dedup.ORACLE,
    "op7_warc_normalise": warc.ORACLE,
    "op8_source_mixing": mixing.ORACLE,
    "op11_secret_scan": secrets.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
