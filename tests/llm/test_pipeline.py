import brute
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from millrace.llm.toxicity import toxicity
from millrace.plans.staging import staged


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(SF_SMALL + "/documents.parquet")
    extra = spark.createDataFrame(
        [(9001, "A copy here", "en", "src1", 11), (9002, "a COPY here", "en", "src1", 11), (9003, None, None, None, None),
         (9004, "", "en", "src2", 0), (9002, "a COPY here", "en", "src1", 11)], rows.schema)
    # Extra columns whose names the stages use.
    return staged(rows.unionByName(extra).withColumns({"id": F.lit(1), "row": F.lit("r"), "copies": F.lit(2), "whole": F.lit("w")}), "docs")


def pairs(df):
    return sorted((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect())


def test_stages_match_brute_force(spark, docs):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "exact_dedup", "minhash_near_dedup", "source_mixing", "best_fit_packing"]
    labels = spark.read.parquet(SF_SMALL + "/labels.parquet")
    toxic = {r.doc_id for r in toxicity(docs, labels).where("predicted = 1").collect()}
    one = staged(pipeline.without_toxic(spark, docs, SF_SMALL), "s1")
    assert pairs(one) == [p for p in pairs(docs) if p[0] not in toxic] and one.columns == docs.columns
    two = staged(pipeline.without_copies(spark, one, SF_SMALL), "s2")
    last = {}
    for doc_id, text in pairs(one):
        last[brute.lower(text)] = (doc_id, text)
    assert pairs(two) == sorted(last.values()) and two.columns == docs.columns
    three = staged(pipeline.without_near_copies(spark, two, SF_SMALL), "s3")
    kept = brute.near(pairs(two))
    assert pairs(three) == [p for p in pairs(two) if kept[p[0]][2]] and three.columns == docs.columns
    four = staged(pipeline.mixed(spark, three, SF_SMALL), "s4")
    sizes, got, originals = {}, {}, {}
    for r in three.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.words(r.text))
        originals[r.doc_id] = brute.words(r.text)
    for r in four.collect():
        words = brute.words(r.text)
        assert words and words == originals[r.doc_id][: len(words)]
        got[r.source] = got.get(r.source, 0) + len(words)
    want = brute.targets(sizes)
    assert all(abs(got.get(s, 0) - want[s]) <= 1 for s in sizes) and four.columns == docs.columns
    five = pipeline.packed(spark, four, SF_SMALL).collect()
    assert len({(r.doc_id, r.piece, r.sequence_id, r.offset) for r in five}) == len(five)


def test_empty(spark, docs):
    rows = docs.limit(0)
    for _, stage in pipeline.STAGES:
        rows = stage(spark, rows, SF_SMALL)
        assert rows.count() == 0
