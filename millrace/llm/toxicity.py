"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A word is a run of characters without white space and ASCII punctuation, A-Z lowered.  Features of a text are the
set of its words, pairs of neighbours, and pairs with one word between, hashed to 2**bits places.  FTRL-proximal keeps
a learning rate per coordinate, and its L1 term leaves most weights at exactly zero, so the model that goes to the
executors is a short list of places and weights (at most 2**bits of them).

The model is fitted on a bounded sample of the labelled rows, by one task; scoring reads every row where it lies.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pieces, raw, settle
from millrace.llm.wordhash import IS_SPACE, mix, odd, slices, word_hashes

GAP = IS_SPACE.copy()
GAP[[b for b in range(0x21, 0x80) if not chr(b).isalnum()]] = True


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.0
    epochs: int = 4
    positive: float = 2.0  # weight of a toxic row
    max_rows: int = 20_000


def features(texts: list[bytes | None], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and place of every feature occurrence of a slice of texts."""
    words, begins = word_hashes(texts, lower=True, space=GAP)
    text = np.repeat(np.arange(len(texts)), np.diff(begins))
    a, b, c, d = odd(21, 4)
    hashes, owners = [mix(words * a)], [text]
    for gap, left, right in ((1, b, c), (2, c, d)):
        if len(words) > gap:
            same = text[gap:] == text[:-gap]
            hashes.append(mix(words[:-gap] * left + words[gap:] * right)[same])
            owners.append(text[gap:][same])
    return np.concatenate(owners), (np.concatenate(hashes) >> np.uint64(64 - bits)).astype(np.int64)


def distinct(text: np.ndarray, place: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique((text.astype(np.int64) << bits) | place)
    return key >> bits, key & ((1 << bits) - 1)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def ftrl(rows: list[np.ndarray], labels: np.ndarray, s: Settings) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, places and weights after `epochs` passes over the rows in the given order."""
    size = 1 << s.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weight(at):
        root = np.sqrt(n[at])
        w = -(z[at] - np.sign(z[at]) * s.l1) / ((s.beta + root) / s.alpha + s.l2)
        return np.where((np.abs(z[at]) <= s.l1) & (at != size), 0.0, w), root

    for _ in range(s.epochs):
        for places, y in zip(rows, labels, strict=True):
            at = np.append(places, size)
            w, root = weight(at)
            g = (float(sigmoid(w.sum())) - y) * (s.positive if y else 1.0)
            step = (np.sqrt(n[at] + g * g) - root) / s.alpha
            z[at] += g - step * w
            n[at] += g * g
    w, _ = weight(np.arange(size + 1))
    places = np.flatnonzero(w[:-1])
    return float(w[-1]), places, w[places]


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> tuple[float, np.ndarray, np.ndarray]:
    """Fit on about `max_rows` labelled rows, chosen by a hash of the id; the held-out third takes no part.

    Ids without a label, null labels and null ids are left out; an id labelled twice counts as toxic if any label
    says so, and of an id that several documents have the least text is learned.  Without a single label the model is empty and every score is 0.5.
    """
    settle(docs.sparkSession)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    share = min(1.0, settings.max_rows / max(1, known.count()))
    # Bounded by max_rows (in expectation, as the hash spreads ids evenly): small enough to broadcast.
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # One row per id, so that the bound holds for rows as well.
    sample = sample.groupBy("doc_id", "_toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "_toxic")
    one = sample.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "text")

    def train(batches):
        rows, toxic = [], []
        for batch in pieces(batches):
            texts = raw(batch.column("text"))
            text, place = distinct(*features(texts, settings.bits), settings.bits)
            cuts = np.searchsorted(text, np.arange(len(texts) + 1))
            rows += [place[a:b].astype(np.int32) for a, b in zip(cuts, cuts[1:])]
            toxic += batch.column("_toxic").to_pylist()
        if rows:
            bias, places, weights = ftrl(rows, np.array(toxic, float), settings)
            yield pa.RecordBatch.from_pandas(
                pd.DataFrame({"place": np.append(places, -1), "weight": np.append(weights, bias)}), preserve_index=False
            )

    model = one.select("text", "_toxic").mapInArrow(train, "place long, weight double").toPandas()
    is_bias = model["place"] == -1
    bias = float(model.loc[is_bias, "weight"].sum())
    model = model[~is_bias]
    return bias, model["place"].to_numpy(np.int64), model["weight"].to_numpy(float)


def _scores(texts: list[bytes | None], dense: np.ndarray, bias: float, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Score of each text and how many of its distinct features have a weight."""
    total, count = np.full(len(texts), bias), np.zeros(len(texts), np.int64)
    for a, b in slices(texts):
        text, place = features(texts[a:b], bits)
        hit = np.flatnonzero(dense[place])
        text, place = distinct(text[hit], place[hit], bits)
        total[a:b] += np.bincount(text, dense[place], b - a)
        count[a:b] += np.bincount(text, minlength=b - a)
    return sigmoid(total), count


def _dense(model, bits: int) -> tuple[float, np.ndarray]:
    bias, places, weights = model
    dense = np.zeros(1 << bits, np.float32)
    dense[places] = weights
    return bias, dense


def score(docs: DataFrame, model, settings: Settings = Settings(), threshold: float = 0.7) -> DataFrame:
    """Score every whole text: doc_id, held_out, score, predicted, n_features (distinct features with a weight).

    Null and empty texts have no features and get the score of the bias alone.  Equal texts get equal scores.
    """
    bits, shared = settings.bits, docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        bias, dense = _dense(shared.value, bits)
        for batch in batches:
            value, count = _scores(raw(batch.column("text")), dense, bias, bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(value),
                 pa.array((value >= threshold).astype(np.int32)), pa.array(count)],
                names=["doc_id", "held_out", "score", "predicted", "n_features"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_features long")


def accepted(docs: DataFrame, model, settings: Settings = Settings(), threshold: float = 0.7) -> DataFrame:
    """The rows, with all their columns, whose text scores below the threshold."""
    bits, shared = settings.bits, docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        bias, dense = _dense(shared.value, bits)
        for batch in batches:
            value, _ = _scores(raw(batch.column("text")), dense, bias, bits)
            yield batch.filter(pa.array(value < threshold))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.7) -> DataFrame:
    """Fit on the labels, then score all documents."""
    return score(docs, fit(docs, labels, settings), settings, threshold)
