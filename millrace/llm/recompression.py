"""Repeated passages across documents by recompression.

A text is a row of symbols, at first its words.  One round names each run of equal symbols by symbol and length, then
splits the symbols into left and right ones by a hash and names each left symbol followed by a right one as a pair.
Names are hashes of what they stand for, so they agree in all tasks without a shared dictionary, and equal substrings
get the same symbols except near their ends: a symbol depends on nothing outside its context, a short range of words
that is followed through the rounds.

For every window of `size` words the symbols of the highest level whose context lies inside the window are a function
of the window alone; the least context name among them is the window's anchor.  (A window without such a symbol, as in
a long run of one word, is its own anchor.)  Equal windows have equal anchors, and neighbouring windows mostly share
theirs.  Spark finds the anchors that occur in different texts; only windows at shared anchors are then hashed whole
(128 bits) and verified against the least doc_id that has the same window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, finish, raw, settle
from millrace.llm.wordhash import mix, odd, powers, slices, windows, word_hashes

SIZE = 13
ROUNDS = 2
_NEVER = 1 << 40


def rounds(words: np.ndarray, text: np.ndarray, count: int = ROUNDS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Contexts (first word, word after the last) of the symbols of each level, in order.

    `text` numbers the text of each word.  A symbol whose naming looked beyond its text has no context and is left out
    of the result.
    """
    name, low, high = words, np.arange(len(words)), np.arange(1, len(words) + 1)
    levels = []
    for level in range(count):
        if not len(name):
            break
        of_run, of_pair, left, right, alone = odd(50 + level, 5)
        # Runs of equal symbols: the symbols on both sides must be seen to know where a run ends.
        first = np.ones(len(name), bool)
        first[1:] = (name[1:] != name[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(first)
        after = np.append(at[1:], len(name))
        before = np.maximum(at - 1, 0)
        inside = (at > 0) & (text[before] == text[at])
        low_run = np.where(inside, low[before], -_NEVER)
        beyond = np.minimum(after, len(name) - 1)
        inside = (after < len(name)) & (text[beyond] == text[at])
        high_run = np.where(inside, high[beyond], _NEVER)
        name = mix(name[at] * of_run + (after - at).astype(np.uint64))
        text = text[at]
        low, high = low_run, high_run
        # Pairs of a left and a right symbol.
        is_right = mix(name * of_pair) >> np.uint64(63) == 1
        joins = np.zeros(len(name), bool)
        joins[:-1] = ~is_right[:-1] & is_right[1:] & (text[:-1] == text[1:])
        second = np.zeros(len(name), bool)
        second[1:] = joins[:-1]
        at = np.flatnonzero(~second)
        pair = joins[at]
        following, previous = np.minimum(at + 1, len(name) - 1), np.maximum(at - 1, 0)
        next_here = (at + 1 < len(name)) & (text[following] == text[at])
        last_here = (at > 0) & (text[previous] == text[at])
        single_left, single_right = ~pair & ~is_right[at], ~pair & is_right[at]
        new_low, new_high = low[at], high[at]
        new_high = np.where(pair | single_left, np.where(next_here, high[following], _NEVER), new_high)
        new_low = np.where(single_right, np.where(last_here, low[previous], -_NEVER), new_low)
        name = np.where(pair, mix(name[at] * left + name[following] * right), mix(name[at] * alone))
        text, low, high = text[at], new_low, new_high
        known = (low >= 0) & (high < _NEVER)
        levels.append((low[known], high[known]))
    return levels


def _ranged_least(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of values[a:b] for non-empty ranges."""
    width = b - a
    best = np.zeros(len(a), np.uint64)
    table, step = values, 1
    while True:
        fits = (width >= step) & (width < 2 * step)
        best[fits] = np.minimum(table[a[fits]], table[b[fits] - step])
        if not (width >= 2 * step).any():
            return best
        table = np.minimum(table[:-step], table[step:])
        step *= 2


def anchors(texts: list[bytes | None], size: int = SIZE):
    """Word hashes, start of each window, its text, and its anchor, over a slice of texts."""
    words, begins = word_hashes(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(begins))
    if len(words) < size:
        none = np.zeros(0, np.int64)
        return words, begins, none, none, np.zeros(0, np.uint64)
    start = np.flatnonzero(text[: len(words) - size + 1] == text[size - 1 :])
    up, down = powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    salt = odd(49, 1)[0]

    def names(low, high):
        return mix((sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64) * salt)

    anchor = names(start, start + size)
    todo = np.ones(len(start), bool)
    for low, high in reversed(rounds(words, text)):
        short = high - low <= size
        low, high = low[short], high[short]
        if not len(low):
            continue
        a, b = np.searchsorted(low, start, "left"), np.searchsorted(high, start + size, "right")
        fits = todo & (a < b)
        anchor[fits] = _ranged_least(names(low, high), a[fits], b[fits])
        todo &= ~fits
    return words, begins, start, text[start], anchor


def _facts(docs: DataFrame, size: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts, ids = raw(batch.column("text")), batch.column("doc_id").to_pylist()
            for a, b in slices(texts):
                words, begins, _, owner, anchor = anchors(texts[a:b], size)
                order = np.lexsort((anchor, owner))
                owner, anchor = owner[order], anchor[order]
                new = np.ones(len(owner), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (anchor[1:] != anchor[:-1])
                new &= np.array([i is not None for i in ids[a:b]], bool)[owner]
                owner, anchor = owner[new], anchor[new]
                cuts = np.searchsorted(owner, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a:b], pa.int64()), pa.array(np.diff(begins).astype(np.int64)),
                     pa.array([whole(t)[0] for t in texts[a:b]], pa.string()),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(anchor.astype(np.int64)))],
                    names=["doc_id", "n_words", "sha", "anchors"],
                )

    return docs.mapInArrow(run, "doc_id long, n_words long, sha string, anchors array<long>")


def whole(text: bytes | None, keep: np.ndarray | None = None) -> tuple[str, list[bytes]]:
    """Digest of the kept words joined by one space, and the words."""
    words = (text or b"").split()
    if keep is not None:
        words = [w for w, k in zip(words, keep, strict=True) if k]
    return hashlib.sha256(b" ".join(words)).hexdigest(), words


def _windows(affected: DataFrame, size: int) -> DataFrame:
    """Windows at shared anchors: two hashes, the document and the position."""

    def run(batches):
        for batch in batches:
            texts, ids = raw(batch.column("text")), batch.column("doc_id").to_numpy()
            copy, hits = batch.column("copy").to_numpy(), batch.column("anchors").to_pylist()
            for a, b in slices(texts):
                words, begins, start, owner, anchor = anchors(texts[a:b], size)
                cuts = np.searchsorted(owner, np.arange(b - a + 1))
                chosen = np.concatenate([
                    cuts[i] + np.flatnonzero(np.isin(anchor[cuts[i] : cuts[i + 1]], np.array(hits[a + i], np.int64).astype(np.uint64)))
                    for i in range(b - a)
                ]).astype(np.int64)
                at, who = start[chosen], owner[chosen]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(windows(words, size, 61)[at].astype(np.int64)), pa.array(windows(words, size, 62)[at].astype(np.int64)),
                     pa.array(ids[a + who]), pa.array(copy[a + who]), pa.array((at - begins[who]).astype(np.int32))],
                    names=["h", "g", "doc_id", "copy", "at"],
                )

    return affected.mapInArrow(run, "h long, g long, doc_id long, copy long, at int")


def _cut(rows: DataFrame, size: int, texts: bool) -> DataFrame:
    """Remove the words that the windows at `places` cover."""

    def run(batches):
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "sha", "places"))
            for doc_id, sha, places, text in zip(*columns, raw(batch.column("text")), strict=True):
                words = text.split()
                edge = np.zeros(len(words) + 1, np.int64)
                at = np.unique(np.array(places))
                edge[at] += 1
                edge[at + size] -= 1
                keep = np.cumsum(edge[:-1]) == 0
                digest, kept = whole(text, keep)
                out.append((doc_id, sha, int((~keep).sum()), digest, b" ".join(kept).decode() if texts else None))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()))],
                    names=["doc_id", "sha", "n_cut", "kept", "kept_text"],
                )

    return rows.mapInArrow(run, "doc_id long, sha string, n_cut long, kept string, kept_text string")


def remove_repeats(docs: DataFrame, size: int = SIZE, texts: bool = False) -> DataFrame:
    """Remove every word covered by a window whose words also start in a document with a smaller doc_id.

    Returns doc_id, n_words, n_removed, kept_sha256 for every row (and `kept_text`, null where nothing is removed, if
    `texts`).  Null and empty texts have no words.  Texts with the same words are handled once: all but those of the
    least id lose everything if they have at least one window.  Rows that repeat an id never remove each other's
    words; rows without an id keep theirs and remove nothing from others.
    """
    settle(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parsed = finish(_facts(rows, size), "parsed")
    facts = finish(parsed.drop("anchors"), "facts")
    copy = F.conv(F.substring("sha", 1, 15), 16, 10).cast("long").alias("copy")
    # Anchors in texts with different words; the aggregate is partial first, so a very common anchor is cheap.
    seen = parsed.select(copy, F.explode("anchors").alias("anchor"))
    common = seen.groupBy("anchor").agg(F.min("copy").alias("a"), F.max("copy").alias("b")).where("a < b")
    common = finish(common.select("anchor"), "anchors")
    hits = finish(seen.join(common, "anchor").groupBy("copy").agg(F.collect_set("anchor").alias("anchors")), "hits")
    discard(parsed)
    discard(common)
    firsts = facts.where("doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("first"))
    firsts = finish(firsts, "firsts")
    hits = hits.join(firsts.select(copy, "sha", "first"), "copy").drop("copy")
    # Texts that share an anchor move once and are kept beside their anchors.
    affected = rows.join(hits.select(F.col("first").alias("doc_id"), "sha", "anchors"), "doc_id")
    affected = affected.where(F.col("text").isNotNull()).select("doc_id", "sha", copy, "anchors", "text")
    affected = finish(_own(affected), "affected")
    # Hashed twice rather than stored: the hashes take more room than the texts.
    at = _windows(affected, size)
    origin = at.groupBy("h", "g").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    origin = finish(origin.drop("most"), "origins")
    late = at.join(origin, ["h", "g"]).where("doc_id > least")
    places = finish(late.groupBy("doc_id", "copy").agg(F.collect_list("at").alias("places")), "places")
    discard(origin)
    cut = affected.select("doc_id", "sha", "copy", "text").join(places, ["doc_id", "copy"])
    cut = _cut(cut.select("doc_id", "sha", "places", "text"), size, texts).dropDuplicates(["doc_id", "sha"])
    cut = finish(cut, "cut")
    out = facts.join(firsts, "sha", "left").join(cut, ["doc_id", "sha"], "left")
    is_copy = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= size)
    nothing = F.sha2(F.lit(""), 256)
    columns = [
        "doc_id", "n_words",
        F.when(is_copy, F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(is_copy, nothing).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    ]
    if texts:
        columns.append(F.when(is_copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"))
    return out.select(*columns)


def _own(rows: DataFrame) -> DataFrame:
    """Rows whose text has the words the digest names: an id can repeat with other texts."""

    def run(batches):
        for batch in batches:
            own = [whole(t)[0] == s for t, s in zip(raw(batch.column("text")), batch.column("sha").to_pylist(), strict=True)]
            yield batch.filter(pa.array(own, pa.bool_()))

    return rows.mapInArrow(run, rows.schema)
