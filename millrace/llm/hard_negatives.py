"""Hard negatives for contrastive training, found with an inverted multi-index.

Vectors are cut into two halves.  Each half has a codebook, fitted on a bounded sample; a row lies in the cell of its
two nearest code vectors.  For an anchor a, no row x of cell (i, j) has a score above

    (a1 . c1[i] + |a1| r1[i]) + (a2 . c2[j] + |a2| r2[j])

where r is the largest distance of a row's half from its code vector.  A heap walks the cells of an anchor in falling
order of this sum (rows i and columns j sorted by their half bounds), and stops when what is left cannot change the
answer: every window has its rows, with scores above the next bound, or the next bound is below the window.  So the
answer is exact, whatever the codebooks.

The work is a grid.  Rows are dealt by hash to shards of bounded size, anchors to slices, and a task takes one slice
through the index of one shard, so copies of one vector and hot labels spread over all shards, and neither side is
broadcast or collected.  It runs twice: once for the positives of each anchor (the best rows of its label), and, with
their scores known, once for the negatives in the window that each positive opens.  Both give a few rows per anchor and
shard, which Spark ranks.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import finish, settle

# Larger components could leave 64 bits in a score of up to 512 dimensions; rows with one take no part.
LIMIT = 2**27


@dataclass(frozen=True)
class Settings:
    """`sample` bounds the rows that the codebooks are fitted on, `codes` the code vectors of a half."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    sample: int = 16_384
    codes: int = 16
    rounds: int = 8
    shard_rows: int = 32_768
    slice_anchors: int = 8_192
    run_rows: int = 512


def codebook(half: np.ndarray, codes: int, rounds: int) -> np.ndarray:
    """Code vectors of one half by Lloyd's rounds, starting from evenly spaced sample rows."""
    distinct = np.unique(half, axis=0)
    if not len(distinct):
        return np.zeros((1, half.shape[1]))
    centres = distinct[np.linspace(0, len(distinct) - 1, min(codes, len(distinct))).astype(int)].astype(float)
    for _ in range(rounds):
        nearest = assign(half, centres)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, half)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def assign(half: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1) - 2 * (half @ centres.T), axis=1)


class MultiIndex:
    """The rows of one shard by cells of two half-space codebooks."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, books: tuple[np.ndarray, np.ndarray]):
        cut = books[0].shape[1]
        floats = vectors.astype(float)
        halves = floats[:, :cut], floats[:, cut:]
        codes = [assign(half, book) for half, book in zip(halves, books, strict=True)]
        self.cut, self.books, self.radii = cut, books, []
        for half, book, code in zip(halves, books, codes, strict=True):
            radius = np.full(len(book), -np.inf)  # a code without rows bounds nothing
            np.maximum.at(radius, code, np.sqrt(((half - book[code]) ** 2).sum(1)))
            self.radii.append(radius)
        cell = codes[0] * len(books[1]) + codes[1]
        order = np.lexsort((ids, cell))
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.floats = floats[order]
        self.starts = np.searchsorted(cell[order], np.arange(len(books[0]) * len(books[1]) + 1))
        # Sums of products below 2**53 are exact in doubles.
        most = int(np.abs(vectors).max(initial=0))
        self.exact = most and 2**52 // (most * max(1, vectors.shape[1]))

    def scores(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if np.abs(anchor).max(initial=0) <= self.exact:
            return (self.floats[rows] @ anchor.astype(float)).astype(np.int64)
        return self.vectors[rows] @ anchor

    def walk(self, anchor: np.ndarray, run_rows: int):
        """Rows in runs of cells, with a bound on the score of every row that is still to come."""
        floats = anchor.astype(float)
        halves = floats[: self.cut], floats[self.cut :]
        bounds, orders = [], []
        for half, book, radius in zip(halves, self.books, self.radii, strict=True):
            size = math.sqrt(half @ half)
            full = np.isfinite(radius)
            bound = np.where(full, book @ half + size * np.where(full, radius, 0), -np.inf)
            orders.append(np.argsort(-bound, kind="stable")[: full.sum()])
            bounds.append(bound[orders[-1]])
        first, second = (b.tolist() for b in bounds)
        rows, columns, width = orders[0].tolist(), orders[1].tolist(), len(self.books[1])
        # Scores are whole numbers: half a unit more than covers what doubles round away below 2**50.
        slack = 0.5 + 1e-12 * (abs(first[0]) + abs(second[0])) if first else 0
        heap = [(-(first[0] + second[0]), 0, 0)] if first else []
        run, size = [], 0
        while heap:
            _, i, j = heapq.heappop(heap)
            # A cell enters once: from the left in the first row, else from above.
            if i + 1 < len(rows):
                heapq.heappush(heap, (-(first[i + 1] + second[j]), i + 1, j))
            if i == 0 and j + 1 < len(columns):
                heapq.heappush(heap, (-(first[0] + second[j + 1]), 0, j + 1))
            cell = rows[i] * width + columns[j]
            a, b = self.starts[cell], self.starts[cell + 1]
            if b > a:
                run.append((a, b))
                size += b - a
            if run and (size >= run_rows or not heap):
                at = np.concatenate([np.arange(a, b) for a, b in run])
                yield at, -heap[0][0] + slack if heap else -np.inf
                run, size = [], 0


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the `n` highest scores, ties by smaller id."""
    if len(scores) > 4 * n:
        bar = np.partition(scores, len(scores) - n)[len(scores) - n]
        keep = np.flatnonzero(scores >= bar)
        return keep[np.lexsort((ids[keep], -scores[keep]))[:n]]
    return np.lexsort((ids, -scores))[:n]


def nearest_positives(index: MultiIndex, anchor_id: int, label: int, anchor: np.ndarray, n: int, run_rows: int):
    """The best `n` rows of the anchor's label in a shard, but rows of its own id."""
    scores, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for rows, bound in index.walk(anchor, run_rows):
        rows = rows[(index.labels[rows] == label) & (index.ids[rows] != anchor_id)]
        scores = np.concatenate((scores, index.scores(anchor, rows)))
        ids = np.concatenate((ids, index.ids[rows]))
        keep = best(scores, ids, n)
        scores, ids = scores[keep], ids[keep]
        if len(scores) == n and scores[-1] > bound:
            break
    return ids, scores


def window_negatives(index: MultiIndex, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], n: int, run_rows: int):
    """For each window of scores (both ends in it) the best `n` rows of other labels in a shard."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
    open_ = {w for w, (lo, hi) in enumerate(windows) if lo <= hi}
    for rows, bound in index.walk(anchor, run_rows) if open_ else ():
        rows = rows[index.labels[rows] != label]
        scores, ids = index.scores(anchor, rows), index.ids[rows]
        for w in list(open_):
            lo, hi = windows[w]
            fits = (scores >= lo) & (scores <= hi)
            if fits.any():
                all_ids, all_scores = np.concatenate((found[w][0], ids[fits])), np.concatenate((found[w][1], scores[fits]))
                keep = best(all_scores, all_ids, n)
                found[w] = all_ids[keep], all_scores[keep]
            if bound < lo or (len(found[w][1]) == n and found[w][1][-1] > bound):
                open_.discard(w)
        if not open_:
            break
    return found


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label and whole components of the rows that take part."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * 256) < LIMIT))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    return rows.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), whole.alias("vector"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones ended with zeros."""
    lists = column.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def _ranks(columns: list[str], score: str, id_: str) -> Column:
    return F.row_number().over(Window.partitionBy(*columns).orderBy(F.col(score).desc(), F.col(id_).asc()))


def hard_negatives(rows: DataFrame, anchors: Column | None = None, settings: Settings = Settings()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `rows` have vec_id, label and embedding.  Rows with a null in either, a null or non-finite component or one of
    2**19 or more take no part.  Anchors are the rows that meet `anchors`, by default those whose id is divisible by
    50.  Shorter vectors count as ended with zeros, so an empty one scores 0.  An anchor row that repeats gives its
    result once; other repeated rows are rows of their own, and a row with the anchor's own id is no positive of it.
    Positives without a negative in their window give no row; other columns are left alone.
    """
    spark = settle(rows.sparkSession)
    chosen = F.col("vec_id") % 50 == 0 if anchors is None else anchors
    plain = finish(usable(rows.select("vec_id", "label", "embedding")), "vectors")
    total, width = plain.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    sample = plain.orderBy(F.xxhash64("vec_id"), "vec_id").select("vector").limit(settings.sample).toArrow()
    fitted = _matrix(sample.column("vector"), width).astype(float)
    cut = width // 2
    books = tuple(codebook(half, settings.codes, settings.rounds) for half in (fitted[:, :cut], fitted[:, cut:]))

    asked = plain.where(chosen).dropDuplicates(["vec_id", "label", "vector"])
    asked = finish(asked.select(F.xxhash64("vec_id", "label", "vector").alias("key"), F.col("vec_id").alias("anchor_id"), "label", "vector"), "anchors")
    parallel = spark.sparkContext.defaultParallelism
    shards = max(1, math.ceil(total / settings.shard_rows), min(2 * parallel, total // 512))
    slices = max(1, math.ceil(asked.count() / settings.slice_anchors))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dealt = plain.withColumns({"shard": F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int"), "slice": each(slices)})

    def grid(questions: DataFrame, answer, schema: str) -> DataFrame:
        """`answer` gives the columns of a slice of questions against the index of a shard."""
        sides = questions.withColumns({"slice": F.pmod("key", F.lit(slices)).cast("int"), "shard": each(shards)})

        def run(own: pa.Table, asking: pa.Table) -> pa.Table:
            names, out = [f.split()[0] for f in schema.split(", ")], []
            if own.num_rows and asking.num_rows:
                index = MultiIndex(_ids(own.column("vec_id")), _ids(own.column("label")), _matrix(own.column("vector"), width), books)
                vectors = _matrix(asking.column("vector"), width)
                for row, vector in zip(asking.drop(["vector"]).to_pylist(), vectors, strict=True):
                    out += answer(index, row, vector)
            columns = list(zip(*out)) if out else [()] * len(names)
            return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

        both = dealt.groupBy("shard", "slice").cogroup(sides.groupBy("shard", "slice"))
        return both.applyInArrow(run, schema)

    def positives_of(index, row, vector):
        ids, scores = nearest_positives(index, row["anchor_id"], row["label"], vector, settings.positives, settings.run_rows)
        return [(row["key"], row["anchor_id"], int(i), int(s)) for i, s in zip(ids, scores, strict=True)]

    good = grid(asked, positives_of, "key long, anchor_id long, positive_id long, positive_score long")
    good = good.withColumn("place", _ranks(["key", "anchor_id"], "positive_score", "positive_id")).where(F.col("place") <= settings.positives)
    good = finish(good, "positives")
    # An anchor's positives are a handful by now.
    per = good.groupBy("key", "anchor_id").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))
    questions = asked.join(per, ["key", "anchor_id"])

    def negatives_of(index, row, vector):
        # 100 * score is at least low * positive and at most high * positive.
        windows = [(-(-settings.low * p["positive_score"] // 100), settings.high * p["positive_score"] // 100) for p in row["positives"]]
        found = window_negatives(index, row["label"], vector, windows, settings.negatives, settings.run_rows)
        return [
            (row["key"], row["anchor_id"], p["positive_id"], p["positive_score"], p["place"], int(i), int(s))
            for p, (ids, scores) in zip(row["positives"], found, strict=True) for i, s in zip(ids, scores, strict=True)
        ]

    schema = "key long, anchor_id long, positive_id long, positive_score long, place long, negative_id long, negative_score long"
    bad = grid(questions, negatives_of, schema)
    bad = bad.withColumn("rank", _ranks(["key", "anchor_id", "place"], "negative_score", "negative_id")).where(F.col("rank") <= settings.negatives)
    return bad.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = f"""with r as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_inner_product(a.v, b.v) as bigint) as score
    from r a, r b where a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {Settings.positives}),
n as (select p.*, s.vec_id as negative_id, s.score as negative_score, row_number() over
    (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as rank from p join s on p.anchor_id = s.anchor_id
    where not same and {Settings.low} * positive_score <= 100 * s.score and 100 * s.score <= {Settings.high} * positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n
where rank <= {Settings.negatives}"""
