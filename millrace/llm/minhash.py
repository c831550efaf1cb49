"""Near-duplicate classes by b-bit MinHash.

1. Texts with the same words are one class; its least doc_id stands for it.
2. Each class gets `hashes` minima over its word shingles.  `bands` groups of minima name candidate buckets; of every
   minimum only `BITS` bits are kept, packed into longs.
3. Within a bucket the kept bits are compared by bit counts.  Two minima agree by chance once in 2**BITS, so a share s
   of agreeing values estimates the similarity (s - 2**-BITS) / (1 - 2**-BITS).  Pairs whose estimate is more than
   4.5 standard errors below the threshold are passed over.
4. The pairs that are left are confirmed on the full shingle sets, and links are joined to components.

First each class is confirmed against the one bucket leader that looks most like it, which joins most copies of a text.
Then, in buckets that still hold several components, the classes outside the largest one are compared with the bucket in
blocks of bounded size.  A block gives a spanning forest of the pairs with a sufficient estimate, at most a row per
class; the forests join classes to clusters, and every such pair lies inside one cluster.  Last, clusters are walked in
blocks again, now with the full sets: a pair is confirmed unless the links found so far already connect it, and only
links that connect something new are written.

Blocks are dealt only while one block holds the classes outside the largest component, which is at most twice the rows
of a group.  Buckets and clusters with more such classes would need blocks against blocks, so their classes are dealt
to lists by their rarest shingles instead (`prefix_lists`), in which every pair at the threshold meets, and classes
that only share a common passage do not.  Only a list that is itself that large, of classes whose rarest shingles are
the same and which still are no copies of each other, is dealt in blocks against blocks.  So no link between different
components is lost, and links inside one are not needed.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import finish, raw, settle
from millrace.llm.components import components
from millrace.llm.wordhash import mix, odd, slices, windows, word_hashes

SHINGLE = 5
HASHES, BANDS = 192, 32
BITS = 4
PER_LONG = 64 // BITS
# Nodes, and bytes of full sets, of a slice of a group: two slices are in one task's memory.
SKETCH_BLOCK, SET_BLOCK, BLOCK_BYTES = 2048, 1024, 16_000_000


def shingle_hashes(texts: list[bytes | None], size: int = SHINGLE):
    """Shingle hashes of all texts in a row, where each text's begin, and the digest of each text's words."""
    words, begins = word_hashes(texts, lower=True)
    runs = windows(words, size, seed=31)
    parts, digests = [], []
    for a, b in zip(begins, begins[1:]):
        if b - a >= size:
            parts.append(runs[a : b - size + 1])
        elif b > a:
            short = windows(words[a:b], b - a, seed=32)
            parts.append(mix(short + np.uint64(b - a)))
        else:
            parts.append(np.zeros(0, np.uint64))
        digests.append(hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest())
    starts = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), starts, digests


def signatures(texts: list[bytes | None], size: int = SHINGLE, hashes: int = HASHES, bands: int = BANDS):
    """Distinct shingles, word digest, packed low bits and band names of each text."""
    runs, starts, digests = shingle_hashes(texts, size)
    counts = np.array([len(np.unique(runs[a:b])) for a, b in zip(starts, starts[1:])], np.int64)
    full = np.flatnonzero(counts)
    packed = np.zeros((len(texts), hashes // PER_LONG), np.uint64)
    named = np.zeros((len(texts), bands), np.uint64)
    if len(full):
        at, per_band = starts[:-1][full], hashes // bands
        weights = odd(33, per_band)
        salts = odd(34, bands)
        for k, (times, shift) in enumerate(zip(odd(35, hashes), odd(36, hashes))):
            least = mix(np.minimum.reduceat((runs ^ shift) * times, at))
            packed[full, k // PER_LONG] |= (least & np.uint64(2**BITS - 1)) << np.uint64(BITS * (k % PER_LONG))
            named[full, k // per_band] += least * weights[k % per_band]
        named[full] = mix(named[full] + salts)
    return counts, digests, packed, named


def _agreeing(a: Column, b: Column, hashes: int) -> Column:
    """How many of the packed values are equal."""
    ones = F.lit(sum(1 << (BITS * i) for i in range(PER_LONG)))
    total = F.lit(hashes)
    for i in range(hashes // PER_LONG):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        spread = x
        for j in range(1, BITS):
            spread = spread.bitwiseOR(F.shiftrightunsigned(x, j))
        total = total - F.bit_count(spread.bitwiseAND(ones))
    return total


def similarity(a: Column, b: Column, hashes: int = HASHES) -> Column:
    """Estimated Jaccard similarity from packed bits, with chance agreement taken out."""
    chance = 2.0**-BITS
    return (_agreeing(a, b, hashes) / F.lit(float(hashes)) - chance) / (1 - chance)


def estimate_floor(threshold: float, hashes: int = HASHES) -> float:
    chance = 2.0**-BITS
    agree = chance + (1 - chance) * threshold
    return threshold - 4.5 * (agree * (1 - agree) / hashes) ** 0.5 / (1 - chance)


def _sign(docs: DataFrame, size: int, hashes: int, bands: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts = raw(batch.column("text"))
            for a, b in slices(texts):
                counts, digests, packed, named = signatures(texts[a:b], size, hashes, bands)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(counts), pa.array(digests, pa.binary()),
                     _lists(packed), _lists(named)],
                    names=["doc_id", "n_shingles", "class", "sig", "bands"],
                )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, class binary, sig array<long>, bands array<long>")


def _lists(table: np.ndarray) -> pa.Array:
    offsets = np.arange(0, table.size + 1, table.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(table.astype(np.int64).ravel()))


def _shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """Sorted distinct shingle hashes as bytes, for rows of doc_id, text and class; rows of another class go."""

    def run(batches):
        for batch in batches:
            texts, ids = raw(batch.column("text")), batch.column("doc_id").to_pylist()
            wanted = batch.column("class").to_pylist()
            for a, b in slices(texts):
                runs, starts, digests = shingle_hashes(texts[a:b], size)
                own = [i for i in range(b - a) if digests[i] == wanted[a + i]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[a + i] for i in own], pa.int64()),
                     pa.array([np.unique(runs[starts[i] : starts[i + 1]]).tobytes() for i in own], pa.binary())],
                    names=["node", "shingles"],
                )

    return docs.mapInArrow(run, "node long, shingles binary")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full sets."""
    rows = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    rows = rows.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                n = (len(x) + len(y)) // 8
                merged = np.sort(np.concatenate((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))))
                both = int(np.count_nonzero(merged[1:] == merged[:-1]))
                keep.append(100 * both >= percent * (n - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _labelled(rows: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """Add the component of `node`; nodes on no link are their own."""
    known = labels.select(F.col("node").alias(node), F.col("label").alias("_label"))
    return rows.join(known, node, "left").withColumn(name, F.coalesce("_label", node)).drop("_label")


def _mixed(rows: DataFrame, block: int, size: Column | None = None) -> DataFrame:
    """Groups of the rows (group, node, label) that hold several labels: their largest label `main`, the slices `qs` of
    the nodes outside it and `ms` of all nodes, each of about `block` nodes and, by the `size` of a node, BLOCK_BYTES."""
    counted = rows.groupBy("group", "label").agg(F.count("*").alias("n"), F.sum(F.lit(0) if size is None else size).cast("long").alias("bytes"))
    mixed = counted.groupBy("group").agg(
        F.count("*").alias("labels"), F.sum("n").alias("n"), F.max("n").alias("most"), F.sum("bytes").alias("bytes"),
        F.max_by("bytes", F.struct("n", -F.col("label"))).alias("most_bytes"),
        F.max_by("label", F.struct("n", -F.col("label"))).alias("main"),
    ).where("labels > 1")
    slices = lambda n, of: F.greatest(F.ceil(n / block), F.ceil(of / BLOCK_BYTES)).cast("int")
    return mixed.select(
        "group", "main", slices(F.col("n") - F.col("most"), F.col("bytes") - F.col("most_bytes")).alias("qs"),
        slices(F.col("n"), F.col("bytes")).alias("ms"),
    )


ASKS, ASKED, BOTH = 0, 1, 2


def _cells(rows: DataFrame, mixed: DataFrame) -> DataFrame:
    """Deal the rows (group, node, label) of `mixed` groups to cells of at most about two slices.

    Nodes outside the group's largest label ask, all its nodes are asked, and each asking slice meets each asked slice
    in one cell.  A group of one cell has a row per node; with one asking slice there are at most twice as many.
    """
    rows = rows.join(mixed, "group")
    several = rows.where("ms > 1")
    one = rows.where("ms = 1").select(
        "group", "node", "label", "main", F.lit(BOTH).alias("role"), F.lit(0).alias("q"), F.lit(0).alias("m")
    )
    asking = several.where("label != main").select(
        "group", "node", "label", "main", F.lit(ASKS).alias("role"), F.pmod(F.xxhash64("node"), "qs").cast("int").alias("q"),
        F.explode(F.sequence(F.lit(0), F.col("ms") - 1)).alias("m"),
    )
    asked = several.select(
        "group", "node", "label", "main", F.lit(ASKED).alias("role"), F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("q"),
        F.pmod(F.xxhash64("node", F.lit(1)), "ms").cast("int").alias("m"),
    )
    return one.unionByName(asking).unionByName(asked)


def _crowd(rows: DataFrame, mixed: DataFrame) -> DataFrame:
    """Nodes of groups whose asking side needs several slices, where slices against slices would be quadratic."""
    return rows.join(mixed.where("qs > 1").select("group"), "group").select("node")


def prefix_lists(sets: DataFrame, percent: int) -> DataFrame:
    """Rows (group, node, size): the nodes (and bytes of their sets) that have a shingle among their rarest ones, for shingles that several nodes have.

    Two sets of a and b shingles with 100 * intersection >= percent * union share at least ceil(percent * a / 100) of
    a's.  So in one order of all shingles, here from rare to frequent, the first one they share is among the first
    a - ceil(percent * a / 100) + 1 of a, and likewise for b: every link meets in a list.  A passage that all nodes have
    comes last in the order and heads no list unless it is most of its texts.
    """

    def spread(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                own = np.frombuffer(batch.column("shingles")[at].as_py(), np.int64)
                node = np.full(len(own), batch.column("node")[at].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(own)], names=["node", "shingle"])

    tokens = sets.mapInArrow(spread, "node long, shingle long")
    often = tokens.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1")
    sizes = sets.select("node", F.expr("octet_length(shingles) div 8").cast("int").alias("size"))
    sizes = sizes.withColumn("first", F.expr(f"size - cast(({percent}L * size + 99) div 100 as int) + 1"))
    # A node's own shingles only; those that no other node has come first in the order.
    shared = tokens.join(often, "shingle").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("shared"))
    rows = shared.join(sizes, "node")
    left = F.greatest(F.col("first") - (F.col("size") - F.size("shared")), F.lit(0))
    rows = rows.select("node", F.col("size") * 8, F.explode(F.slice("shared", F.lit(1), left)).alias("at"))
    return rows.toDF("node", "size", "at").select(F.col("at.shingle").alias("group"), "node", "size")


def _walk(cells: DataFrame, hashes: int, floor: float, percent: int | None = None) -> DataFrame:
    """A spanning forest (a, b) of each cell over pairs of different labels whose estimate reaches `floor` and, with
    `percent`, whose full sets are a link."""
    names = ["node", "label", "main", "role", "sig"] + (["shingles"] if percent else [])
    dealt = cells.repartition("group", "q", "m").sortWithinPartitions("group", "q", "m", "role", "node")
    ones = sum(1 << (BITS * i) for i in range(PER_LONG))

    def linked(x: bytes, y: bytes) -> bool:
        n = (len(x) + len(y)) // 8
        merged = np.sort(np.concatenate((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))))
        both = int(np.count_nonzero(merged[1:] == merged[:-1]))
        return 100 * both >= percent * (n - both)

    def forest(cell: dict) -> list[tuple[int, int]]:
        node, label, role = (np.array(cell[c], np.int64) for c in ("node", "label", "role"))
        sig, main = np.array(cell["sig"], np.int64).view(np.uint64), cell["main"][0]
        asked = np.flatnonzero(role != ASKS)
        group = label.copy()  # label of the component as far as this cell has joined it
        out = []
        for q in np.flatnonzero((role == ASKS) | (role == BOTH) & (label != main)):
            at = asked[(group[asked] != group[q]) & ((label[asked] == main) | (node[q] < node[asked]))]
            x = sig[at] ^ sig[q]
            spread = x
            for j in range(1, BITS):
                spread = spread | (x >> np.uint64(j))
            equal = hashes - np.bitwise_count(spread & np.uint64(ones)).sum(1, dtype=np.int64)
            like = (equal / hashes - 2.0**-BITS) / (1 - 2.0**-BITS)
            order = np.argsort(-like, kind="stable")
            for m in at[order[: int((like >= floor).sum())]]:
                if group[m] != group[q] and (not percent or linked(cell["shingles"][q], cell["shingles"][m])):
                    out.append((int(node[q]), int(node[m])))
                    group[group == group[m]] = group[q]
        return out

    def run(batches):
        key, cell = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("group", "q", "m"))))
            columns = {n: batch.column(n).to_pylist() for n in names}
            links, start = [], 0
            for i in range(1, len(keys) + 1):
                if i < len(keys) and keys[i] == keys[start]:
                    continue
                if keys[start] != key:
                    links += forest(cell) if cell else []
                    key, cell = keys[start], {n: [] for n in names}
                for n in names:
                    cell[n] += columns[n][start:i]
                start = i
            if links:
                yield _links(links)
        if cell and (links := forest(cell)):
            yield _links(links)

    return dealt.select("group", "q", "m", *names).mapInArrow(run, "a long, b long")


def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def near_duplicates(
    docs: DataFrame, percent: int = 85, size: int = SHINGLE, hashes: int = HASHES, bands: int = BANDS
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs` (doc_id, text).

    Words are runs other than white space, A-Z lowered; a text with fewer than `size` words is one shingle; null and
    empty texts have none and link with nothing (each is its own component).  Rows that repeat an id are one node.
    Rows without an id take no part: their component is null and they are kept.  Repeated rows are kept or dropped alike.
    """
    settle(docs.sparkSession)
    floor = estimate_floor(percent / 100, hashes)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = finish(_sign(texts, size, hashes, bands), "signed")
    classes = signed.where("n_shingles > 0 and doc_id is not null").groupBy("class").agg(
        F.min("doc_id").alias("node"), F.first("sig").alias("sig"), F.first("bands").alias("bands"),
        (F.first("n_shingles") * 8).alias("size"),
    )
    classes = finish(classes, "classes")
    sigs = classes.select("node", "class", "sig")

    # Buckets with at least two classes, and their leaders.
    buckets = classes.select("node", F.explode("bands").alias("bucket"))
    leaders = buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1")
    members = finish(buckets.join(leaders, "bucket"), "members")

    # Full sets of every class that is in such a bucket: texts are read and moved once for this.
    wanted = members.select("node").distinct().join(sigs.select("node", "class"), "node")
    wanted = wanted.select(F.col("node").alias("doc_id"), "class")
    sets = finish(_shingle_sets(texts.join(wanted, "doc_id").select("doc_id", "text", "class"), size), "sets")

    # Each class and the leader that looks most like it.
    stars = members.where("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    stars = stars.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
    stars = stars.join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
    stars = stars.select("a", "b", similarity(F.col("sig_a"), F.col("sig_b"), hashes).alias("like"))
    best = stars.where(F.col("like") >= floor).groupBy("a").agg(F.max_by("b", F.struct("like", -F.col("b"))).alias("b"))
    links = finish(_confirm(best, sets, percent), "links")
    labels = components(links)

    # Buckets that still hold several components, by signature, to clusters.
    held = _labelled(members.select(F.col("bucket").alias("group"), "node"), labels, "node", "label")
    mixed = finish(_mixed(held, SKETCH_BLOCK), "mixed")
    cells = _cells(held, mixed.where("qs = 1"))
    near = finish(_walk(cells.join(sigs.select("node", "sig"), "node"), hashes, floor), "near")
    clusters = components(near.unionByName(links))

    # Clusters that hold several components, by full sets.
    known = _labelled(clusters.select("node", F.col("label").alias("group")).unionByName(
        clusters.select(F.col("label").alias("node"), F.col("label").alias("group")).distinct()
    ), labels, "node", "label").join(classes.select("node", "size"), "node")
    tight = finish(_mixed(known, SET_BLOCK, F.col("size")), "mixed")

    def confirmed(cells: DataFrame) -> DataFrame:
        full = cells.join(sigs.select("node", "sig"), "node").join(sets, "node")
        return finish(_walk(full, hashes, floor, percent), "links")

    found = [confirmed(_cells(known, tight.where("qs = 1")))]

    # Buckets and clusters with many components outside their largest one, by lists of rare shingles.
    crowd = finish(_crowd(held, mixed).unionByName(_crowd(known, tight)).distinct(), "crowd")
    if crowd.limit(1).count():
        lists = finish(_labelled(prefix_lists(sets.join(crowd, "node", "left_semi"), percent), labels, "node", "label"), "lists")
        found.append(confirmed(_cells(lists, _mixed(lists, SET_BLOCK, F.col("size")))))
    more = reduce(DataFrame.unionByName, found)
    if more.limit(1).count():
        labels = components(links.unionByName(more))

    named = _labelled(classes.select("node", "class"), labels, "node", "component_id").select("class", "component_id")
    rows = signed.select("doc_id", "n_shingles", "class").join(named, "class", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return rows.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
