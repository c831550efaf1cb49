"""How far each source's words lie from those of the other sources of its language, by row accumulation.

Terms are runs of ASCII letters and characters beyond ASCII, A-Z in lower case; a language keeps the terms that at
least `min_docs` of its documents have, V of them.  A group (lang, source) gives every kept term the integer
p = 1 + floor(10^9 * (count + 1) / (N + V)), with N its occurrences of kept terms; the difference of a group to a peer
in a term is f = floor((p - q)^2 / q), q being the peer's p.  The value of a pair is the sum of f over all kept terms.

Most terms are missing in one or both groups of a pair, where p is the group's own constant z (count 0).  So the sum is
taken apart:

    V f(z, z') + sum over the group's terms (f(p, z') - f(z, z')) + sum over the peer's terms (f(z, p') - f(z, z'))
               + sum over the terms of both (f(p, p') - f(p, z') - f(z, p') + f(z, z'))

The first line needs each group's histogram of counts only (few distinct counts, whatever the vocabulary), so a group
meets each peer once.  The second is a sparse product, done row by row: the term-major index (one row per kept term with
its counts per source) is dealt to shards of bounded size; in a shard each group scatters its terms through the index
into a dense accumulator over its peers, and one partial sum per pair leaves the shard.  No pair of postings is written
or shuffled, and a group with a third of all words spreads over all shards of its language.

All arithmetic is exact: 64-bit integers where values fit, Python integers or decimals where counts may not.
"""

from __future__ import annotations

import string
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import finish, raw, settle
from millrace.plans.skew import small

# The scale of p, the documents a kept term needs, the ranks of the term part.
SCALE = 10**9
MIN_DOCS = 3
TERM_RANKS = 200
SHARD_POSTINGS = 200_000
# Groups whose accumulators one task fills for a shard; more of a language go to further tasks.
GROUP_BLOCK = 512

_LETTERS = {*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if c in _LETTERS else 0x20 for c in range(256))
# A mapper hands its counts on after so many entries or bytes of text.
_FLUSH_ENTRIES, _FLUSH_BYTES, _SLICE = 400_000, 64_000_000, 4_000_000


def term_slices(text: bytes):
    """The terms of a text, in lists of bounded size."""
    at = 0
    while at < len(text):
        end = min(at + _SLICE, len(text))
        while end < len(text) and text[end] in _LETTERS:
            end += 1
        yield text[at:end].translate(_TABLE).split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it), added up; each group also has a row without term."""

    def hand_over(counts: dict):
        for (lang, source), (n, docs) in counts.items():
            terms = list(n)
            for at in range(0, len(terms) or 1, 50_000):
                part = terms[at : at + 50_000]
                marker = [None] if at == 0 else []
                names = pa.array(marker + part, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names), pa.string()), pa.array([source] * len(names), pa.string()), names.cast(pa.string()),
                     pa.array([0] * len(marker) + [n[t] for t in part], pa.int64()),
                     pa.array([0] * len(marker) + [docs[t] for t in part], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"],
                )

    def run(batches):
        counts, size = {}, 0
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for lang, source, text in zip(langs, sources, raw(batch.column("text")), strict=True):
                n, having = counts.setdefault((lang, source), (Counter(), Counter()))
                own = set()
                for terms in term_slices(text or b""):
                    n.update(terms)
                    own.update(terms)
                having.update(own)
                size += len(text or b"")
            if size > _FLUSH_BYTES or sum(len(n) for n, _ in counts.values()) > _FLUSH_ENTRIES:
                yield from hand_over(counts)
                counts, size = {}, 0
        yield from hand_over(counts)

    empty = F.lit("")
    rows = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"), "text")
    parts = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def scaled(n: np.ndarray, total: int, kept: int) -> np.ndarray:
    """p of each count, exact also where 10^9 times a count leaves 64 bits."""
    if len(n) and (int(n.max()) + 1) * SCALE < 2**63:
        return 1 + (n + 1) * SCALE // (total + kept)
    return np.array([1 + (int(c) + 1) * SCALE // (total + kept) for c in n], np.int64)


def difference(p, q):
    """floor((p - q)^2 / q); p and q are at most 10^9 + 1, so the square fits."""
    return (p - q) ** 2 // q


def histogram_sums(p: np.ndarray, times: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each peer constant z: the sum of times * f(p, z) and of times * f(z, p)."""
    ahead, back = np.zeros(len(z), np.int64), np.zeros(len(z), np.int64)
    step = max(1, 1_000_000 // max(1, len(p)))
    for at in range(0, len(z), step):
        peer = z[at : at + step, None]
        ahead[at : at + step] = (difference(p[None], peer) * times).sum(1)
        back[at : at + step] = (difference(peer, p[None]) * times).sum(1)
    return ahead, back


def by_group(group: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries in the order of their group, and where each group begins."""
    order = np.argsort(group, kind="stable")
    return order, np.searchsorted(group[order], np.arange(count + 1))


def accumulate(offsets: np.ndarray, group: np.ndarray, p: np.ndarray, z: np.ndarray, wanted: np.ndarray):
    """The sum over the terms of both, for every pair of a wanted group and a peer where it is not 0: group, peer, sum.

    Term t has the entries offsets[t] to offsets[t + 1] of `group` and `p`; `z` is each group's constant.  One dense
    accumulator over the peers serves all groups in turn.
    """
    sizes = np.diff(offsets)
    term = np.repeat(np.arange(len(sizes)), sizes)
    order, begins = by_group(group, len(z))
    row, out = np.zeros(len(z), np.int64), []
    for g in wanted:
        own = order[begins[g] : begins[g + 1]]
        if not len(own):
            continue
        row[:] = 0
        widths = sizes[term[own]]
        cuts = np.searchsorted(np.cumsum(widths), np.arange(0, widths.sum(), 1_000_000))
        for a, b in zip(cuts, [*cuts[1:], len(own)], strict=True):
            rows, width = own[a:b], widths[a:b]
            begin = np.repeat(offsets[term[rows]] - np.concatenate(([0], np.cumsum(width)[:-1])), width)
            entry = begin + np.arange(width.sum())
            h, mine, theirs = group[entry], np.repeat(p[rows], width), p[entry]
            gain = difference(mine, theirs) - difference(mine, z[h]) - difference(z[g], theirs) + difference(z[g], z[h])
            np.add.at(row, h, gain)
        row[g] = 0
        peers = np.flatnonzero(row)
        out.append((np.full(len(peers), g), peers, row[peers]))
    return tuple(np.concatenate([part[i] for part in out] or [np.zeros(0, np.int64)]) for i in range(3))


def term_index(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The term-major index: a row per kept term with its total and its counts per source of the language."""
    rows = counts.where("term is not null").groupBy("lang", "term")
    entries = F.collect_list(F.struct("source", "n"))  # one entry per source that has the term
    return rows.agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), entries.alias("entries")).where(F.col("docs") >= min_docs)


def group_totals(counts: DataFrame, index: DataFrame) -> DataFrame:
    """lang, source, size (N), and of the language kept (V), lang_n and the number of shards; groups without terms included."""
    entries = index.select("lang", F.explode("entries").alias("e")).select("lang", "e.source", "e.n")
    sums = entries.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    langs = index.groupBy("lang").agg(
        F.count("*").alias("kept"), F.sum("total").alias("lang_n"),
        F.ceil(F.sum(F.size("entries")) / SHARD_POSTINGS).cast("int").alias("shards"),
    )
    rows = counts.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    return rows.na.fill(0, ["size", "kept", "lang_n", "shards"])


def _p(count: str, total: str) -> Column:
    """p on the JVM, in decimals, as 10^9 times a count may leave 64 bits."""
    return F.expr(f"1 + ({SCALE}BD * cast({count} + 1 as decimal(19, 0))) div cast({total} + kept as decimal(19, 0))")


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def baseline_sums(index: DataFrame, groups: DataFrame) -> DataFrame:
    """The first line of the sum: lang, source, item, value, two rows per pair of groups."""
    entries = index.select("lang", F.explode("entries").alias("e")).select("lang", "e.source", "e.n")
    histogram = entries.groupBy("lang", "source", "n").agg(F.count("*").alias("times"))
    peers = groups.select("lang", F.col("source").alias("peer"), F.col("size").alias("peer_n"))
    # A row per pair of groups of a language, as many as the result has.
    pairs = groups.select("lang", "source", "size", "kept").join(peers, "lang").where("source != peer")

    def run(key, own: pa.Table, others: pa.Table) -> pa.Table:
        lang, source = (k.as_py() for k in key)
        peer = others.column("peer").to_pylist()
        value = np.zeros(2 * len(peer), np.int64)
        if len(peer) and (kept := int(_numbers(others, "kept")[0])):
            z = scaled(np.zeros(1, np.int64), int(_numbers(others, "size")[0]), kept)[0]
            totals = _numbers(others, "peer_n")
            far = np.array([scaled(np.zeros(1, np.int64), int(t), kept)[0] for t in totals])
            times = _numbers(own, "times")
            ahead, back = histogram_sums(scaled(_numbers(own, "n"), int(_numbers(others, "size")[0]), kept), times, far)
            terms = int(times.sum())
            value[: len(peer)] = ahead + (kept - terms) * difference(z, far)
            value[len(peer) :] = back - terms * difference(far, z)
        names = pa.array([lang] * len(value), pa.string())
        mine = [source] * len(peer)
        return pa.table({"lang": names, "source": pa.array(mine + peer, pa.string()), "item": pa.array(peer + mine, pa.string()), "value": pa.array(value)})

    both = histogram.groupBy("lang", "source").cogroup(pairs.groupBy("lang", "source"))
    return both.applyInArrow(run, "lang string, source string, item string, value long")


def shared_sums(index: DataFrame, groups: DataFrame) -> DataFrame:
    """The second line of the sum, shard by shard of the term-major index: lang, source, item, value.

    A language of very many sources deals them to blocks, and a task takes one block of groups through one shard, so what
    it holds stays in proportion to the shard, a block and one row over the peers.
    """
    langs = groups.groupBy("lang", "shards").agg(F.ceil(F.count("*") / GROUP_BLOCK).cast("int").alias("blocks"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = index.join(small(langs), "lang").select(
        "lang", F.pmod(F.xxhash64("term"), "shards").cast("int").alias("shard"), each("blocks").alias("block"),
        F.col("entries.source").alias("sources"), F.col("entries.n").alias("counts"),
    )
    own_block = F.pmod(F.xxhash64("source"), "blocks").cast("int")
    all_groups = groups.where("shards > 0").join(small(langs.select("lang", "blocks")), "lang")
    all_groups = all_groups.select("lang", each("shards").alias("shard"), "source", "size", "kept", "blocks", own_block.alias("own"))
    all_groups = all_groups.select("*", each("blocks").alias("block")).drop("blocks")

    def run(key, terms: pa.Table, peers: pa.Table) -> pa.Table:
        names = peers.column("source").combine_chunks()
        totals, kept = _numbers(peers, "size"), int(_numbers(peers, "kept")[0]) if len(peers) else 0
        wanted = np.flatnonzero(_numbers(peers, "own") == key[2].as_py())
        sources, counts = terms.column("sources").combine_chunks(), terms.column("counts").combine_chunks()
        offsets = np.concatenate(([0], np.cumsum(pc.list_value_length(sources).to_numpy(zero_copy_only=False)))).astype(np.int64)
        group = pc.index_in(pc.list_flatten(sources), value_set=names).to_numpy(zero_copy_only=False).astype(np.int64)
        n = pc.list_flatten(counts).to_numpy(zero_copy_only=False).astype(np.int64)
        p, z = np.zeros(len(n), np.int64), np.zeros(len(names), np.int64)
        order, begins = by_group(group, len(names))
        for g, total in enumerate(totals):
            own = order[begins[g] : begins[g + 1]]
            p[own] = scaled(n[own], int(total), kept)
            z[g] = scaled(np.zeros(1, np.int64), int(total), kept)[0]
        a, b, value = accumulate(offsets, group, p, z, wanted)
        return pa.table({
            "lang": pa.array([key[0].as_py()] * len(a), pa.string()), "source": names.take(pa.array(a)),
            "item": names.take(pa.array(b)), "value": pa.array(value),
        })

    both = rows.groupBy("lang", "shard", "block").cogroup(all_groups.groupBy("lang", "shard", "block"))
    return both.applyInArrow(run, "lang string, source string, item string, value long")


def _ranked(rows: DataFrame) -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc()))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, term_ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part, item, value, rank of every group of `docs` (lang, source, text).

    Part `pair` ranks all other sources of the language by their value, part `term` the terms that the group uses more
    than its language does, up to `term_ranks`.  Nulls count as empty strings.  A group without kept terms has pairs but
    no terms; without kept terms in the language values are 0; a language of one source has no pairs.  Repeated rows are
    documents of their own, other columns are left alone, an empty table gives no rows.
    """
    settle(docs.sparkSession)
    counts = finish(term_counts(docs), "counts")
    index = finish(term_index(counts, min_docs), "index")
    groups = finish(group_totals(counts, index), "groups")

    sums = baseline_sums(index, groups).unionByName(shared_sums(index, groups))
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", _ranked(pairs)).withColumn("part", F.lit("pair"))

    entries = index.select("lang", "term", "total", F.explode("entries").alias("e")).select("lang", "term", "total", "e.source", "e.n")
    rows = entries.join(small(groups), ["lang", "source"])
    rows = rows.withColumns({"p": _p("n", "size"), "q": _p("total", "lang_n")})
    over = F.col("p") - F.col("q")
    rows = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    terms = rows.withColumn("rank", _ranked(rows)).where(F.col("rank") <= term_ranks).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(terms.select(*columns))


ORACLE = rf"""with d as (select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') as t from documents),
w as (select row, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term from w group by all having count(distinct row) >= {MIN_DOCS}),
c as (select lang, source, term, count(*) as n from w join kept using (lang, term) group by all),
v as (select lang, count(*) as V from kept group by lang),
g as (select lang, source, coalesce(sum(n), 0)::hugeint as total, coalesce(any_value(V), 0)::hugeint as V
    from (select distinct lang, source from d) left join c using (lang, source) left join v using (lang) group by all),
l as (select lang, sum(total)::hugeint as total, any_value(V) as V from g group by lang),
p as (select g.lang, g.source, k.term, coalesce(n, 0) as n,
    1 + ({SCALE}::hugeint * (coalesce(n, 0) + 1)) // (g.total + g.V) as p
    from g join kept k on g.lang = k.lang left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
q as (select lang, term, 1 + ({SCALE}::hugeint * (sum(n) + 1)) // any_value(l.total + l.V) as q from c join l using (lang) group by lang, term),
pair as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
    from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
    from g a join g b on a.lang = b.lang and a.source <> b.source
    left join pair on pair.lang = a.lang and pair.source = a.source and pair.item = b.source),
terms as (select p.lang, p.source, 'term' as part, p.term as item, ((p - q) * (p - q)) // q as value
    from p join q on p.lang = q.lang and p.term = q.term where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
    from (select * from pairs union all select * from terms))
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from ranked
where part = 'pair' or rank <= {TERM_RANKS}"""
