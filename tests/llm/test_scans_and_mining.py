"""Secret scans, source divergence and hard negatives against brute force, with odd rows."""

import math
import random

import brute
import numpy as np
import oracle
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry_point
from millrace.llm import divergence, secrets
from millrace.llm.common import finish
from millrace.llm.hard_negatives import MultiIndex, Settings, codebook, hard_negatives, nearest_positives
from millrace.llm.secrets import BASE, RULES, Rule, ScanLedger, document_secrets, scan_versions


@pytest.mark.parametrize("name", ["op11_secret_scan", "op12_source_divergence", "op13_hard_negatives"])
def test_queries_match_sql(spark, name):
    problem = oracle.compare(entry_point.queries()[name](spark, SF_SMALL), oracle.connect(SF_SMALL), entry_point.oracle_sql()[name])
    assert problem is None, problem


# ---- secrets ---------------------------------------------------------------------------------------

KEY = "0123456789abcdef"
TEXTS = [
    None, "", " ", "nothing here", f"x password={KEY}99 y", f"PassWd : '{KEY}' and SECRET\"=\"aB+/_.=-aB+/_.=-\"", "token=short",
    # A match that is too short still takes its text away from later ones.
    "token=secret:abcdefghijklmnop", "token=secret token=abcdefghijkl", f"paſſword={KEY} toKen={KEY}",
    "AKIA" + "A" * 13, "AKIA" + "A" * 14, "xxAKIAAKIA" + "Z9" * 10, "akia" + "a" * 30, "a" * 15, "a" * 16, "A" * 16,
    f"日本語 naïve {KEY} Über api_key= {KEY} APIKEY:{KEY}", f"\U0001f600\x01{KEY}\x00{KEY}G{KEY}", "deadbeef" * 400,
    "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1B2" * 9, f"eyJ{KEY}.eyJ{KEY}.{KEY}",
    "word " * 60_000 + f"secret='{KEY}'", f"api_key\n={KEY}", f"token  =  {KEY}==", "ﬁ" * 50 + KEY,
]


def secret_docs(spark, texts):
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, blob string, rules string, _first int").repartition(3)


def test_secrets_match_brute_force(spark):
    texts = TEXTS + [TEXTS[4]] * 30
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in document_secrets(secret_docs(spark, texts)).collect()}
    assert got == {i: brute.secrets(t) for i, t in enumerate(texts)}


def test_added_spans_leave_the_base(spark):
    spans = {r.doc_id: r.spans for r in document_secrets(secret_docs(spark, TEXTS)).collect()}
    kinds = {i: [s.split(":")[0] for s in spans[i].split(",") if s] for i in spans}
    assert kinds[20] == ["private_key"] and kinds[21] == ["code_host"] and kinds[22] == ["web_token", "hex", "hex", "hex"]
    assert spans[0] == spans[1] == spans[3] == ""


def test_null_and_repeated_ids(spark):
    rows = [(None, f"token={KEY}"), (None, None), (5, f"token={KEY}"), (5, f"token={KEY}"), (5, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_assign) for r in document_secrets(docs).collect())
    assert got == [("5", 0), ("5", 1), ("5", 1), ("None", 0), ("None", 1)]
    assert document_secrets(docs.limit(0)).collect() == []


def test_ledger_scans_only_what_it_has_not_seen(spark, tmp_path):
    ledger = ScanLedger(spark, str(tmp_path / "ledger"))
    version = lambda *rows: spark.createDataFrame(rows, "path string, version int, text string")
    scanned = lambda: sorted((len(r.rules), r.rules[0]) for r in ledger.read().collect())
    first = version(("a", 1, f"token={KEY}"), ("a", 2, "clean"), ("b", 1, f"token={KEY}"))
    rows = scan_versions(first, ["path", "version"], ledger, BASE).collect()
    assert sorted((r.path, r.version, [s.kind for s in r.spans]) for r in rows) == [
        ("a", 1, ["assign", "hex"]), ("a", 2, []), ("b", 1, ["assign", "hex"])]
    assert len(scanned()) == 2

    # A text under a new path is not read again, a new one is.
    more = version(("c", 1, f"token={KEY}"), ("c", 2, "AKIA" + "Q" * 20))
    rows = scan_versions(more, ["path", "version"], ledger, BASE).collect()
    assert sorted((r.version, [s.kind for s in r.spans]) for r in rows) == [(1, ["assign", "hex"]), (2, ["access"])]
    assert len(scanned()) == 3

    # A new version of one rule scans every text again with that rule alone, and its old findings no longer count.
    newer = (BASE[0], BASE[1], Rule("hex", 2, "[0-9a-f]{32,}", 32))
    rows = scan_versions(first.unionByName(more), ["path", "version"], ledger, newer).collect()
    assert {s.kind for r in rows for s in r.spans} == {"assign", "access"}
    assert scanned().count((1, "hex@2")) == 3 and len(scanned()) == 6
    # The older rules still find what they found, without a scan.
    rows = scan_versions(first, ["path", "version"], ledger, BASE).collect()
    assert sum(len(r.spans) for r in rows) == 4 and len(scanned()) == 6


def test_repeated_scans_count_once(spark, tmp_path):
    ledger = ScanLedger(spark, str(tmp_path / "ledger"))
    docs = secret_docs(spark, TEXTS)
    want = sorted(map(str, scan_versions(docs, ["doc_id"], ledger).collect()))
    ledger.append(ledger.read())
    assert sorted(map(str, scan_versions(docs, ["doc_id"], ledger).collect())) == want


def test_rules_agree_with_their_shortcuts():
    """Hints and probes pass over no text that the pattern matches."""
    for rule in RULES:
        for text in filter(None, TEXTS):
            if rule.spans(text):
                assert not rule.hints or any(h in text.encode().lower() for h in rule.hints)
                assert not rule.probe or secrets.re.search(rule.probe, text.encode())


# ---- source divergence -----------------------------------------------------------------------------


def divergent_docs(seed=1):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "Über", "naïve", "日本", "x", "y2z", "don't", "É", "é", "ZZ"] + [f"w{chr(97 + i)}{chr(97 + i % 7)}" for i in range(30)]
    docs = []
    for lang in ("en", "de", None, "", "fr"):
        for source in ("s1", "s2", None, "s3"):
            for _ in range(rng.randrange(1, 9)):
                text = " ".join(rng.choice(words[: rng.randrange(3, len(words))]) for _ in range(rng.randrange(0, 60)))
                docs.append((lang, source, text))
    docs += [("en", "only null", None), ("en", "digits", "12 34 !!"), ("one", "rare", "never kept"), ("two", "a", "q"), ("two", "b", "r"),
             ("single", "s", "tie tie"), ("single", "s", "tie"), ("single", "s", "tie"), ("en", "s1", "a" * 5000 + " w"), ("en", "s1", "x" + "\x00" * 9)]
    return docs + docs[:5]


def divergence_frame(spark, docs):
    rows = [(*d, "n", 1, 2, "p") for d in docs]
    return spark.createDataFrame(rows, "lang string, source string, text string, term string, n int, docs int, value string").repartition(3)


@pytest.mark.parametrize("shard, ranks, block", [(divergence.SHARD_POSTINGS, 200, divergence.GROUP_BLOCK), (20, 5, 2)])
def test_divergence_matches_brute_force(spark, monkeypatch, shard, ranks, block):
    monkeypatch.setattr(divergence, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(divergence, "GROUP_BLOCK", block)
    docs = divergent_docs()
    rows = divergence.source_divergence(divergence_frame(spark, docs), term_ranks=ranks).collect()
    assert sorted(tuple(r) for r in rows) == brute.divergence(docs, ranks=ranks)


def test_divergence_of_nothing(spark):
    assert divergence.source_divergence(divergence_frame(spark, divergent_docs()).limit(0)).collect() == []


def test_terms_are_cut_between_slices(monkeypatch):
    monkeypatch.setattr(divergence, "_SLICE", 7)
    text = "Hello wörld, don't 日本語! ABC".encode()
    assert [t.decode() for part in divergence.term_slices(text) for t in part] == ["hello", "wörld", "don", "t", "日本語", "abc"]


def test_counts_beyond_64_bits_stay_exact():
    n, total, kept = 8 * 10**11, 16 * 10**12, 10**6
    assert divergence.scaled(np.array([0, 3, n]), total, kept).tolist() == [
        1 + 10**9 * (c + 1) // (total + kept) for c in (0, 3, n)]


def test_accumulators_of_many_groups():
    """Two thousand groups, a block of them asked for: what comes back is theirs alone, and equals the plain sums."""
    rng = np.random.default_rng(6)
    groups, widths = 2_000, rng.integers(1, 6, 500)
    entries = [rng.choice(groups, w, replace=False) for w in widths]
    offsets, group = np.concatenate(([0], np.cumsum(widths))), np.concatenate(entries)
    z, p = rng.integers(1, 50, groups), rng.integers(50, 5_000, len(group))
    wanted = np.arange(0, groups, 4)
    f = lambda x, y: (int(x) - int(y)) ** 2 // int(y)
    want = {}
    for a, b in zip(offsets, offsets[1:]):
        for i in range(a, b):
            for j in range(a, b):
                g, h = int(group[i]), int(group[j])
                if g != h and g % 4 == 0:
                    want[g, h] = want.get((g, h), 0) + f(p[i], p[j]) - f(p[i], z[h]) - f(z[g], p[j]) + f(z[g], z[h])
    got = divergence.accumulate(offsets, group, p, z, wanted)
    assert dict(zip(zip(got[0].tolist(), got[1].tolist()), got[2].tolist())) == {k: v for k, v in want.items() if v}


def test_no_posting_pairs_leave_a_shard(spark):
    """What the sparse product hands on is a row per pair of groups and shard, however many terms they share."""
    made = []
    for terms in (50, 400):
        text = " ".join("t" + "".join(chr(97 + int(d)) for d in str(i)) for i in range(terms))
        docs = spark.createDataFrame([("en", f"s{i % 6}", text) for i in range(18)], "lang string, source string, text string")
        counts = finish(divergence.term_counts(docs), "counts")
        index = finish(divergence.term_index(counts), "index")
        groups = finish(divergence.group_totals(counts, index), "groups")
        made.append(divergence.shared_sums(index, groups).count())
    assert made[0] <= made[1] <= 30


# ---- hard negatives --------------------------------------------------------------------------------


def vectors(seed, n=400, width=9, scale=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, scale, (6, width))
    rows = []
    for i in range(n):
        v = centres[i % 6] + rng.normal(0, scale / 3, width) if i % 5 else np.full(width, 0.25)  # many copies of one vector
        rows.append((i, [float(x) for x in v], int(rng.integers(0, 4))))
    return rows


def frame(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, slice string, shard string, key string, vector int"
    return spark.createDataFrame([(*r, "a", "b", "c", 1) for r in rows], schema).repartition(3)


def floats(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


@pytest.mark.parametrize("settings", [Settings(), Settings(codes=3, shard_rows=90, slice_anchors=3, run_rows=8)])
def test_hard_negatives_match_brute_force(spark, settings):
    rows = vectors(3)
    rows += [(1000, None, 1), (1050, [0.1] * 9, None), (1100, [0.1, None] + [0.2] * 7, 1), (1150, [math.nan] + [0.2] * 8, 1),
             (1200, [math.inf] * 9, 2), (None, [0.3] * 9, 1), (1250, [0.0] * 9, 3), (1300, [-1.0] * 9, 2), (1350, [3.0] * 9, 8)]
    got = sorted(tuple(r) for r in hard_negatives(frame(spark, rows), settings=settings).collect())
    assert got == brute.hard_negatives(floats(rows)) and got


def test_odd_vectors(spark):
    assert hard_negatives(frame(spark, []).limit(0)).collect() == []
    only = [(0, [0.5] * 4, 1), (1, [0.5] * 4, 2)]
    assert hard_negatives(frame(spark, only)).collect() == []
    short = [(50, [1.0, 1.0], 1), (51, [1.0], 1), (52, [0.9, 0.0, 7.0], 2), (53, [], 2), (100, [], 1), (55, [1e30, 0.0], 2)]
    ended = [(i, (v + [0.0] * 3)[:3], label) for i, v, label in short[:-1]]
    assert sorted(tuple(r) for r in hard_negatives(frame(spark, short)).collect()) == brute.hard_negatives(floats(ended))


def test_repeated_rows(spark):
    rows = vectors(4, 120)
    twice = [r for r in rows for _ in range(1 if r[0] % 50 else 2)]
    got = sorted(tuple(r) for r in hard_negatives(frame(spark, twice)).collect())
    assert got and len(got) == len(set(got)) and {r[0] for r in got} <= {0, 50, 100}
    assert all(r[0] not in (r[1], r[3]) for r in got)


def test_large_scores_are_exact(spark):
    rows = [(i, [60_000.0 + i % 7, 1.0 * i, -5.0], i % 2) for i in range(160)]
    got = sorted(tuple(r) for r in hard_negatives(frame(spark, rows)).collect())
    assert got == brute.hard_negatives(floats(rows))


def test_walk_is_certified():
    """Every bound holds for all rows still to come, each row comes once, and clustered rows let the walk stop early."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 60, (16, 8))
    data = np.round(centres[rng.integers(0, 16, 3000)] + rng.normal(0, 2, (3000, 8))).astype(np.int64)
    books = tuple(codebook(half.astype(float), 8, 8) for half in (data[:, :4], data[:, 4:]))
    index = MultiIndex(np.arange(3000), np.zeros(3000, np.int64), data, books)
    for anchor in data[:20]:
        scores, seen = index.vectors @ anchor, np.zeros(3000, int)
        for rows, bound in index.walk(anchor, 64):
            seen[rows] += 1
            assert (scores[seen == 0] <= bound).all()
        assert (seen == 1).all()
    visited = []
    walk = MultiIndex.walk

    def counted(self, anchor, run_rows):
        for rows, bound in walk(self, anchor, run_rows):
            visited[-1] += len(rows)
            yield rows, bound

    MultiIndex.walk = counted
    try:
        for anchor in data[:20]:
            visited.append(0)
            nearest_positives(index, -1, 0, anchor, 5, 64)
    finally:
        MultiIndex.walk = walk
    assert sum(visited) < 0.5 * 20 * 3000
