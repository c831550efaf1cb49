import random

import brute
import numpy as np
import pytest
from conftest import SF_SMALL

from millrace.llm import minhash
from millrace.llm.components import components
from millrace.llm.minhash import BITS, HASHES, estimate_floor, near_duplicates, shingle_hashes, signatures
from millrace.llm.recompression import anchors, remove_repeats, rounds
from millrace.llm.wordhash import word_hashes

SCHEMA = "doc_id long, text string, anchors string, node int, label string, sha int, class int"


def frame(spark, docs):
    """With extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(d, t, "x", 1, "y", 2, 3) for d, t in docs], SCHEMA).repartition(3)


def collection(seed, groups=8, copies=14, length=60):
    """Groups of near copies of all degrees, exact copies, shared passages, short, empty and repetitive texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Über", "naïve", "日本語"]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    texts = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for c in range(copies):
            new = [rng.choice(vocabulary) if rng.random() < c * 0.004 else w for w in base]
            if c % 5 == 0:
                at = rng.randrange(len(new))
                new[at:at] = passage[: rng.choice((12, 13, 30))]
            texts.append(" ".join(new) if c % 2 else "\n\t".join(new).upper() if c % 7 == 0 else "  ".join(new))
    texts += ["", " \n ", None, "one two", "one two", "One  TWO", "a", "x " * 40, "x " * 41, "x " * 12 + "y", "a b " * 30, "a b " * 31]
    texts += [texts[3], texts[3], texts[20].lower(), "q " * 5000 + texts[7], "w1\xa0w2 w3"]
    rng.shuffle(texts)
    ids = rng.sample(range(10_000), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_against_brute_force(spark, seed):
    docs = collection(seed)
    got = {r[0]: tuple(r[1:]) for r in near_duplicates(frame(spark, docs)).collect()}
    assert got == brute.near(docs)


def test_near_chain_and_leader_outside(spark):
    """Links that run through the middle of a group are found though its ends are not alike."""
    words = [f"t{i}" for i in range(400)]
    docs = [(100 - i, " ".join(words[i * 12 : i * 12 + 200])) for i in range(12)]
    got = {r[0]: tuple(r[1:]) for r in near_duplicates(frame(spark, docs)).collect()}
    assert got == brute.near(docs)


def test_near_odd_rows(spark):
    assert near_duplicates(frame(spark, [])).count() == 0
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (7, "A b c d e f"), (9, None)]
    got = sorted(((r.doc_id or -1, r.component_id, r.kept) for r in near_duplicates(frame(spark, rows)).collect()))
    assert got == [(-1, None, True), (5, 5, True), (5, 5, True), (7, 5, False), (9, 9, True)]


def test_estimate():
    rng = random.Random(3)
    base = [f"v{i}" for i in range(3000)]
    other = [w if rng.random() > 0.03 else w + "x" for w in base]
    texts = [" ".join(base).encode(), " ".join(other).encode()]
    a, b = (set(shingle_hashes([t])[0].tolist()) for t in texts)
    truth = len(a & b) / len(a | b)
    _, _, packed, _ = signatures(texts)
    x = packed[0] ^ packed[1]
    equal = sum(int((int(v) >> (BITS * i)) & (2**BITS - 1) == 0) for v in x for i in range(64 // BITS))
    chance = 2.0**-BITS
    assert abs((equal / HASHES - chance) / (1 - chance) - truth) < 0.13
    assert 0.7 < estimate_floor(0.85) < 0.75


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(50), 100 + rng.randrange(50)) for _ in range(60)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        p, q = sorted((root(a), root(b)))
        parent[q] = p
    assert {n: root(n) for n in parent if root(n) != n} == got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", [5, 6])
def test_repeats_against_brute_force(spark, seed):
    docs = collection(seed)
    got = {r[0]: tuple(r[1:]) for r in remove_repeats(frame(spark, docs)).collect()}
    assert got == brute.repeats(docs)


def test_repeats_odd_rows(spark):
    assert remove_repeats(frame(spark, [])).count() == 0
    long = " ".join(f"k{i}" for i in range(20))
    rows = [(None, long), (4, long), (4, long), (4, "z " + long), (6, "y " + long), (3, None), (8, long + " " + long)]
    out = remove_repeats(frame(spark, rows), texts=True).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in out)
    assert got == [(-1, 20, 0), (3, 0, 0), (4, 20, 0), (4, 20, 0), (4, 21, 0), (6, 21, 20), (8, 40, 40)]
    assert {r.kept_text for r in out if r.doc_id == 6} == {"y"}


def test_equal_windows_have_equal_anchors():
    rng = random.Random(7)
    words = [rng.choice("abcdefgh") for _ in range(3000)]
    shared = [rng.choice("abcdefgh") for _ in range(40)]
    one = " ".join(words[:900] + shared + words[900:1500]).encode()
    two = " ".join(words[1500:2000] + shared + words[2000:]).encode()
    by_window = {}
    for text in (one, two):
        w, _, start, _, anchor = anchors([text])
        own = text.split()
        for s, a in zip(start, anchor):
            assert by_window.setdefault(b" ".join(own[s : s + 13]), a) == a
    # The context of every symbol names it: the same words give the same parse.
    hashes, begins = word_hashes([one, one])
    text = np.repeat([0, 1], np.diff(begins))
    for low, high in rounds(hashes, text):
        assert (np.diff(low) >= 0).all() and (np.diff(high) >= 0).all()


@pytest.mark.parametrize("operator, check", [(near_duplicates, brute.near), (remove_repeats, brute.repeats)])
def test_real_rows(spark, operator, check):
    docs = spark.read.parquet(SF_SMALL + "/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert {r[0]: tuple(r[1:]) for r in operator(docs).collect()} == check(rows)


@pytest.mark.parametrize("blocks", [(1, 1), (2, 512)])
def test_crowded_groups_lose_no_link(spark, monkeypatch, blocks):
    """With tiny blocks nearly every group goes through the lists of rare shingles."""
    monkeypatch.setattr(minhash, "SKETCH_BLOCK", blocks[0])
    monkeypatch.setattr(minhash, "SET_BLOCK", blocks[1])
    docs = collection(21, groups=5, copies=16, length=50)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame(spark, docs)).collect()}
    assert got == brute.near(docs)


def test_links_meet_in_lists_of_rare_shingles(spark):
    """Every pair at the threshold shares a list, whatever the sizes of the sets."""
    rng = random.Random(6)
    base = [rng.randrange(10**12) for _ in range(120)]
    sets = {}
    for node in range(60):
        own = rng.sample(base, rng.randrange(90, 121)) + [rng.randrange(10**12) for _ in range(rng.randrange(12))]
        sets[node] = set(own)
    sets |= {60: {1, 2, 3}, 61: {1, 2, 3}, 62: {5}, 63: {5}, 64: set(range(20)), 65: set(range(17)), 66: set(range(16))}
    rows = [(n, np.sort(np.array(list(s), np.uint64)).tobytes()) for n, s in sets.items()]
    lists = {}
    for r in minhash.prefix_lists(spark.createDataFrame(rows, "node long, shingles binary"), 85).collect():
        lists.setdefault(r.group, set()).add(r.node)
    met = {(a, b) for nodes in lists.values() for a in nodes for b in nodes if a < b}
    linked = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert linked and linked <= met and (64, 65) in linked and (64, 66) not in linked


def test_candidates_grow_with_the_classes(spark, monkeypatch):
    """Classes that share a passage and nothing else: blocks against blocks would be four times the rows for twice the
    classes; the lists that are made instead hold none of them."""
    monkeypatch.setattr(minhash, "SKETCH_BLOCK", 16)
    monkeypatch.setattr(minhash, "SET_BLOCK", 8)
    made, walk = [], minhash._walk
    monkeypatch.setattr(minhash, "_walk", lambda cells, *a: (made[-1].append(cells.count()), walk(cells, *a))[1])
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(60))
    for n in (200, 400):
        made.append([])
        docs = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(14)) + " " + passage) for i in range(n)]
        rows = near_duplicates(frame(spark, docs)).collect()
        assert all(r.kept for r in rows)
    assert sum(made[1]) <= 2.5 * sum(made[0]) + 100 and sum(made[1]) < 5 * 400
