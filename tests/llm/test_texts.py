import hashlib
import random
import time

import brute
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from millrace.llm import html_text, winnowing
from millrace.llm.neighbours import ranged
from millrace.llm.toxicity import Settings, fit, ftrl, score, toxicity
from millrace.llm.wordhash import mix, odd, slices, word_hashes


def test_words_follow_the_separators():
    texts = [b"", None, b"a  b\tc", "é\xa0x\x1cy é\xa0x\x1cy".encode(), b" a ", b"A"]
    hashes, begins = word_hashes(texts)
    assert np.diff(begins).tolist() == [0, 0, 3, 2, 1, 1]
    assert hashes[3] == hashes[4] and hashes[0] == hashes[5] != hashes[6]
    assert word_hashes([b"A"], lower=True)[0][0] == hashes[0]
    assert list(slices([b"x" * 50, b"", b"y"], 10)) == [(0, 1), (1, 3)]
    assert list(slices([])) == []


@pytest.mark.parametrize("text", ["", "ab", "a" * 200, "abcabcabc" * 40, "日本語テキスト" * 30, "x" * 16, "the cat sat on the mat " * 9])
def test_winnowing_positions(text):
    gram, window = 5, 8

    def value(part):
        points = winnowing.code_points(part).astype(np.uint64)
        up, down = winnowing.powers(len(points) + 1)
        total = np.add.reduce(mix(points + np.uint64(1)) * up[: len(points)], dtype=np.uint64)
        return int(mix(np.array([total * down[0] + np.uint64(len(points))], np.uint64))[0] >> np.uint64(32))

    hashes, places = winnowing.fingerprint(text, gram, window)
    assert places.tolist() == brute.winnow(text, gram, window, value)
    again = winnowing.unpacked(winnowing.packed((hashes, places)))
    assert again[0].tolist() == hashes.tolist() and again[1].tolist() == places.tolist()


def test_winnowing_guarantee():
    rng = random.Random(1)
    letters = "abcdefghij é"
    shared = "".join(rng.choice(letters) for _ in range(winnowing.GRAM + winnowing.WINDOW - 1))
    for _ in range(20):
        a, b = ("".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(2))
        x, y = (set(winnowing.fingerprint(t + shared + t)[0].tolist()) for t in (a, b))
        assert x & y


@pytest.mark.parametrize("parts", [1, 5])
def test_edited_fingerprints(spark, parts):
    rng = random.Random(2)
    docs = [(i * 3, "".join(rng.choice("abc dé\n") for _ in range(rng.choice((0, 3, 40, 900))))) for i in range(40)]
    docs += [(200, None), (201, "tail"), (202, "tail")]
    rng.shuffle(docs)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        rows = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, _side int, _id int").repartition(4)
        got = {r.doc_id: r for r in winnowing.edited_fingerprints(rows).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    docs.sort()
    assert len(got) == len(docs)
    for (doc_id, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        text, following = text or "", following or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        row, own = got[doc_id], winnowing.fingerprint(text)
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == winnowing.packed(own) and row.edited_fingerprint == winnowing.packed(winnowing.fingerprint(edited))
        assert row.near_edited == winnowing.likeness(own, winnowing.fingerprint(edited))
        assert row.near_next == winnowing.likeness(own, winnowing.fingerprint(following))


def test_fingerprint_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert winnowing.edited_fingerprints(empty).count() == 0
    one = winnowing.edited_fingerprints(spark.createDataFrame([(None, "only")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    twice = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, None)], "doc_id long, text string")
    assert winnowing.edited_fingerprints(twice).count() == 3
    prints = winnowing.fingerprints(twice).collect()
    assert len({r.fingerprint for r in prints if r.doc_id == 1}) == 1


def test_ranges_have_both_neighbours(spark):
    rows = spark.range(1000).repartition(5)
    marked = ranged(rows, {"k": rows["id"]}, partitions=7, wrap=True, before=True).collect()
    own = [r for r in marked if r._side == 0]
    assert sorted(r.id for r in own) == list(range(1000))
    for number in {r._range for r in own}:
        ids = [r.id for r in marked if r._range == number]
        here = [r.id for r in own if r._range == number]
        follow = (here[-1] + 1) % 1000
        assert ids == ([here[0] - 1] if here[0] else []) + here + [follow]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p><p>no";</script></head><body>
<header><p>Site name</p></header><nav><ul><li><a href=/a>Menu</a></ul></nav>%s<div class="ad">Buy</div>
<div class="comments"><p>First!</p></div><footer>&copy; me</footer></body></html>"""


def test_lines_of_a_page():
    page = PAGE % "<article><h1>Head &amp; tail</h1><p>One\n  <b>two</b>&nbsp;x<br>y<p>Three<aside>skip</aside></article>"
    lines, kinds = html_text.page_lines(page)
    kept = [line for line, kind in zip(lines, kinds) if kind == html_text.KEEP]
    assert kept == ["Head & tail", "One two x y", "Three"]
    assert {line for line, kind in zip(lines, kinds) if kind == html_text.DROP} >= {"Site name", "Menu", "Buy", "First!", "© me", "skip"}
    for odd_page in ("", "<", "<p", "text < 3 <b", "<!-- never", "<script>x", "&#xZZ; &#0; &bogus;", "<p>" * 500 + "deep"):
        html_text.page_lines(odd_page)


def test_a_self_closing_svg_hides_only_itself():
    page = '<article><p>One <svg class="icon"/> two<p>Three <svg/><svg><text>skip</text></svg> four</article>'
    assert html_text.page_lines(page) == (["One two", "Three four"], [html_text.KEEP] * 2)


def test_names_inside_an_article_are_not_noise():
    page = PAGE % """<article class="post category-social-media"><h2 id="related-work">Related work</h2>
    <section id="social-impact"><p>Impact</p></section><p class="share-price">Up <b id="ads">5</b></p>
    <h2 id="ads-and-media">Ads</h2><table class="menu"><tr><td class="social">Cell</table><div class="notice-of-death">Died</div>
    <div class="box share">Share me</div><div role="navigation">Back</div><ul class="social"><li>Follow</ul></article>"""
    lines, kinds = html_text.page_lines(page)
    kept = [line for line, kind in zip(lines, kinds) if kind == html_text.KEEP]
    assert kept == ["Related work", "Impact", "Up 5", "Ads", "Cell", "Died"]
    assert {line for line, kind in zip(lines, kinds) if kind == html_text.DROP} >= {"Share me", "Back", "Follow", "Buy", "First!"}
    page = """<body class="no-sidebar"><div id="footer">F</div><div class="nav-bar">N</div><h2 id="related-work">R</h2>
    <section id="social-impact">S</section><p class="share-price">P</p>"""
    lines, kinds = html_text.page_lines(page)
    assert list(zip(lines, kinds)) == [("F", -1), ("N", -1), ("R", 0), ("S", 0), ("P", 0)]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(12))] for _ in range(2))
        found = sorted(html_text.shared(a, b))
        assert len(found) == brute.lcs(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found)


@pytest.mark.parametrize("stored, pairs", [(4, 0), (64, 0), (16_000_000, 10**6), (4, 10)])
def test_every_way_of_aligning_gives_a_longest_common_subsequence(monkeypatch, stored, pairs):
    monkeypatch.setattr(html_text, "STORED_BITS", stored)
    monkeypatch.setattr(html_text, "MOST_PAIRS", pairs)
    rng = random.Random(4)
    for _ in range(600):
        letters = "abcdefgh"[: rng.randrange(1, 9)]
        a, b = ([rng.choice(letters) for _ in range(rng.randrange(16))] for _ in range(2))
        found, rest = sorted(html_text.shared(a, b)), iter(b)
        assert len(found) == brute.lcs(a, b) and all(a[i] in rest for i in found)


@pytest.mark.parametrize("kinds", [3, 600, 10**9])
def test_pages_of_very_many_lines_align_in_seconds(kinds):
    rng = random.Random(kinds)
    a, b = ([str(rng.randrange(kinds)) for _ in range(200_000)] for _ in range(2))
    if kinds > 10**6:
        b = a[:100_000] + b[:10] + a[100_000:]
    began = time.process_time()
    found = html_text.shared(a, b)
    assert time.process_time() - began < 60
    assert kinds < 10**6 or len(found) == 200_000


@pytest.mark.parametrize("piece", ["<p '", '<p title="abc>x ', "<", "<!--", "<a b=c ", "<script>", "<p a='x\">", "</", "<p x ", "<!", '<p a="', "<svg "])
def test_broken_markup_takes_linear_time(piece):
    began = time.process_time()
    html_text.page_lines(piece * (2_000_000 // len(piece)))
    assert time.process_time() - began < 30


def test_broken_tags_lose_no_text():
    cases = {
        '<p title="abc>Hello world</p>': ["Hello world"], "<a href=x'>link</a> here isn't": ["link here isn't"],
        '<p title="a>b">x</p>': ["x"], "<p a=b'c d>y": ["y"], "<div class=x/>z</div>": ["z"], "1 < 2 <b>ok": ["1 < 2 ok"],
        "<p": [], "x <a href='": ["x"], "<p =a>q": ["q"], "<p a = 'b' c>r<!-- s --> t": ["r t"], "<P\nA\n=\n\"1\">u</P >v": ["u", "v"],
        "a<br/>b<br / >c": ["a b c"],
    }
    for page, want in cases.items():
        assert html_text.page_lines(page)[0] == want, page


def test_compound_names_inside_an_article_are_noise():
    noise = ["comment-list", "reader-comments", "ad-slot", "sidebar-left", "cookie-notice", "comments-section", "share-buttons", "newsletter-signup"]
    page = "<article><p>Stay</p>" + "".join(f'<div class="x {n}"><p>{n}</p></div>' for n in noise) + '<section id="comments">c</section>'
    page += '<div class="commentary">Essay</div><section id="social-impact">Impact</section><h2 id="comments">Title</h2></article>'
    lines, kinds = html_text.page_lines(page)
    assert [t for t, k in zip(lines, kinds) if k == html_text.KEEP] == ["Stay", "Essay", "Impact", "Title"]


def test_a_form_around_the_page_is_a_wrapper():
    page = "<body><form><nav>Menu</nav><article><p>The whole text of the page</p></article></form><p>Foot</p></body>"
    assert html_text.page_lines(page) == (["Menu", "The whole text of the page", "Foot"], [-1, 1, 0])
    assert html_text.page_lines("<form>Your name</form><p>A longer text of the page</p>")[1] == [-1, 0]


def test_main_texts_match_brute_force(spark):
    """Random sites: pages with and without articles, shared menus, forms, adverts, copies under another URL."""
    rng = random.Random(11)
    rows, n = [], 0
    for site in range(6):
        menu = [f"Menu {site} {i}" for i in range(rng.randrange(5))]
        for _ in range(rng.randrange(1, 12)):
            own = [f"Text {n} {i} " + "word " * rng.randrange(9) for i in range(rng.randrange(6))]
            body = "".join((lambda tag: f"<{tag}>{t} &amp; <b>more</b><br>end</{tag}>")(rng.choice(("p", "div", "h2"))) for t in own)
            body = f"<article>{body}<div class='comment-list'>Me {n}</div></article>" if rng.random() < 0.4 else body
            top = "".join(f"<div>{t}</div>" for t in menu)
            page = f"<html><head><title>T</title></head><body>{top}<nav>N</nav>{body}<div class='ad'>Buy {n}</div><form>Your mail {n}</form><script>x<1</script></body></html>"
            rows.append((n, f"http://site{site}.example/{rng.choice('abc')}/{rng.randrange(50)}/{n}", page))
            n += 1
            if rng.random() < 0.2:
                rows.append((n, rows[-1][1] + "?print", page.replace("Buy", "Get")))
                n += 1
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in html_text.main_texts(frame).collect()}
    assert got == brute.main_texts(rows)


def test_borders_of_ranges_are_drawn_once(spark):
    """With more keys than the sampler takes, two runs of a range partitioning differ; rows behind stretches must not."""
    n = 400_000
    rows = spark.range(n).selectExpr("id", "id div 50000 as t", "xxhash64(id) as h").repartition(6, "h")
    marked = ranged(rows, {"a": rows["t"], "b": rows["id"]}, partitions=16, before=True, alike=("a",))
    counts = {(r._range, r._side): (r.n, r.lo, r.hi) for r in marked.groupBy("_range", "_side").agg(
        F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).collect()}
    own = sorted((lo, hi) for (_, side), (_, lo, hi) in counts.items() if side == 0)
    assert sum(counts[k][0] for k in counts if k[1] == 0) == n and len(own) > 8
    for (number, side), (_, lo, hi) in counts.items():
        if side:
            first, last = counts[number, 0][1:]
            edge = last if side > 0 else first
            want = {edge + side}
            stretch = edge + side
            while 0 <= stretch < n and stretch // 50_000 == edge // 50_000:
                stretch = (edge // 50_000 + 1) * 50_000 if side > 0 else edge // 50_000 * 50_000 - 1
            want |= {stretch}
            assert {lo, hi} <= want | {x for x in want} and (stretch >= n or stretch < 0 or {lo, hi} & {stretch} or edge // 50_000 != (edge + side) // 50_000)


def test_differencing_without_markup(spark):
    """Where no element names the article, the neighbour's lines tell."""
    body = "<body><div>Top links</div><div>{}</div><p>{}</p><div>Bottom</div></body>"
    rows = [(i, f"http://h.example/a/{i}", body.format(f"Story {i}", f"More {i}")) for i in range(9)]
    rows += [(20, "http://lone.example/", body.format("Lone", "page")), (21, None, None), (22, "no url", "plain")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, _host string").repartition(3)
    got = {r.page_id: r for r in html_text.main_texts(pages).collect()}
    assert all(got[i].text == f"Story {i}\nMore {i}" and got[i].n_shared == 2 for i in range(9))
    assert got[20].text == "Top links\nLone\npage\nBottom"
    assert (got[21].text, got[21].n_chars, got[22].text) == ("", 0, "plain")
    assert html_text.main_texts(pages.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "http://h/", "<p>x</p>")] * 4, "page_id long, url string, html string")
    assert html_text.main_texts(same).count() == 4


@pytest.mark.parametrize("parts", [1, 6])
def test_copies_under_another_url_decide_nothing(spark, parts):
    body = "<body><div>Top links</div><p>{0} has one long line</p><p>{0} has one more long line</p>{1}<div>Bottom</div></body>"
    text = "{0} has one long line\n{0} has one more long line".format
    rows = [(i, f"http://h.example/a/{i}", body.format(f"Story {i}", "")) for i in range(9)]
    rows += [(10, "http://h.example/a/4?utm_source=x", rows[4][2]), (11, "http://h.example/a/6?utm_source=x", rows[6][2] + "<link>")]
    rows += [(20 + i, "http://h.example/a/7", rows[7][2]) for i in range(40)]  # repeated rows over several ranges
    rows += [(70, "http://two.example/x", rows[1][2]), (71, "http://two.example/x?print=1", "<p>" + text("Story 1").replace("\n", "<p>"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r.page_id: r.text for r in html_text.main_texts(pages).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(got) == len(rows)
    for i in (*range(9), 10, 11, *range(20, 60)):
        story = {10: 4, 11: 6}.get(i, min(i, 7) if i != 8 else 8)
        assert got[i] == text(f"Story {story}"), i
    assert text("Story 1") in got[70] and got[71] == text("Story 1")  # no other page: nothing of the article goes


@pytest.mark.parametrize("parts", [1, 5, 9])
def test_ranges_have_the_rows_behind_a_stretch(spark, parts):
    rng = random.Random(8)
    keys = sorted((h, t) for h, t in ((rng.randrange(3), rng.choice((0, 0, 0, 1, 1, 2))) for _ in range(60)))
    rows = spark.createDataFrame([(i, *k) for i, k in enumerate(keys)], "id long, h int, t int").repartition(4)
    key = {"a": rows["h"], "b": rows["id"], "c": rows["t"]}
    marked = ranged(rows, key, partitions=parts, before=True, alike=("a", "c")).collect()
    own = [r for r in marked if r._side == 0]
    assert sorted(r.id for r in own) == list(range(60))
    for number in {r._range for r in own}:
        here = [r.id for r in own if r._range == number]
        want = set(here)
        for edge, step in ((here[0], -1), (here[-1], 1)):
            at = edge + step
            if 0 <= at < 60:
                want.add(at)
            while 0 <= at < 60 and keys[at] == keys[edge]:
                at += step
            if 0 <= at < 60:
                want.add(at)
        ids = [r.id for r in marked if r._range == number]
        assert ids == sorted(want)


def test_pages_keep_their_article(spark):
    pages = spark.read.parquet(SF_SMALL + "/pages.parquet")
    got = {r.page_id: r.text for r in html_text.main_texts(pages).collect()}
    import html
    import re

    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article)
        lines = [" ".join(html.unescape(re.sub(r"<[^>]+>", " " if "br" in b else "", b)).split()) for b in blocks]
        assert got[r.page_id].replace(" ", "") == "\n".join(x for x in lines if x).replace(" ", "")


def test_toxicity_learns_and_holds_out(spark):
    rng = random.Random(4)
    clean = [f"word{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(900):
        text = [rng.choice(clean) for _ in range(40)]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for w in rng.sample(["awful", "rotten", "Vile!"], 2):
                text.insert(rng.randrange(len(text)), w)
        docs.append((i, " ".join(text), "en"))
        labels.append((i, toxic if i % 50 else None, "z"))
    docs += [(1000, None, "en"), (1001, "", "en"), (None, "awful rotten vile", "en"), (1002, "awful rotten vile " * 3000, "fr")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    got = {r.doc_id: r for r in toxicity(frame, marks).collect()}
    import zlib

    assert all(r.held_out == (d is not None and zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    held = [(got[i].predicted, t) for i, t, _ in labels if t is not None and got[i].held_out]
    assert sum(p == t for p, t in held) / len(held) > 0.97
    assert got[1000].score == got[1001].score < 0.7 <= got[None].score and got[1002].predicted == 1
    # Labels of the held-out third change nothing.
    other = marks.withColumn("toxic", marks["toxic"] * 0 + 1).where("pmod(crc32(cast(doc_id as string)), 3) = 1").unionByName(
        marks.where("pmod(crc32(cast(doc_id as string)), 3) != 1"))
    model, again = fit(frame, marks), fit(frame, other)
    assert model[0] == again[0] and (model[2] == again[2]).all()
    assert len(model[1]) < 2000
    none = score(frame, fit(frame, marks.limit(0)))
    assert {r.score for r in none.collect()} == {0.5}
    assert toxicity(frame.limit(0), marks).count() == 0


@pytest.mark.parametrize("l1, l2, epochs", [(0.0, 0.0, 1), (0.3, 0.0, 3), (1.0, 0.5, 4), (50.0, 0.0, 2)])
def test_ftrl_equals_a_plain_version(l1, l2, epochs):
    rng = random.Random(int(10 * l1) + epochs)
    rows = [np.array(sorted(rng.sample(range(60), rng.randrange(12))), np.int32) for _ in range(150)]
    labels = np.array([float(len(r) > 0 and (r[0] < 9 or rng.random() < 0.1)) for r in rows])
    settings = Settings(bits=6, alpha=0.7, beta=0.5, l1=l1, l2=l2, epochs=epochs, positive=2.5)
    bias, places, weights = ftrl(rows, labels, settings)
    want_bias, want = brute.ftrl([r.tolist() for r in rows], labels.tolist(), 0.7, 0.5, l1, l2, epochs, 2.5)
    assert bias == pytest.approx(want_bias, rel=1e-9, abs=1e-12)
    assert dict(zip(places.tolist(), weights.tolist())) == pytest.approx(want, rel=1e-9)
    assert l1 < 50 or not len(places)


def test_ids_that_repeat_are_learned_once(spark):
    """A labelled id with very many documents adds one row to the sample."""
    docs = [(i, f"clean words {i}" if i % 2 else f"vile rotten {i}") for i in range(60)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "doc_id long, toxic int")
    schema = "doc_id long, text string"
    once = fit(spark.createDataFrame(docs, schema), labels)
    many = fit(spark.createDataFrame(docs + [(d, t + " zz") for d, t in docs for _ in range(20)] + docs * 3, schema), labels)
    assert once[0] == many[0] and (once[1] == many[1]).all() and (once[2] == many[2]).all()


def test_general_functions_run_on_a_plain_session(tmp_path):
    """Workers that cannot import the package: its code goes with the tasks."""
    import pathlib
    import subprocess
    import sys

    root = pathlib.Path(html_text.__file__).resolve().parents[2]
    code = f"""
import sys
sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", {str(tmp_path)!r}).getOrCreate()
spark.conf.set("spark.sql.shuffle.partitions", "2")
from millrace.llm import divergence, hard_negatives, html_text, secrets, token_counts, toxicity, warc, winnowing
pages = spark.createDataFrame([(1, "http://a/", "<p>x</p>")], "page_id long, url string, html string")
docs = spark.createDataFrame([(1, "some text", "en", "s")], "doc_id long, text string, lang string, source string")
labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
rows = spark.createDataFrame([(50, [1.0], 1), (51, [1.0], 1), (52, [0.7], 2)], "vec_id long, embedding array<double>, label int")
counts = [f.count() for f in (html_text.main_texts(pages), winnowing.edited_fingerprints(docs), token_counts.token_counts(docs),
    toxicity.toxicity(docs, labels), warc.archive_pages(spark, pages), secrets.document_secrets(docs), divergence.source_divergence(docs),
    hard_negatives.hard_negatives(rows))]
print("counts", counts)
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "counts [1, 1, 1, 1, 1, 1, 0, 1]" in out.stdout, out.stderr[-3000:]


def test_toxicity_on_real_rows(spark):
    folder = SF_SMALL.replace("0.001", "0.1")
    labels = spark.read.parquet(folder + "/labels.parquet")
    rows = toxicity(spark.read.parquet(folder + "/documents.parquet"), labels).where("held_out").join(labels, "doc_id").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit / sum(r.toxic for r in rows) > 0.65 and hit / sum(r.predicted for r in rows) > 0.98


def test_settings_are_bounded():
    assert Settings().max_rows <= 20_000 and Settings().bits <= 22 and len(odd(1, 3)) == 3
