import gzip
import io
import random
import zlib

import brute
import oracle
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry_point
from millrace.llm import packing, token_counts, warc, word_bpe
from millrace.llm.exact_dedup import DigestIndex, exact_duplicates
from millrace.llm.mixing import mix, targets

ODD = [
    "", " ", "\n", "\n\n a", " a", "a ", "a  b   c", "\t x\ty", "▁▁a ▁b", "日本語 テキスト", "İSTANBUL ΣΑΣ", "é é ñ", "́x",
    "<s> </s> <unk> <0x41>", "<|startoftext|>x<|endoftext|> <|end", "I'll don't 'S x'sy 123 4.5", "\xa0a\xa0b c", "a\x1cb\x85c",
    "x" * 500, "🙂🙂 🙃", "\x00a", "ﬁ ª º ² ⅷ", "ß ẞ ǅ", "....!!!", "a\r\nb\x0bc\x0cd", "end  ", "  \n  ", "don’t", "Ĳĳ ŉ İ",
]


def texts(n=300):
    import duckdb

    rows = duckdb.sql(f"select text from '{SF_SMALL}/documents.parquet' limit {n}").fetchall()
    return [r[0] for r in rows]


def test_word_ids_equal_the_library():
    from tokenizers import Tokenizer

    words = word_bpe.WordIds(word_bpe.default_path())
    whole = Tokenizer.from_file(word_bpe.default_path())
    for text in ODD + texts():
        want = whole.encode(text, add_special_tokens=False).ids
        assert words.text_ids(text.encode()) == b"".join(i.to_bytes(4, "little") for i in want), text


def test_word_ids_in_a_small_memo_equal_the_library():
    """Generations that hold a few words, mixed case, marks, special strings, long words, other alphabets."""
    from tokenizers import Tokenizer

    words = word_bpe.WordIds(word_bpe.default_path(), 4_000, 2_000)
    whole = Tokenizer.from_file(word_bpe.default_path())
    rng = random.Random(3)
    some = ["The", "the.", "THE,", "don't", "DON'T", "a'S", "<|endoftext|>", "<|ENDOFTEXT|>", "x<|startoftext|>y", "<", "Über", "naïve?", "ǅ", "İi", "ΑΣ",
            "日本語", "e\u0301a", "A\u030a", "x" * 300, "1a2", "..", "a..", "don't.", "ß", "\u2028", "a\xa0b", "\x1c", "\x85z"]
    for _ in range(400):
        text = rng.choice([" ", "\n", "\t "]).join(rng.choice(some) for _ in range(rng.randrange(12)))
        want = whole.encode(text, add_special_tokens=False).ids
        assert words.text_ids(text.encode()) == b"".join(i.to_bytes(4, "little") for i in want), repr(text)
    assert words.words.bytes <= 4_000 and words.parts.bytes <= 2_000
    assert max(map(len, [*words.words, *words.words.older])) <= word_bpe.KEEP_BYTES


@pytest.mark.parametrize("change", ["pattern", "case", "none"])
def test_tokenizer_files_that_words_cannot_follow_use_the_library(tmp_path, change):
    import json

    from tokenizers import Tokenizer

    with open(word_bpe.default_path(), encoding="utf-8") as file:
        spec = json.load(file)
    if change == "pattern":  # parts may hold white space
        spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"\s?[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    elif change == "case":
        spec["normalizer"]["normalizers"].pop()
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(spec, file)
    words, whole = word_bpe.WordIds(path), Tokenizer.from_file(path)
    assert (words.rules is None) == (change != "none")
    for text in ODD + texts(40):
        want = whole.encode(text, add_special_tokens=False).ids
        assert words.text_ids(text.encode()) == b"".join(i.to_bytes(4, "little") for i in want)


def test_counts_equal_the_library(spark):
    model = token_counts.load_model(token_counts.default_path())
    assert token_counts.provable(model)
    counts = token_counts.Counts(token_counts.default_path())
    assert len(counts.whole) > 20_000
    rng = random.Random(1)
    mixed = ["".join(rng.choice(["a", " ", "\n", "▁", "the", "é", "\t", "  "]) for _ in range(12)) for _ in range(500)]
    for text in ODD + mixed + texts():
        assert counts.text_tokens(text.encode()) == len(model.encode(text)), repr(text)
    rows = spark.createDataFrame([(1, None, 5), (2, "the " * 5000, 6), (2, "", 7), (None, "x", 8)], "doc_id long, text string, n_tokens int")
    got = [tuple(r) for r in token_counts.token_counts(rows).orderBy("n_bytes").collect()]
    assert got[0][1:] == got[1][1:] == (0, 0, False) and got[2] == (None, 1, 1, False) and got[3][3] is True
    assert token_counts.token_counts(rows.limit(0)).count() == 0


def check_packing(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return by_sequence


def test_packing_is_a_round_trip(spark):
    from tokenizers import Tokenizer

    docs = list(enumerate(ODD + texts(150) + ["the cat " * 6000, None, "", ""]))
    docs += [docs[3], docs[3], (None, "no id")]
    frame = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, length int, _rank int").repartition(5)
    packed = packing.pack(frame, ids=True)
    rows = packed.collect()
    sequences = check_packing(rows, packing.CAPACITY)
    total = sum(r.length for r in rows)
    assert len(sequences) <= -(-total // packing.CAPACITY) + 1
    whole = Tokenizer.from_file(word_bpe.default_path())
    for doc_id, text in docs:
        want = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        parts = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.piece)
        assert [r.start for r in parts if r.piece == 0] and {r.start for r in parts} == set(range(0, len(want), packing.CAPACITY))
        for r in parts:
            piece = b"".join(i.to_bytes(4, "little") for i in want[r.start : r.start + packing.CAPACITY])
            assert bytes(r.ids) == piece and r.ids_crc32 == zlib.crc32(piece) and r.length == len(piece) // 4
    for s in packing.sequences(packed).collect():
        assert len(s.ids) == 4 * sum(n for _, n in sequences[s.sequence_id])
    assert packing.pack(frame.limit(0)).count() == 0


def test_plan_fills_bins():
    rng = random.Random(2)
    for _ in range(30):
        counts = {rng.randrange(1, 101): rng.randrange(1, 40) for _ in range(rng.randrange(1, 25))}
        plan = packing.plan(counts, 100)
        places = {}
        for n, (first, bins, offsets) in plan.slots.items():
            ends = [*first[1:], counts[n]]
            for a, b, start, offset in zip(first, ends, bins, offsets):
                for i in range(b - a):
                    places.setdefault(int(start + i), []).append((int(offset), n))
        assert sum(len(p) for p in places.values()) == sum(counts.values()) and len(places) == plan.bins
        for parts in places.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= 100
    # The fullest combination, against all subsets.
    for _ in range(100):
        counts = {rng.randrange(1, 30): rng.randrange(1, 3) for _ in range(5)}
        items = [n for n, c in counts.items() for _ in range(c)]
        sums = {0}
        for n in items:
            sums |= {s + n for s in sums}
        use = packing.fullest(counts, 40)
        assert sum(n * k for n, k in use.items()) == max(s for s in sums if s <= 40)
        assert all(k <= counts[n] for n, k in use.items())


def test_exact_index(spark):
    rows = [(1, "A b"), (2, "a B"), (3, "É"), (4, "é"), (5, None), (6, ""), (None, "z"), (7, "a b"), (7, "a b")]
    frame = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, keep_id int")
    index = DigestIndex(spark, buckets=4)
    got = sorted(((r.doc_id or -1, r.keep_id, r.group_size, r.kept) for r in index.add(frame).collect()))
    assert got == [(-1, None, 1, True), (1, 7, 4, False), (2, 7, 4, False), (3, 3, 1, True), (4, 4, 1, True), (5, 6, 2, False),
                   (6, 6, 2, True), (7, 7, 4, True), (7, 7, 4, True)]
    assert index.read().count() == 5
    more = spark.createDataFrame([(20, "a b"), (21, "new"), (22, "NEW")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in index.add(more).collect()))
    assert got == [(20, 7, 1, False), (21, 22, 2, False), (22, 22, 2, True)]
    assert index.read().count() == 6
    again = DigestIndex(spark, buckets=4, path=index.path).attach()
    assert again.read().count() == 6 and again.add(more).where("kept").count() == 0
    assert exact_duplicates(frame.limit(0)).count() == 0
    plan = index.read().groupBy("text_sha256").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_exact_copies_in_deliveries(spark):
    """Three deliveries into one index against a dictionary; what is kept follows from what the index had before."""
    rng = random.Random(9)
    index, seen = DigestIndex(spark, buckets=4), {}
    for delivery in range(3):
        rows = [(1000 * delivery + i, rng.choice("aAbBcCdDeEfFgG") + rng.choice(["", " x"]) if rng.random() < 0.9 else None) for i in range(40)]
        groups = {}
        for d, t in rows:
            groups.setdefault(brute.lower(t), []).append(d)
        got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in index.add(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        want = {}
        for t, ids in groups.items():
            stays = seen.get(t, max(ids))
            want |= {d: (stays, len(ids), t not in seen and d == stays) for d in ids}
            seen.setdefault(t, stays)
        assert got == want
    assert index.read().count() == len(seen)
    index.drop()


def test_no_table_stays_in_the_catalog(spark):
    before = {t.name for t in spark.catalog.listTables()}
    rows = exact_duplicates(spark.createDataFrame([(1, "a"), (2, "A"), (3, "b")], "doc_id long, text string"))
    assert {t.name for t in spark.catalog.listTables()} == before
    assert sorted((r.doc_id, r.kept) for r in rows.collect()) == [(1, False), (2, True), (3, True)]


def test_archives_in_a_folder_without_a_scheme(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "x" * 200), (2, "http://b/", "x" * 200), (3, None, None)], "page_id long, url string, html string")
    for folder in (str(tmp_path / "plain"), f"file://{tmp_path}/named", f"file:{tmp_path}/short"):
        rows = warc.archive_pages(spark, pages, folder).collect()
        assert sorted((r.page_id, r.record_type, r.refers_to) for r in rows) == [(1, "response", None), (2, "revisit", 1), (3, "response", None)]
        assert all(r.archive.split("://")[-1] for r in rows)


def test_mixing(spark):
    rng = random.Random(5)
    docs = [(i, " ".join(["w"] * rng.randrange(60)), rng.choice(["b", "a", "é", None, "B"] + ["hot"] * 6)) for i in range(400)]
    docs += [(500, None, "b"), (501, "", "empty"), (502, "x " * 3000, "a"), (503, "q r", "a"), (503, "q r", "a"), (None, "n o", "b")]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, source string, size int, taken int").repartition(4)
    quality = spark.createDataFrame([(i, float(i % 3)) for i in range(100)] * 2 + [(None, 1.0)], "doc_id long, quality double")
    rows = mix(frame, quality, slot_rows=17).collect()
    assert len(rows) == len(docs)
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(brute.words(text))
    want = brute.targets(sizes)
    for source in sizes:
        mine = [r for r in rows if r.source == source]
        assert all(r.source_size == sizes[source] and abs(r.target - want[source]) < 1e-6 for r in mine)
        assert abs(sum(r.taken for r in mine) - want[source]) <= 1
        assert all(0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size + r.part for r in mine)
        assert sum(r.part > 0 for r in mine) <= 1
    again = {(r.doc_id, r.text_sha256): r.taken for r in mix(frame.repartition(7), quality, slot_rows=1000).collect() if r.doc_id != 503}
    assert again == {(r.doc_id, r.text_sha256): r.taken for r in rows if r.doc_id != 503}
    assert mix(frame.limit(0)).count() == 0


def test_targets_level(spark):
    rng = random.Random(6)
    for share in (0.3, 1.0, 1.5, 1.99):
        sizes = {f"s{i:02}": rng.choice((0, 5, 100, 10_000)) for i in range(12)} | {None: 50}
        rows = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), share, 2.0, (3.0, 1.0, 2.0))
        want = brute.targets(sizes, share)
        assert all(abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source]) for r in rows.collect())


def test_better_documents_come_first(spark):
    rows = [(i, "a b c d", "s") for i in range(2000)] + [(5000 + i, "a " * 8000, "t") for i in range(2)]
    quality = spark.createDataFrame([(i, 4.0) for i in range(0, 2000, 2)], "doc_id long, quality double")
    out = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), quality, share=0.3).where("source = 's'").collect()
    good = sum(r.taken for r in out if r.doc_id % 2 == 0)
    assert good > 1.5 * sum(r.taken for r in out if r.doc_id % 2)


def test_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_RECORDS", 7)
    big = "<p>" + "same é " * 30
    rows = [(i, f"http://x/{i}", big if i % 3 == 0 else "tiny" if i % 3 == 1 else f"page {i} \r\n\r\nWARC/1.1\r\n" * 10) for i in range(40, 0, -1)]
    rows += [(50, None, None), (51, "a\nb", ""), (3, "http://x/3", big), (None, None, big)]
    pages = spark.createDataFrame([(*r, 9) for r in rows], "page_id long, url string, html string, file int").repartition(3)
    folder = f"file://{tmp_path}/w"
    out = warc.archive_pages(spark, pages, folder).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.payload_digest == brute.sha(big):
            assert (r.record_type, r.refers_to) == (("response", None) if r.page_id == 3 else ("revisit", 3))
            assert r.payload_bytes == len(big.encode())
        else:
            assert (r.record_type, r.refers_to) == ("response", None)
    want = {(i, brute.sha(h or ""), len((h or "").encode())) for i, _, h in rows}
    assert {(r.page_id, r.payload_digest, r.payload_bytes) for r in out} == want
    # Every member is a gzip file of one record, and the whole file is one valid stream.
    for path in (tmp_path / "w" / "crawl").glob("members-*.gz"):
        whole = gzip.decompress(path.read_bytes())
        n = len(list(warc.records(iter([whole]))))
        assert n == len((path.parent / (path.name + ".idx")).read_text().splitlines())
    assert not list((tmp_path / "w" / "crawl").glob("crawl-*"))
    assert warc.archive_pages(spark, pages.limit(0)).count() == 0


def test_one_stream_reader():
    record = warc.record("response", 1, "u", "d", 3, warc._HTTP + b"abc")
    one, many = gzip.compress(record * 5), gzip.compress(record) * 5
    for data in (one, many):
        assert len(list(warc.records(warc.inflated(io.BytesIO(data))))) == 5
    with pytest.raises(ValueError):
        list(warc.records(iter([record[:-30]])))
    with pytest.raises(ValueError):
        list(warc.records(iter([record + record[:40]])))


@pytest.mark.parametrize("name", ["op5_exact_dedup", "op7_warc_normalise", "op8_source_mixing"])
def test_sql(spark, name):
    problem = oracle.compare(entry_point.queries()[name](spark, SF_SMALL), oracle.connect(SF_SMALL), entry_point.oracle_sql()[name])
    assert problem is None, problem


CONTRACT = {
    "op1_minhash_near_dedup": {"doc_id", "n_shingles", "component_id", "kept"},
    "op2_html_main_text": {"page_id", "url", "text", "n_chars"},
    "op3_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op4_substring_dedup": {"doc_id", "n_words", "n_removed", "kept_sha256"},
    "op6_winnowing": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op9_best_fit_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op10_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
}


@pytest.mark.parametrize("name", CONTRACT)
def test_contract_columns(spark, name):
    out = entry_point.queries()[name](spark, SF_SMALL)
    assert CONTRACT[name] <= set(out.columns)
    assert out.count() >= (50 if "html" in name else 200)
