"""Every training-data operator on small messy tables, against brute force.

The tables hold nulls in any column, empty, blank and long texts, ties,
repeated rows, and columns whose names the operators use themselves.
"""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

LINE = ("shared line of the corpus here, long enough that one more ch"
        "aracter leaves most of its shingles as they were before that")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, hits string, key int"


def _texts():
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def words(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    base, passage = words(120), words(60)
    near = base.split()
    near[60] = "changed"
    texts = [base, base, " ".join(near), words(100) + "\n" + passage + "\n" + words(80), words(50) + "\n" + passage,
             None, "", " \n\t ", "one", "one", "One two", "x" * 5000, "y z " * 900, words(30), words(5000),
             "mail a@b.org or c.d@e-f.com, call +1 (234) 555-0199, card 4111 1111 1111 1111, ip 10.0.0.256 10.0.0.25 é 192.168.1.1",
             "IBAN DE89 3704 0044 0532 0130 00 ssn 123-45-6789 no 987-65-4321", words(40) + "\n" + LINE + "\n" + words(9),
             words(41) + "\n" + LINE.capitalize() + " \n" + words(9), words(42) + "\n" + LINE.replace("most", "mostly") + "\n" + words(9)]
    return texts, passage


@pytest.fixture(scope="module")
def docs(spark):
    texts, _ = _texts()
    rows = [(i, t, "en" if i % 3 else None, None, None, 7, "h", 1) for i, t in enumerate(texts)]
    rows += [rows[0], (None, texts[0], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def _rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def _same(got, expected):
    assert collections.Counter(got) == collections.Counter(expected)


@pytest.mark.parametrize("size", [2, 5])
def test_minhash(docs, size):
    from cabmeter.llm.minhash import minhash_components, minhash_dedup

    sets = {}
    for i, t in _rows(docs):
        w = t.encode().lower().split()
        sets[i] = frozenset(tuple(w[k:k + size]) for k in range(max(len(w) - size + 1, min(len(w), 1))))
    root = {i: i for i in sets if i is not None}
    for _ in root:
        for a in root:
            for b in root:
                both = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    root[a] = min(root[a], root[b])
    got = minhash_components(docs, shingle=size).collect()
    _same([(r.id, r.n_shingles, r.component, r.kept) for r in got if r.id is not None],
          [(i, len(sets[i]), root[i], root[i] == i) for i, _ in _rows(docs) if i is not None])
    assert [(r.component, r.kept) for r in got if r.id is None] == [(None, True)] * 2
    kept = minhash_dedup(docs, shingle=size)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in root if root[i] == i} | {None}


def test_superminhash_estimates_jaccard():
    from cabmeter.llm.minhash import superminhash

    a, b = np.arange(1000, dtype=np.uint64), np.arange(200, 1200, dtype=np.uint64)
    rng = np.random.default_rng(1)
    scale = np.uint64(rng.integers(1, 2**62) | 1)
    sig = superminhash(np.concatenate((a, b)) * scale, np.repeat([0, 1], 1000), 2, 240)
    assert abs((sig[0] == sig[1]).mean() - 800 / 1200) < 0.1
    assert (superminhash(np.zeros(0, np.uint64), np.zeros(0, np.int64), 1, 4) == np.iinfo(np.uint64).max).all()


def test_projection_forest(spark):
    from cabmeter.llm.rpforest import embedding_components

    rng = np.random.default_rng(2)
    centers = rng.standard_normal((40, 16))
    vectors = np.concatenate([c + 0.08 * rng.standard_normal((rng.integers(1, 60), 16)) for c in centers])
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)]
    n = len(rows)
    rows += [(n, rows[3][1], 2), (n + 1, None, 1), (n + 2, [], 1), (n + 3, [0.0] * 16, 1), (n + 4, [float("nan")] * 16, 1),
             (n + 5, [None] * 16, 1), (n + 6, [1.0, 2.0], 1), (n + 7, [2.0, 4.0], 1), (None, rows[3][1], 1), rows[0]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, leaf int")
    clean = {i: np.array(v) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    links = collections.defaultdict(set)
    for a in clean:
        for b in clean:
            if a != b and len(clean[a]) == len(clean[b]) and clean[a] @ clean[b] / np.linalg.norm(clean[a]) / np.linalg.norm(clean[b]) >= 0.9:
                links[a].add(b)
    got = {r.id: r for r in embedding_components(df, leaf=32).collect() if r.id is not None}
    assert sum(r.n_links for r in got.values()) >= 0.99 * sum(map(len, links.values()))
    assert all(r.n_links <= len(links[i]) for i, r in got.items())
    assert got[n].component == 3 or got[n].component < 3
    assert got[n + 7].component == n + 6 and all(got[n + k].n_links == 0 for k in (1, 2, 3, 4, 5))


def test_projection_forest_crowd(spark):
    """A crowd of near copies much larger than a leaf, with equal ones in it, keeps all its links."""
    from cabmeter.llm.rpforest import embedding_components

    rng = np.random.default_rng(5)
    crowd = rng.standard_normal(64) + 0.12 * rng.standard_normal((1500, 64))
    vectors = np.concatenate((crowd, crowd[:40], np.repeat(crowd[:1], 300, axis=0), rng.standard_normal((1500, 64))))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.98
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r.id: r for r in embedding_components(df, least=0.98).collect()}
    links = near.sum(axis=1) - 1
    assert len(got) == len(vectors) and all(r.n_links <= links[i] for i, r in got.items())
    assert sum(r.n_links for r in got.values()) >= 0.999 * links.sum()
    assert all(got[i].component == got[i - 1500].component for i in range(1500, 1540))


def test_warc_round_trip(spark):
    from cabmeter.llm.warc import iterate_archive, payload_digest, read_archives, write_archives

    pages = [(1, "http://a/ \r\nX: y", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", "é" * 300000), (None, "u", "same"), (7, "v", "other"), (7, "v", "other")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("sha", F.lit("clash"))
    archives = write_archives(df, archive_bytes=2000)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read_archives(archives).collect()]
    last = {"same": 2, "": 4}

    def expected(i, html):
        raw = (html or "").encode()
        to = last.get(html or "")
        revisit = i is not None and to is not None and i < to
        return i, len(raw), payload_digest(raw), "revisit" if revisit else "response", to if revisit else None

    _same(got, [expected(i, h) for i, _, h in pages])
    first = bytes(archives.first().content)
    assert first[:4] == bytes([0x5D, 0x2A, 0x4D, 0x18]) and len(list(iterate_archive(first))) >= 1
    assert read_archives(write_archives(df.limit(0))).count() == 0


def test_pii(docs):
    from cabmeter.llm.pii import detect_pii

    found = {r.doc_id: [(s.kind, s.value) for s in r.pii] for r in detect_pii(docs).collect() if r.doc_id is not None}
    assert found[15] == [("email", "a@b.org"), ("email", "c.d@e-f.com"), ("phone", "+1 (234) 555-0199"), ("card", "4111 1111 1111 1111"),
                         ("ip", "10.0.0.25"), ("ip", "192.168.1.1")]
    assert found[16] == [("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "123-45-6789"), ("ssn", "987-65-4321")]
    texts, _ = _texts()
    for r in detect_pii(docs.where("doc_id in (15, 16)")).collect():
        assert all(r.text[s.start:s.end] == s.value for s in r.pii)
    assert set(docs.columns) <= set(detect_pii(docs).columns) and found[5] == found[6] == []


def test_fuzzy_lines(docs):
    from cabmeter.llm.linededup import line_dedup

    out = line_dedup(docs)
    assert set(docs.columns) <= set(out.columns)
    got = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    texts, _ = _texts()
    assert got[17].text == texts[17] and got[18].text.count("\n") == 1 and got[19].text.count("\n") == 1
    assert got[1].text == "" and got[2].text == "" and got[0].text == texts[0]
    assert got[5].text is None and got[7].text == texts[7] and got[8].text == "one" and got[9].text == ""
    assert [r.text for r in out.where("doc_id is null").collect()] in ([texts[0], None], [None, texts[0]])


def test_packing(docs):
    from cabmeter.llm.packing import pack_documents
    from cabmeter.llm.queries import tokenizer_path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = collections.defaultdict(list)
    for i, t in _rows(docs):
        ids[i].append(tokenizer.encode(t, add_special_tokens=False).ids + [0])
    got = pack_documents(docs, tokenizer_path(), size=256).collect()
    spans = collections.defaultdict(list)
    for r in got:
        assert r.ids_crc32 in [zlib.crc32(np.array(x[r.start: r.start + r.length], "<u4").tobytes()) for x in ids[r.id]]
        spans[r.sequence_id].append((r.offset, r.length))
    total = sum(len(x) for xs in ids.values() for x in xs)
    assert sum(r.length for r in got) == total and len(spans) <= -(-total // 256) + 2
    for pieces in spans.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256


@pytest.mark.parametrize("crowd", [1024, 1])
def test_suffix_dedup(docs, crowd):
    from cabmeter.llm.suffixdedup import suffix_dedup

    rows, size = _rows(docs), 60
    named = [t.encode() for i, t in rows if i is not None]
    seen = collections.Counter(b[k:k + size] for b in named for k in range(len(b) - size + 1))
    expected = []
    for i, t in rows:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - size + 1) if i is not None else ():
            if seen[b[k:k + size]] > 1:
                gone[k:k + size] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        expected.append((i, len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    _same([(r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup(docs, size=size, gram=20, crowd=crowd).collect()], expected)


def test_two_stage_sorting():
    from cabmeter.llm.suffixsort import common_prefixes, suffix_order

    rng = random.Random(1)
    for _ in range(200):
        text = bytes(rng.randrange(rng.choice([1, 2, 26])) + 97 for _ in range(rng.randint(1, 200)))
        text, depth = text + text[: rng.randint(0, len(text))], rng.choice([3, 8, 20])
        wanted = np.array([rng.random() < 0.6 for _ in text])
        order, words = suffix_order(np.frombuffer(text, np.uint8), wanted, depth)
        assert sorted(order.tolist()) == np.flatnonzero(wanted).tolist()
        assert [text[p:p + depth] for p in order] == sorted(text[p:p + depth] for p in order)
        inside = order[order + depth <= len(text)]
        for (a, b), n in zip(zip(inside, inside[1:]), common_prefixes(words, inside, depth)):
            assert text[a:a + n] == text[b:b + n] and (n == depth or text[a + n] != text[b + n])


def test_substring_dedup(docs):
    from cabmeter.llm.substringdedup import sketch_repeats, substring_dedup

    rows, size = [(i, t.encode().split()) for i, t in _rows(docs)], 12
    seen = collections.Counter(tuple(w[k:k + size]) for i, w in rows if i is not None for k in range(len(w) - size + 1))
    expected = []
    for i, w in rows:
        gone = set()
        for k in range(len(w) - size + 1) if i is not None else ():
            if seen[tuple(w[k:k + size])] > 1:
                gone.update(range(k, k + size))
        expected.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    _same([(r.id, r.n_words, r.n_removed, r.kept) for r in substring_dedup(docs, size=size).collect()], expected)
    keys = np.array([5, 9, 5, 7], np.uint64)
    assert sketch_repeats(keys, None, 4, False)[[0, 2]].all()


def test_decontamination(spark, docs):
    from cabmeter.llm.decontam import contaminated, decontaminate

    _, passage = _texts()
    items = spark.createDataFrame([(1, passage.upper()), (2, "nothing of this is there at all"), (3, None), (4, ""), (None, "zz"), (5, "one two")], "item_id long, text string")
    got = {r.id: (r.n_items, r.best_item) for r in contaminated(docs, items).collect() if r.id is not None}
    assert {i for i, r in got.items() if r[0]} == {3, 4, 10} and got[3] == (1, 1) and got[10] == (1, 5)
    kept = decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    assert contaminated(docs, items.limit(0)).where("contaminated").count() == 0


def test_decontamination_by_short_items(spark):
    """Items of one to four words are found inside longer documents, as whole runs of words only."""
    from cabmeter.llm.decontam import contaminated

    texts = ["a b c d e f g one two h", "one two", "x one two", "one. TWO", "two one a b c d e f", "one x two y z a b c", "p q r s t u lone", "lone", None, "a b c d e f g h"]
    items = [(1, "One two"), (2, "lone"), (3, "p q r s"), (4, "d e f g one two h"), (5, "e f g")]
    expected = []
    for text in texts:
        w = (text or "").lower().replace(".", "").split()
        found = [i for i, t in items for k in [t.lower().split()] if len(k) < 5 and any(w[p:p + len(k)] == k for p in range(len(w)))]
        expected.append(len(found) + (text == texts[0]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.n_items for r in contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == expected


def test_toxicity(spark):
    from cabmeter.llm.toxicity import fit_toxicity, score_toxicity

    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]

    def text(toxic):
        out = [rng.choice(words) for _ in range(rng.randint(1, 60))]
        if toxic:
            out.insert(rng.randrange(len(out) + 1), "zorgh" + rng.choice(["", "en", "ly", "s"]))
        return " ".join(out)

    marks = [int(rng.random() < 0.3) for _ in range(600)]
    rows = [(i, text(m), "en") for i, m in enumerate(marks)] + [(1000, None, None), (1001, "", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, m) for i, m in enumerate(marks)] + [(None, 1, 1), (1000, 1, None)], "doc_id long, quality int, toxic int")
    out = score_toxicity(docs, fit_toxicity(docs, labels)).collect()
    held = [(r.score >= 0.3, marks[r.doc_id]) for r in out if r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(bool(a) == bool(b) for a, b in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.rejected is not None for r in out)
    assert score_toxicity(docs, fit_toxicity(docs, labels.limit(0))).where("rejected").count() == 0


def test_empty_tables(docs):
    from cabmeter.llm import linededup, minhash, packing, queries, suffixdedup, substringdedup

    none = docs.limit(0)
    assert minhash.minhash_components(none).count() == suffixdedup.suffix_dedup(none).count() == 0
    assert substringdedup.substring_dedup(none).count() == linededup.line_dedup(none).count() == 0
    assert packing.pack_documents(none, queries.tokenizer_path()).count() == 0


def test_digest_helper():
    from cabmeter.llm.warc import payload_digest

    assert payload_digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ" and len(hashlib.sha1(b"").digest()) == 20
