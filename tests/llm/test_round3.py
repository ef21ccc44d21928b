"""Source divergence, spelling variants and Lempel-Ziv prints on small messy
tables, against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, word string, n long, bucket int, term string, p long, key int"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 1, 2, "w", 3, 4, "t", 5, 6) for i, t, lang, s in rows], DOCS)


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def _messy(n=60, seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(4, 7))) for _ in range(60)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 5, 40, 80]))]
        for k in range(len(words)):
            if rng.random() < 0.1:
                words[k] = words[k].upper()
        rows.append((i, rng.choice([" ", ", ", "\n", "×1"]).join(words), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "é", None, "z9"])))
    rows += [rows[3], (None, "abcde abcde abcde abcdf", "en", "s1"), (100, None, "xx", "only"), (101, "", None, None), (102, "q" * 3000 + " " + "q" * 3000, "en", "s2"),
             (103, "ü 中文 naïve naïve ßß İI", "en", "s2")]
    return rows


# Divergence -----------------------------------------------------------------

def _divergence(rows, least, top):
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", _lower(text))
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in held[lang].items() if d >= least]
        sources = [s for g, s in groups if g == lang]
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def rates(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}

        q = rates(whole)
        for s in sources:
            p = rates(counts[lang, s])
            pairs = [(sum(abs(p[t] - r[t]) for t in kept), o) for o in sources if o != s for r in [rates(counts[lang, o])]]
            terms = [(p[t] - q[t], t) for t in kept if counts[lang, s][t] and p[t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(items) if part == "pair" or k < top]
    return Counter(out)


@pytest.mark.parametrize("least,top", [(1, 5), (4, 50), (10_000, 3)])
def test_divergence(spark, least, top):
    from cabmeter.llm.divergence import source_divergence

    rows = _messy()
    got = source_divergence(_docs(spark, rows), least, top).collect()
    assert Counter(tuple(r) for r in got) == _divergence(rows, least, top)


def test_divergence_in_tiles(spark, monkeypatch):
    """Several source blocks and term buckets, chunks of a few documents."""
    from cabmeter.llm import divergence

    monkeypatch.setattr(divergence, "TILE_SOURCES", 2)
    monkeypatch.setattr(divergence, "TILE_CELLS", 64)
    monkeypatch.setattr(divergence, "CHUNK_BYTES", 100)
    rows = _messy(seed=4)
    got = divergence.source_divergence(_docs(spark, rows), 2, 4).collect()
    assert Counter(tuple(r) for r in got) == _divergence(rows, 2, 4)


@pytest.mark.parametrize("k", [1, 3, 50])
def test_skyband_by_brute_force(k):
    from cabmeter.llm.divergence import skyband

    rng = np.random.default_rng(k)
    high, low, name = rng.integers(0, 40, 1500), rng.integers(0, 60, 1500), rng.permutation(1500)
    beaten = ((high[None] >= high[:, None]) & (low[None] <= low[:, None]) & (name[None] < name[:, None])).sum(axis=1)
    assert sorted(skyband(high, low, name, k)) == list(np.flatnonzero(beaten < k))


def test_divergence_of_nothing(spark):
    from cabmeter.llm.divergence import source_divergence

    assert source_divergence(_docs(spark, []), 1, 5).collect() == []


# Spelling -------------------------------------------------------------------

def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _variants(rows, least, times, every):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = _lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least and c >= times}
    near = defaultdict(list)
    for a, b in itertools.combinations(n, 2):
        if _near(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return Counter((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


@pytest.mark.parametrize("every,symbols", [(3, None), (97, 4), (0, 9)])
def test_spelling(spark, every, symbols):
    from cabmeter.llm.spelling import spelling_variants

    rows = _messy(80, seed=7) + [(200, "chain " * 50 + "chein " * 20 + "cheinn " * 9 + "cheinnn " * 4 + "÷eéàÿ éeéàÿ " * 3, "en", "s")]
    got = spelling_variants(_docs(spark, rows), least=4, times=2, every=every, symbols=symbols).collect()
    expected = _variants(rows, 4, 2, every)
    assert Counter(tuple(r) for r in got) == expected
    assert any(form for _, form, *_ in expected)


def test_neighbourhoods_hold_every_edit():
    from cabmeter.llm.spelling import _reduced_keys, neighbourhoods

    rng = random.Random(5)
    words = list({"".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7))) for _ in range(400)})
    for symbols in (2, 5):
        own = _reduced_keys(words, symbols)[-1]
        lists = defaultdict(set)
        for w, key in zip(*neighbourhoods(words, symbols)):
            lists[int(w)].add(int(key))
        for a, b in itertools.combinations(range(len(words)), 2):
            if _near(words[a], words[b]):
                assert int(own[b]) in lists[a] or int(own[a]) in lists[b]


def test_run_crcs():
    from cabmeter.llm.spelling import run_crcs

    runs = ["a", "é", "aé÷z", "x" * 64, "yé" * 200]
    data = np.frombuffer("".join(runs).encode("latin-1"), np.uint8)
    ends = np.cumsum([len(r) for r in runs])
    seeds = np.array([zlib.crc32(b"%d:" % k) for k in range(len(runs))], np.uint32)
    got = run_crcs(data, ends - [len(r) for r in runs], ends, seeds)
    assert got.tolist() == [zlib.crc32(f"{k}:{r}".encode()) for k, r in enumerate(runs)]


def test_spelling_of_nothing(spark):
    from cabmeter.llm.spelling import spelling_variants

    assert spelling_variants(_docs(spark, [])).collect() == []
    assert spelling_variants(_docs(spark, [(1, None, None, None), (2, "", "", "")])).collect() == []
    with pytest.raises(ValueError):
        spelling_variants(_docs(spark, []), factor=1)


# Lempel-Ziv prints ----------------------------------------------------------

def _phrases(data):
    seen, w = set(), b""
    for k in range(len(data)):
        w += data[k:k + 1]
        if w not in seen:
            seen.add(w)
            w = b""
    return seen


def _check_prints(spark, rows, keep):
    from cabmeter.llm.lzprint import neighbour_prints

    got = {r.id: r for r in neighbour_prints(_docs(spark, rows), keep=keep).collect()}
    order = sorted(((r[0], r[1] or "") for r in rows if r[0] is not None), reverse=True) + [(None, r[1] or "") for r in rows if r[0] is None]
    assert len(got) == len(order)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other, following = (_phrases(t.encode()) for t in (text, edited, after))
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for near, two in ((got[i].near_edited, other), (got[i].near_next, following)):
            exact = len(own & two) / len(own | two) if own | two else 1.0
            assert near == pytest.approx(exact) if len(own | two) <= keep else 0 <= near <= 1
            assert abs(near - exact) < 4 * 0.5 / keep**0.5
    prints = defaultdict(set)
    for i, text in order:
        prints[text].add(got[i].fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert len({next(iter(p)) for t, p in prints.items() if len(t) > 40}) == len([t for t in prints if len(t) > 40])


@pytest.mark.parametrize("keep", [16, 128, 4096])
def test_prints(spark, keep):
    rows = list({r[0]: r for r in _messy(70, seed=9)}.values())
    rows += [(300, rows[5][1], None, None), (-7, "x" * 20_000, None, None), (301, "\U0001F600é" * 9, None, None)]
    _check_prints(spark, rows, keep)


def test_prints_in_small_chunks(spark, monkeypatch):
    from cabmeter.llm import lzprint

    monkeypatch.setattr(lzprint, "CHUNK_BYTES", 64)
    _check_prints(spark, list({r[0]: r for r in _messy(40, seed=2)}.values()), 64)


def test_prints_of_few(spark):
    from cabmeter.llm.lzprint import neighbour_prints

    assert neighbour_prints(_docs(spark, [])).collect() == []
    one = neighbour_prints(_docs(spark, [(5, "abab", None, None)])).first()
    assert (one.edited_sha256, one.near_next) == (hashlib.sha256(b"abab").hexdigest(), 1.0)
    none = neighbour_prints(_docs(spark, [(5, None, None, None), (6, "", None, None)])).collect()
    assert [(r.n_chars, r.fingerprint, r.near_edited, r.near_next) for r in none] == [(0, "", 1.0, 1.0)] * 2
    # Rows that repeat an id, or everything, each get a row.
    again = neighbour_prints(_docs(spark, [(5, "abc", None, None), (5, "abc", None, None), (5, "xyz", None, None), (None, "abc", None, None)])).collect()
    assert sorted((r.id or 0, r.n_chars) for r in again) == [(0, 3), (5, 3), (5, 3), (5, 3)]


# Repeated ids, deployment ---------------------------------------------------

def test_minhash_of_ids_with_two_texts(spark):
    """Texts that share an id are one document, and link what each is like."""
    from cabmeter.llm.minhash import minhash_components

    rng = random.Random(6)
    a, b, c = (" ".join(f"w{rng.randrange(999)}" for _ in range(60)) for _ in range(3))
    rows = [(0, a, None, None), (1, a, None, None), (1, b, None, None), (2, b, None, None), (3, c, None, None), (3, c + " more", None, None), (4, "one", None, None)]
    got = minhash_components(_docs(spark, rows), shingle=2).collect()
    assert {(r.id, r.component) for r in got} == {(0, 0), (1, 0), (2, 0), (3, 3), (4, 4)}
    assert len(got) == len(rows)


DEPLOYED = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {folder!r}).getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as entry
for name, query in entry.queries().items():
    if name.startswith("op"):
        print("RAN", name, query(spark, {tables!r}).count(), flush=True)
"""


def test_all_operators_run_where_executors_lack_the_package(tmp_path):
    import os
    import subprocess
    import sys

    import __spark_entry__ as entry
    from conftest import SF001

    repo = os.path.dirname(os.path.abspath(entry.__file__))
    script = DEPLOYED.format(repo=repo, folder=str(tmp_path / "shared"), tables=SF001)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    names = {line.split()[1] for line in done.stdout.splitlines() if line.startswith("RAN")}
    assert names == {n for n in entry.queries() if n.startswith("op")}, done.stderr[-3000:]


# Personal data ----------------------------------------------------------------

def test_pii_places_and_context_of_crowded_texts(spark):
    from cabmeter.llm.pii import CONTEXT, CONTEXT_CHARS, SCORES, detect_pii

    rng = random.Random(5)
    parts = ["a@b.c", "mail me@x.org", "+49 30 123456789", "1.2.3.4", "999.1.1.1", "host 10.0.0.1", "visa 4111111111111111",
             "4111 1111 1111 1112", "iban DE89370400440532013000", "123-45-6789", "ssn", "\n", "𝄞", "é", "@", ".", "+"]
    rows = [(i, "".join(rng.choice(parts) + rng.choice(["", " ", ","]) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    found = detect_pii(spark.createDataFrame(rows + [(900, None), (901, "")], "doc_id long, text string")).collect()
    assert sum(len(r.pii) for r in found) > 1000
    for r in found:
        for s in r.pii:
            assert r.text[s.start:s.end] == s.value
            before = r.text[max(s.start - CONTEXT_CHARS, 0): s.start]
            near = re.search(CONTEXT[s.kind], before)
            assert s.score == round(SCORES[s.kind] + (0.2 if near else 0), 2)
        assert [s.start for s in r.pii] == sorted(s.start for s in r.pii)
        mails = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r.text or "")]
        assert [(s.start, s.end) for s in r.pii if s.kind == "email"] == mails


def test_pii_of_one_text_with_many_matches(spark):
    from pyspark.sql import functions as F

    from cabmeter.llm.pii import detect_pii

    n = 50_000
    text = "".join(f"call +49 30 {i:07d}\n" for i in range(n))
    got = detect_pii(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    row = got.select(F.size("pii").alias("n"), F.element_at("pii", -1)["start"].alias("at")).first()
    assert (row.n, row.at) == (n, 20 * (n - 1) + 5)


def test_running_sums(spark):
    from pyspark.sql import functions as F

    from cabmeter.llm.pii import running_sums

    for n in (0, 1, 2, 3, 7, 8, 9, 100):
        numbers = spark.range(1).select(F.transform(F.slice(F.sequence(F.lit(1), F.lit(200)), F.lit(1), F.lit(n)), lambda v: (v * 7 % 11).cast("int")).alias("v"))
        row = numbers.select("v", running_sums(F.col("v")).alias("s")).first()
        assert row.s == list(itertools.accumulate(row.v))


def test_pii_of_an_empty_table(spark):
    from cabmeter.llm.pii import detect_pii

    assert detect_pii(_docs(spark, [])).count() == 0


# Lines ------------------------------------------------------------------------

@pytest.mark.parametrize("block", [1, 3, 100])
def test_block_pairs_meet_whatever_is_not_joined(spark, block):
    from cabmeter.llm.linededup import block_pairs

    rng = random.Random(block)
    members = [(key, 100 * key + i, size, rng.choice([1, 1, 1, 1, 2, 3, i + 10])) for key, size in ((1, 3), (2, 12), (3, 30)) for i in range(size)]
    members += [(4, 400 + i, 40, 7 if i else 8) for i in range(40)]
    rows = block_pairs(spark.createDataFrame(members, "key long, name long, size long, comp long"), block).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r.key, r.i, r.j].append(r)
    met = Counter()
    for (key, i, j), held in groups.items():
        for a, b in itertools.combinations(held, 2):
            if (i == j or a.side != b.side) and a.comp != b.comp:
                met[key, *sorted((a.name, b.name))] += 1
    expected = {(a[0], *sorted((a[1], b[1]))) for a, b in itertools.combinations(members, 2) if a[0] == b[0] and a[3] != b[3]}
    assert set(met) == expected and set(met.values()) <= {1}
    if block == 3:  # one member outside the main component: 39 rows and one for each of their blocks
        assert sum(r.key == 4 for r in rows) <= 39 + 13 + 1


def test_lines_in_small_blocks_are_those_of_brute_force(spark, monkeypatch):
    from cabmeter.llm import linededup

    rng = random.Random(11)
    base = "".join(rng.choice("abcdefghij ") for _ in range(150))
    lines = []
    for k in range(60):
        line = list(base)
        for _ in range(k % 4):
            line[rng.randrange(len(line))] = rng.choice("xyz")
        lines.append("".join(line))
    lines += ["".join(rng.choice("klmnop ") for _ in range(150)).strip() for _ in range(5)]
    rows = [(i, "\n".join(rng.sample(lines, 6)) + "\n\nÄ\n") for i in range(20)]
    rows += [(30, None), (31, ""), rows[4], (None, lines[0])]

    def shingles(line):
        return {line[i: i + 8] for i in range(max(len(line) - 7, 1))}

    spots = sorted({(i, n, line.strip().lower()) for i, text in rows if i is not None for n, line in enumerate((text or "").split("\n")) if line.strip()})
    sets = {line: shingles(line) for _, _, line in spots}
    root = {line: line for line in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root[top(a)] = top(b)
    first = {}
    for i, n, line in spots:
        first.setdefault(top(line), (i, n))
    gone = Counter(i for i, n, line in spots if first[top(line)] != (i, n))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (2, 1024):
        monkeypatch.setattr(linededup, "BLOCK", block)
        got = linededup.line_dedup(docs).collect()
        assert len(got) == len(rows)
        assert {(r.doc_id, r.removed_lines) for r in got if r.doc_id is not None} == {(i, gone[i]) for i, _ in rows if i is not None}


def test_merged_sketches_never_under_the_count():
    from cabmeter.llm.substringdedup import estimated_repeats, merged_sketch, partial_sketch, section_of

    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**64, 400, dtype=np.uint64)
    parts = [np.concatenate([rng.choice(pool, n), rng.integers(0, 2**64, n, dtype=np.uint64)]) for n in (0, 1, 60, 300, 2000)]
    counts = Counter(np.concatenate(parts).tolist())
    for sections, bits in ((1, 4), (3, 10), (7, 12)):
        sent = [partial_sketch(p, sections, bits) for p in parts]
        answers = [{} for _ in parts]
        for s in range(sections):
            holders = [k for k, bodies in enumerate(sent) if s in bodies]
            for k, body in zip(holders, merged_sketch([sent[k][s] for k in holders], bits)):
                answers[k][s] = body
        for p, answer in zip(parts, answers):
            maybe = estimated_repeats(p, sections, bits, answer)
            assert all(m for key, m in zip(p.tolist(), maybe.tolist()) if counts[key] > 1)
            if bits == 12 and len(p) > 1000:
                assert not maybe[[counts[key] == 1 for key in p.tolist()]].all()
    keys = np.sort(parts[-1])
    assert (np.diff(section_of(keys, 7)) >= 0).all() and set(section_of(keys, 7).tolist()) == set(range(7))


@pytest.mark.parametrize("block_bytes, section_bytes", [(64, 128), (1 << 20, 1 << 20)])
def test_substrings_over_many_blocks(spark, block_bytes, section_bytes):
    from cabmeter.llm.substringdedup import substring_dedup

    rng = random.Random(8)
    words, size = ["a", "b", "é", "longer"], 4
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(60)] + [None, "", " \t\n", "solo one two three four five"]
    rows = list(enumerate(texts)) + [(3, texts[3]), (3, texts[4]), (None, texts[5]), (None, "a b a b a b a b")]
    seen = Counter(tuple(t.split()[k:k + size]) for i, t in rows if i is not None and t for k in range(len(t.split()) - size + 1))
    expected = []
    for i, t in rows:
        w = (t or "").split()
        gone = {k + j for k in range(len(w) - size + 1) if i is not None and seen[tuple(w[k:k + size])] > 1 for j in range(size)}
        expected.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, block int, id string").repartition(3)
    got = [tuple(r) for r in substring_dedup(df, size, block_bytes=block_bytes, section_bytes=section_bytes).collect()]
    assert Counter(got) == Counter(expected)
