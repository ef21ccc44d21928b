"""Near-duplicate lines: short lines, blocks over batches, maps of many buckets."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cabmeter.llm import linededup, textops
from cabmeter.llm.repeats import hit_mask
from cabmeter.llm.tables import arrow_rows, written


def test_short_lines_fill_their_bins_at_once(monkeypatch):
    calls = []
    monkeypatch.setattr(linededup, "scramble", lambda *a: calls.append(1) or textops.scramble(*a))
    linededup.minhash(np.arange(1, 3, dtype=np.uint64) << np.uint64(62), np.arange(2), 2, 100)  # tables are made once
    del calls[:]
    rng = np.random.default_rng(3)
    shingles, owner = rng.integers(0, 2**64, 500, dtype=np.uint64), np.repeat(np.arange(100), 5)
    got = linededup.minhash(shingles, owner, 100, 100)
    assert len(calls) < 20
    place = ((shingles >> np.uint64(32)) * np.uint64(100) >> np.uint64(32)).astype(int)
    for row in range(0, 100, 9):
        least = {}
        for s, p in zip(shingles[owner == row], place[owner == row]):
            value = s << np.uint64(32) | s >> np.uint64(32)
            least[p] = min(least.get(p, value), value)
        for column in range(100):
            attempt, at = 0, column
            while at not in least:
                attempt += 1
                at = int(textops.scramble(np.array([column + 100 * attempt], np.uint64), 55)[0] % np.uint64(100))
            want = least[at] if not attempt else textops.scramble(np.array([least[at]], np.uint64), 56 + (attempt & 1023))[0]
            assert got[row, column] == want


def test_blocks_of_lines_reach_over_batches():
    texts = [f"line {i}\nthe same line" for i in range(30)] + [None, ""]
    columns = [pa.array(range(32), pa.int64()), pa.array(range(32), pa.int64()), pa.array(texts, pa.string())]
    batch = pa.RecordBatch.from_arrays(columns, ["id", "fingerprint", "text"])
    work = linededup._key_blocks(8, 20, 5)
    (ids, counts, keys, _), = work(batch.slice(lo, 4) for lo in range(0, 32, 4))
    (ids1, counts1, keys1, _), = work([batch])
    assert (ids == ids1).all() and (counts == counts1).all() and (keys == keys1).all() and counts.sum() == len(keys) == 1200
    assert not list(work([]))


def test_maps_of_many_buckets_are_made_together(monkeypatch):
    calls = []
    real = linededup.bit_maps
    monkeypatch.setattr(linededup, "bit_maps", lambda lines, size: calls.append(len(lines)) or real(lines, size))
    rows = [(k, 0, 0, 0, 2 * k + r, r, f"a line of the bucket {k}, told twice" + "." * r) for k in range(50) for r in (0, 1)]
    names = ["key", "i", "j", "side", "name", "comp", "body"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
    for most, n in ((1 << 20, 2), (1, 50)):
        monkeypatch.setattr(linededup, "MAP_CHARS", most)
        del calls[:]
        out = pa.Table.from_batches(linededup._cross(8, 80)([batch])).to_pylist()
        assert sorted((r["a"], r["b"]) for r in out) == [(2 * k, 2 * k + 1) for k in range(50)]
        assert len(calls) == n and sum(calls) == 100


def test_batches_are_small_while_lines_are_compared(spark, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(key)
    real = linededup.repeated_lines
    monkeypatch.setattr(linededup, "repeated_lines", lambda *a: seen.append(int(spark.conf.get(key))) or real(*a))
    docs = spark.createDataFrame([(1, "one line here\nanother"), (2, "one line here")], "doc_id long, text string")
    rows = {r.doc_id: r.text for r in linededup.line_dedup(docs).collect()}
    assert rows == {1: "one line here\nanother", 2: ""} and seen == [linededup.BATCH_ROWS]
    with pytest.raises(ZeroDivisionError), arrow_rows(spark, 7):
        assert spark.conf.get(key) == "7"
        1 / 0
    assert spark.conf.get(key) == before


def test_lines_are_taken_out_without_python(spark):
    docs = spark.createDataFrame([(1, "one line here\n\nanother\n", 7), (2, "One line here \nits own", 8), (3, None, 9), (4, "", 1), (None, "another", 2)],
                                 "doc_id long, text string, n int")
    out = linededup.line_dedup(docs)
    plan = out._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan and "MapInArrow" not in plan  # texts are not sent to Python workers once more
    assert "strategy=shuffle_hash" in plan  # nor sorted
    rows = {(r.n, r.doc_id): (r.text, r.removed_lines) for r in out.collect()}
    assert rows == {(7, 1): ("one line here\n\nanother\n", 0), (8, 2): ("its own", 1), (9, 3): (None, 0), (1, 4): ("", 0), (2, None): ("another", 0)}


def test_lines_by_number(spark):
    texts = ["a\nb\nc", "a", "", "\n", "x\r\n\ny\n\n", "".join(f"line {k}\n" for k in range(3000))]
    gone = [[1], [0], [0], [1, 0], [0, 4, 2], list(range(0, 3000, 2))]
    frame = spark.createDataFrame(list(enumerate(zip(texts, gone))), "n int, t struct<text: string, gone: array<int>>")
    got = {r.n: r.left for r in frame.select("n", linededup.without_lines(F.col("t.text"), F.col("t.gone")).alias("left")).collect()}
    for n, (text, numbers) in enumerate(zip(texts, gone)):
        assert got[n] == "\n".join(line for k, line in enumerate(text.split("\n")) if k not in numbers)


def test_shingles_of_small_buckets_are_made_together(monkeypatch):
    """Links join what brute force joins, whatever the width of maps and side."""
    calls = []
    real = linededup.char_shingles
    monkeypatch.setattr(linededup, "char_shingles", lambda lines, size: calls.append(1) or real(lines, size))
    rng = np.random.default_rng(8)
    rows = []
    for k in range(60):
        base = "".join(rng.choice(list("abcd "), int(rng.choice([20, 120, 400]))))
        for r in range(int(rng.integers(2, 9))):
            own = base[: int(rng.integers(len(base) * 3 // 4, len(base) + 1))]
            rows.append((k, 0, k % 2, int(rng.integers(0, 2)), len(rows), len(rows) - int(rng.integers(0, 2)), own))
    names = ["key", "i", "j", "side", "name", "comp", "body"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)

    def roots(links):
        root = {r[4]: (r[0], r[5]) for r in rows}
        for a, b in links:
            gone, stays = root[b], root[a]
            root = {k: stays if v == gone else v for k, v in root.items()}
        order = {}
        return [order.setdefault(root[r[4]], len(order)) for r in rows]

    brute = []
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[4] < b[4] and (a[2] == 0 or a[3] != b[3]):
                one, two = (set(r[6][c: c + 8] for c in range(max(len(r[6]) - 7, 1))) for r in (a, b))
                if 100 * len(one & two) >= 80 * len(one | two):
                    brute.append((a[4], b[4]))
    for small, words, most in ((64, 1 << 20, 1 << 20), (64, 1, 1 << 20), (4, 1 << 20, 300), (0, 1 << 20, 1 << 20)):
        monkeypatch.setattr(linededup, "SMALL_BUCKET", small)
        monkeypatch.setattr(linededup, "PAIR_WORDS", words)
        monkeypatch.setattr(linededup, "MAP_CHARS", most)
        del calls[:]
        links = [(r["a"], r["b"]) for r in pa.Table.from_batches(linededup._cross(8, 80)([batch])).to_pylist()]
        assert roots(links) == roots(brute) and 0 < len(links) < len(rows)
        if (small, words, most) == (64, 1 << 20, 1 << 20):
            assert len(calls) <= 4


def test_runs_by_doubling():
    values = textops.scramble(np.arange(50, dtype=np.uint64), 3)
    for n in (0, 1, 5, 8, 50):
        sums = textops.prefix_sums(values[:n])
        for size in (1, 2, 3, 5, 7, 8, 13):
            at = np.arange(max(n - size + 1, 0))
            assert (textops.run_hashes(values[:n], size) == textops.span_hash(sums, at, at + size)).all()


def test_band_keys_make_no_names_that_nobody_reads(monkeypatch):
    rng = np.random.default_rng(5)
    lines = ["".join(chr(c) for c in rng.integers(0x61, 0x7B if k % 7 else 0x2000, 8 + k)) for k in range(60)]
    weights = textops.scramble(np.arange(100, dtype=np.uint64), 57).reshape(20, 5) | np.uint64(1)
    for batch in (lines, ["ab", *lines, "c"], ["x"], ["\U0001F600" * 9, "y" * 300]):
        names, keys = linededup._band_keys(batch, 8, 20, 5)
        shingles, owner, _ = linededup.char_shingles(batch, 8)
        slots = linededup.minhash(shingles, owner, len(batch), 100).reshape(-1, 20, 5)
        plain = (slots * weights).sum(axis=2, dtype=np.uint64) + textops.scramble(np.arange(20, dtype=np.uint64), 58)
        assert (keys == textops.scramble(plain, 59)).all() and len(set(names.tolist())) == len(batch)
        assert (linededup._band_keys(batch, 8, 20, 5, named=False)[1] == keys).all()
    monkeypatch.setattr(linededup, "prefix_sums", None)  # only names and short lines need them
    assert len(linededup._band_keys(lines, 8, 20, 5, named=False)[1]) == len(lines)


def test_hits_as_a_mask():
    pairs = np.array([[0, 2], [5, 6], [9, 10]], np.int32)
    assert hit_mask(pairs.tobytes(), 10).tolist() == [True, True, False, False, False, True, False, False, False, True]
    assert hit_mask(None, 3).tolist() == [False] * 3 and hit_mask(b"", 0).tolist() == []


def test_pairs_of_lines_take_one_shuffle_of_their_keys(spark, monkeypatch):
    plans = {}

    def kept(df, name):
        plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
        return written(df, name)

    monkeypatch.setattr(linededup, "written", kept)
    base = "the quick brown fox jumps over the lazy dog near the river bank today"
    rows = [(k, base + " " + "abcdefgh"[k] * (k % 3)) for k in range(8)] + [(9, "quite another line of text with nothing alike"), (10, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["removed_lines"] for r in linededup.line_dedup(df).collect()}
    assert got == {k: int(0 < k < 8) for k in (*range(9), 10) if k != 8} | {9: 0}
    assert "Join" not in plans["shared"] and plans["shared"].count("Window") == 1
