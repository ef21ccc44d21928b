"""Spelling variants: words of a corpus that one edit makes another word.

Letters are hashed to a few symbols, which turns words into reduced words.
One edit of a word is at most one edit of its reduced word, so the one-edit
neighbourhood of the reduced word (itself, every deletion, insertion and
replacement by a symbol) holds the reduced form of every near word.  With so
few symbols the neighbourhood can be written out; it is joined with the
reduced vocabulary, and the original strings confirm each candidate.

An edit can be undone, so one word of a pair need list the other, not both:
the longer one lists the shorter as a deletion, and of two reduced words with
one other symbol that with the lesser one lists the replacement.  Together the
lists are the full neighbourhoods, with a quarter of the keys.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.tables import drop_written, written
from cabmeter.llm.textops import longs, lower_ascii, prefix_sums, row_chunks, scramble, span_hash, utf8, word_spans
from cabmeter.llm.textops import _powers as powers

CHUNK_BYTES = 4 << 20
#: Letters of the words whose neighbourhoods are made at once.
CHUNK_LETTERS = 1 << 15
LONG_RUN = 64
#: In Latin-1: all bytes but A-Z, a-z and those from U+00C0.
NOT_LETTERS = bytes(c for c in range(256) if not (c >= 0xC0 or c < 128 and chr(c).isalpha()))


def latin(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 rows with U+00C0 to U+00FF as one byte each, ASCII as it is and
    zeros for all else."""
    lead = data == 0xC3
    out = np.where(data < 128, data, 0).astype(np.uint8)
    place = np.flatnonzero(lead)
    out[place] = data[place + 1] + 0x40
    stays = np.ones(len(data) + 1, np.int64)
    stays[place + 1] = 0
    return out[stays[:-1].astype(bool)], np.concatenate(([0], np.cumsum(stays[:-1])))[offsets]


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


def run_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """CRC-32 of the UTF-8 form of Latin-1 runs, each carried on from a seed.
    One byte of all runs at a time; the few long runs singly."""
    table = _crc_table()
    length = ends - starts
    crc = ~seeds.astype(np.uint32)

    def fed(state, values):
        return table[(state ^ values) & np.uint32(255)] ^ (state >> np.uint32(8))

    live = np.flatnonzero((length > 0) & (length <= LONG_RUN))
    step = 0
    while len(live):
        byte, state = data[starts[live] + step].astype(np.uint32), crc[live]
        wide = byte >= 0xC0
        if wide.any():
            state[wide] = fed(state[wide], np.uint32(0xC3))
            byte[wide] -= np.uint32(0x40)
        crc[live] = fed(state, byte)
        step += 1
        live = live[length[live] > step]
    crc = ~crc
    for i in np.flatnonzero(length > LONG_RUN):
        crc[i] = zlib.crc32(data[starts[i]: ends[i]].tobytes().decode("latin-1").encode(), int(seeds[i]))
    return crc


def _counted(least: int, every: int):
    """From batches (id, text): the words of each chunk and their counts."""
    def work(batches):
        import pyarrow as pa

        for batch in batches:
            ids = batch.column(0).to_pylist()
            seeds = np.array([zlib.crc32(b"%s:" % (b"" if i is None else str(i).encode())) for i in ids], np.uint32)
            data, offsets = utf8(batch.column(1))
            for lo, hi in row_chunks(offsets, CHUNK_BYTES):
                part, edges = latin(lower_ascii(data[offsets[lo]: offsets[hi]]), offsets[lo: hi + 1] - offsets[lo])
                starts, ends, first = word_spans(part, edges, NOT_LETTERS)
                if not len(starts):
                    continue
                solid = np.zeros(len(part) + 1, np.int8)
                solid[starts] = 1
                solid[ends] -= 1
                solid = np.cumsum(solid[:-1]).astype(bool)
                length = ends - starts
                if every:
                    crc = run_crcs(part, starts, ends, np.repeat(seeds[lo:hi], np.diff(first))).astype(np.int64)
                    cut = np.flatnonzero(crc % every == 0)
                    solid[starts[cut] + crc[cut] % length[cut]] = False
                    length[cut] -= 1
                short = np.flatnonzero(length < least)
                shadow = np.zeros(len(part) + 1, np.int8)
                shadow[starts[short]] = 1
                shadow[ends[short]] -= 1
                solid &= ~np.cumsum(shadow[:-1]).astype(bool)
                cuts = np.concatenate(([0], np.cumsum(length[length >= least]))).astype(np.int64)
                words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(part[solid].tobytes())])
                counts = words.value_counts()
                yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts.field(0).to_pylist()], pa.string()), counts.field(1)], ["word", "n"])

    return work


def vocabulary(docs: DataFrame, least: int = 5, times: int = 3, every: int = 97) -> DataFrame:
    """``(word, n)`` of a frame (id, text): the words of at least ``least``
    code points that occur at least ``times`` times."""
    return (docs.mapInArrow(_counted(least, every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= times))


def _symbols(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """All words' letters as symbols, and where each word starts."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    return (scramble(points, 71) % np.uint64(symbols)).astype(np.int64), np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)


def _reduced_keys(words: list[str], symbols: int):
    reduced, edge = _symbols(words, symbols)
    value = scramble(np.arange(1, symbols + 1, dtype=np.uint64), 72)
    sums = prefix_sums(value[reduced])
    own = span_hash(sums, edge[:-1], edge[1:])
    return reduced, edge, value, sums, own, scramble(own + np.diff(edge).astype(np.uint64), 73)


def neighbourhoods(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of each word's part of the one-edit neighbourhoods,
    with the word of each: its reduced word, the deletions of it and the
    replacements by a greater symbol.  A key is the hash of a reduced word, so
    a collision makes one candidate more."""
    reduced, edge, value, sums, own, same = _reduced_keys(words, symbols)
    power, inverse = powers(len(sums), 0)
    length = np.diff(edge)
    who = np.repeat(np.arange(len(words)), length)
    at = np.arange(edge[-1])
    start, end = edge[who], edge[who + 1]
    head = (sums[at] - sums[start]) * inverse[start]
    # What comes after the place, as it stands in the word.
    rest = (sums[end] - sums[at + 1]) * inverse[start]
    owners, keys = [np.arange(len(words)), who], [same, scramble(head + rest * inverse[1] + (length[who] - 1).astype(np.uint64), 73)]
    for k in range(1, symbols):
        less = np.flatnonzero(reduced < k)
        owners.append(who[less])
        keys.append(scramble(head[less] + value[k] * power[at[less] - start[less]] + rest[less] + length[who[less]].astype(np.uint64), 73))
    owner, key = np.concatenate(owners), np.concatenate(keys)
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
    return owner[fresh], key[fresh]


def _keyed(symbols: int, around: bool):
    """From batches (node, word): (key, node), the reduced word of each or,
    with ``around``, its part of the neighbourhoods."""
    def work(batches):
        import pyarrow as pa

        for batch in batches:
            nodes, words = longs(batch.column(0))[0], batch.column(1).to_pylist()
            ends = np.cumsum([len(w) for w in words])
            lo = 0
            while lo < len(words):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHUNK_LETTERS, "right")))
                if around:
                    owner, key = neighbourhoods(words[lo:hi], symbols)
                else:
                    owner, key = np.arange(hi - lo), _reduced_keys(words[lo:hi], symbols)[-1]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(nodes[lo:hi][owner])], ["key", "node"])
                lo = hi

    return work


def near_words(words: DataFrame, symbols: int) -> DataFrame:
    """``(a, b)``, each pair once: the nodes of a written frame (node, word, n)
    whose words differ by one insertion, deletion or replacement."""
    listed = words.select("node", "word")
    around = listed.mapInArrow(_keyed(symbols, True), "key long, a long")
    reduced = listed.mapInArrow(_keyed(symbols, False), "key long, b long")
    pairs = around.join(reduced, "key").where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    one, two = (listed.select(F.col("node").alias(x), F.col("word").alias(f"word_{x}")) for x in "ab")
    return (pairs.join(one, "a").join(two, "b").where(F.levenshtein("word_a", "word_b", 1) == 1).select("a", "b")
            .distinct())  # words with the same reduced word list each other


def spelling_variants(df: DataFrame, least: int = 5, times: int = 3, every: int = 97, factor: int = 2, symbols: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of the corpus.

    Runs are maximal runs of ASCII letters and U+00C0 to U+00FF, with A-Z in
    lower case.  Where ``every`` divides the CRC-32 of ``<id>:<run>``, the run
    loses the code point at that CRC modulo its length (``every=0``: never).
    Words have ``least`` code points and ``times`` occurrences (n) or more.
    Two words are near if one inserted, deleted or replaced code point parts
    them.  A word's form is its near word with the largest n (of equal ones
    the first by code points) if that is at least ``factor`` (2 or more) times
    its own n; root is where the forms lead in the end, the word itself if it
    has none.

    ``symbols``: how many symbols letters are hashed to.  By default the least
    number, 4 or more, whose fifth power is a tenth of the vocabulary, so that
    a reduced word of five letters stands for few words at any size.

    A null text has no words.  A null id is written as an empty one.  A row
    that repeats another counts again.  Other columns are ignored.  An empty
    table gives an empty result.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more, or forms may lead round in circles")
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # Read back from what was written, numbers stay the same whenever a task is repeated.
    words = written(vocabulary(docs, least, times, every).select(F.monotonically_increasing_id().alias("node"), "word", "n"), "words")
    size, most = words.agg(F.count("*"), F.max("n")).first()
    if symbols is None:
        symbols = 4
        while 10 * symbols**5 < size:
            symbols += 1
    pairs = written(near_words(words, symbols), "near")
    both = pairs.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")).select("p.a", "p.b")
    near = (both.join(words.select(F.col("node").alias("b"), F.col("word").alias("near_word"), F.col("n").alias("near_n")), "b")
            .groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near_word", F.col("b").alias("to"))).alias("best")))
    formed = words.join(near.withColumnRenamed("a", "node"), "node", "left").withColumn("near_n", -F.col("best.less"))
    has = F.col("near_n") >= factor * F.col("n")
    formed = written(formed.select("node", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.near_word")).alias("form"),
                                   F.when(has, F.col("near_n")).alias("form_n"), F.when(has, F.col("best.to")).alias("to")), "formed")
    # A form occurs at least twice as often as its word, so no chain is longer than the largest n has binary digits;
    # each round doubles how far every word has followed its chain.
    steps = formed.where("to is not null").select("node", "to")
    far, reach = steps, 1
    while reach < (most or 0).bit_length():
        ahead = far.select(F.col("node").alias("to"), F.col("to").alias("next"))
        longer = written(far.join(ahead, "to", "left").select("node", F.coalesce("next", "to").alias("to")), "far")
        done = longer.join(ahead, "to", "left_semi").isEmpty()
        drop_written(far)
        far, reach = longer, reach * 2
        if done:
            break
    roots = far.join(words.select(F.col("node").alias("to"), F.col("word").alias("root")), "to").select("node", "root")
    drop_written(pairs)
    return (formed.join(roots, "node", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
