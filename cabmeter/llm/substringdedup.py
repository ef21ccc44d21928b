"""Repeated word windows removed, with a count-min prefilter.

Pass 1: every block of documents makes a count-min sketch of its windows, kept
sparse (its cells in order, as differences) and cut by section of the hash
space.  A section's task adds the sketches of all blocks up and tells each
block which of its cells hold two or more.  A window may repeat if all its
cells do: the estimate is never below the true count, so none is lost.
Pass 2: only those windows are grouped exactly, by 96 bits of two independent
hashes.

Blocks are cut by a hash of the rows, so the same shuffle of the documents
serves both passes and the removal, and neither row ids nor positions are ever
sent.  Counters stop at two, so a window in a third of all documents costs a
block as much as any other.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.repeats import count_exactly, named_texts, pack_positions, unpack_positions
from cabmeter.llm.textops import prefix_sums, row_chunks, scramble, span_hash, utf8, word_hashes, word_spans

BLOCK_BYTES, SECTION_BYTES, TASK_BYTES = 2 << 20, 32 << 20, 32 << 20
DEPTH = 2
ANSWERS = "section int, block long, body binary"


def section_of(keys: np.ndarray, sections: int) -> np.ndarray:
    """Sections of keys, ascending with them."""
    return (((keys >> np.uint64(32)) * np.uint64(sections)) >> np.uint64(32)).astype(np.int64)


def sketch_cells(keys: np.ndarray, sections: int, bits: int, row: int) -> np.ndarray:
    """The keys' cells in one row of counters: a section has 2^bits of them."""
    cell = scramble(keys, 31 + row) >> np.uint64(64 - bits)
    return (section_of(keys, sections) << bits) + cell.astype(np.int64)


def partial_sketch(keys: np.ndarray, sections: int, bits: int) -> dict[int, bytes]:
    """The sketch of one block by section: for each row of counters the cells
    in use and a bit that is set where the counter is two or more."""
    rows = []
    for row in range(DEPTH):
        cells = np.sort(sketch_cells(keys, sections, bits, row))
        heads = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1]))) if len(cells) else np.zeros(0, np.int64)
        twice = np.diff(np.append(heads, len(cells))) > 1
        cells = cells[heads]
        rows.append((cells, twice, np.searchsorted(cells, np.arange(sections + 1) << bits)))
    out = {}
    for s in np.flatnonzero(np.diff(rows[0][2])).tolist():
        body = b""
        for cells, twice, cuts in rows:
            part = slice(cuts[s], cuts[s + 1])
            body += pack_positions(cells[part] - (s << bits)) + np.packbits(twice[part]).tobytes()
        out[s] = body
    return out


def merged_sketch(bodies: list[bytes], bits: int) -> list[bytes]:
    """The sketches of a section's blocks added up, as one answer a block: a
    bit for each of its cells, set where the sum is two or more."""
    counters, used = np.zeros((DEPTH, 1 << bits), np.uint8), []
    for body in bodies:
        at, places = 0, []
        for row in range(DEPTH):
            cells, size = unpack_positions(body[at:])
            at += size
            wide = -(-len(cells) // 8)
            twice = np.unpackbits(np.frombuffer(body, np.uint8, wide, at), count=len(cells))
            at += wide
            # A block names a cell once, so a plain indexed sum is right.
            counters[row, cells] = np.minimum(counters[row, cells] + 1 + twice, 2)
            places.append(cells)
        used.append(places)
    return [b"".join(np.packbits(counters[row, cells] >= 2).tobytes() for row, cells in enumerate(places)) for places in used]


def estimated_repeats(keys: np.ndarray, sections: int, bits: int, answers: dict[int, bytes]) -> np.ndarray:
    """True for the block's keys whose least merged counter is two or more."""
    maybe, rows = np.ones(len(keys), bool), []
    for row in range(DEPTH):
        cells = sketch_cells(keys, sections, bits, row)
        order = np.argsort(cells)
        ranked = cells[order]
        fresh = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(keys) else np.zeros(0, bool)
        place = np.empty(len(keys), np.int64)
        place[order] = np.cumsum(fresh) - 1
        cuts = np.searchsorted(ranked[fresh], np.arange(sections + 1) << bits)
        rows.append((place, cuts, np.zeros(int(cuts[-1]), bool)))
    for s in np.flatnonzero(np.diff(rows[0][1])).tolist():
        at, body = 0, answers.get(s, b"")
        for _, cuts, high in rows:
            n = int(cuts[s + 1] - cuts[s])
            wide = -(-n // 8)
            if len(body) < at + wide:
                raise RuntimeError("the input's rows changed between two passes")
            high[cuts[s]: cuts[s + 1]] = np.unpackbits(np.frombuffer(body, np.uint8, wide, at), count=n).astype(bool)
            at += wide
    for place, _, high in rows:
        maybe &= high[place]
    return maybe


def sketch_repeats(keys: np.ndarray, extra=None, width: int = 8, tag: bool = False) -> np.ndarray:
    """True where the sketch of these keys alone estimates two or more.  It
    has the form of ``repeats.count_exactly``, of which only the keys count."""
    bits = max(10, int(4 * len(keys)).bit_length())
    parts = partial_sketch(keys, 1, bits)
    return estimated_repeats(keys, 1, bits, dict(zip(parts, merged_sketch(list(parts.values()), bits))))


def _windows(words: np.ndarray, first: np.ndarray, size: int, both: bool):
    """Hashes of the windows of each row, and how many windows each has."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        none = np.zeros(0, np.uint64)
        return none, none, counts
    at = np.arange(total) + np.repeat(first[:-1] - (ends - counts), counts)
    one = scramble(span_hash(prefix_sums(words), at, at + size), 3)
    two = scramble(span_hash(prefix_sums(scramble(words, 5), 1), at, at + size, 1), 4) if both else one
    return one, two, counts


def _block(table, size: int, both: bool):
    """A block's rows in a fixed order, the hashes of their windows, and how
    many each row has.  Rows without an id have none."""
    import pyarrow as pa
    import pyarrow.compute as pc

    table = table.sort_by([("id", "ascending"), ("fingerprint", "ascending")])
    data, offsets = utf8(pc.if_else(pc.is_valid(table["id"]), table["text"], pa.scalar(None, pa.string())))
    parts = []
    for lo, hi in row_chunks(offsets):
        part = data[offsets[lo]: offsets[hi]]
        starts, ends, first = word_spans(part, offsets[lo: hi + 1] - offsets[lo])
        parts.append(_windows(word_hashes(part, starts, ends), first, size, both))
    none = np.zeros(0, np.uint64)
    one, two, counts = (np.concatenate([p[k] for p in parts] or [none]) for k in range(3))
    return table, one, two & np.uint64(0xFFFFFFFF), counts.astype(np.int64)


def _ranked(one: np.ndarray, two: np.ndarray, sections: int):
    """Distinct 96-bit keys in order: their first places, whether they occur
    twice, the rank of every key, and where each section begins."""
    n = len(one)
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    fresh = np.ones(n, bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    heads = np.flatnonzero(fresh)
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(fresh) - 1
    cuts = np.searchsorted(section_of(a[heads], sections), np.arange(sections + 1))
    return order[heads], np.diff(np.append(heads, n)) > 1, rank, cuts


def _by_section(table) -> dict[int, bytes]:
    return dict(zip(table["section"].to_pylist(), table["body"].to_pylist()))


def _answer_table(rows: list[tuple]):
    import pyarrow as pa

    section, block, body = zip(*rows) if rows else ((), (), ())
    return pa.table({"section": pa.array(section, pa.int32()), "block": pa.array(block, pa.int64()), "body": pa.array(body, pa.binary())})


def _sketches(size: int, sections: int, bits: int):
    def work(table):
        _, one, _, _ = _block(table, size, False)
        block = table["block"][0].as_py()
        return _answer_table([(s, block, body) for s, body in partial_sketch(one, sections, bits).items()])

    return work


def _merge(bits: int):
    def work(table):
        section = table["section"][0].as_py()
        merged = merged_sketch(table["body"].to_pylist(), bits)
        return _answer_table([(section, block, body) for block, body in zip(table["block"].to_pylist(), merged)])

    return work


def _candidates(size: int, sections: int, bits: int):
    """Keys of a block's windows that may repeat, by section, and in section
    -1 - block % sections the windows that they are."""

    def work(docs, answers):
        if not docs.num_rows:
            raise RuntimeError("the input's rows changed between two passes")
        _, one, two, _ = _block(docs, size, True)
        block = docs["block"][0].as_py()
        maybe = estimated_repeats(one, sections, bits, _by_section(answers))
        one, two = one[maybe], two[maybe]
        first, twice, _, cuts = _ranked(one, two, sections)
        out = [(-1 - block % sections, block, np.packbits(maybe).tobytes())] if len(first) else []
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            at = first[cuts[s]: cuts[s + 1]]
            body = one[at].tobytes() + two[at].astype("<u4").tobytes() + np.packbits(twice[cuts[s]: cuts[s + 1]]).tobytes()
            out.append((s, block, np.int64(len(at)).tobytes() + body))
        return _answer_table(out)

    return work


def _exact(table):
    """A section's keys counted by all 96 bits: a bit for each key of a block."""
    section, blocks, bodies = table["section"][0].as_py(), table["block"].to_pylist(), table["body"].to_pylist()
    if section < 0:
        return _answer_table([(section, block, body) for block, body in zip(blocks, bodies)])
    parts = []
    for body in bodies:
        n = int(np.frombuffer(body, np.int64, 1)[0])
        parts.append((np.frombuffer(body, "<u8", n, 8), np.frombuffer(body, np.uint8, 4 * n, 8 + 8 * n).reshape(n, 4),
                      np.unpackbits(np.frombuffer(body, np.uint8, -1, 8 + 12 * n), count=n).astype(bool)))
    one, two, twice = (np.concatenate([p[k] for p in parts]) for k in range(3))
    sure = count_exactly(one, two, 8, False) | twice
    ends = np.cumsum([len(p[0]) for p in parts])
    return _answer_table([(section, block, np.packbits(part).tobytes()) for block, part in zip(blocks, np.split(sure, ends[:-1]))])


def _cut(size: int, sections: int):
    """The rows of a block without the words of repeated windows."""

    def work(docs, answers):
        import pyarrow as pa

        if not docs.num_rows:
            raise RuntimeError("the input's rows changed between two passes")
        found = _by_section(answers)
        table, one, two, counts = _block(docs, size, bool(found))
        sure = np.zeros(len(one), bool)
        if found:
            block = docs["block"][0].as_py()
            at = np.flatnonzero(np.unpackbits(np.frombuffer(found[-1 - block % sections], np.uint8), count=len(one)))
            _, _, rank, cuts = _ranked(one[at], two[at], sections)
            high = np.zeros(int(cuts[-1]), bool)
            for s in np.flatnonzero(np.diff(cuts)).tolist():
                high[cuts[s]: cuts[s + 1]] = np.unpackbits(np.frombuffer(found[s], np.uint8), count=int(cuts[s + 1] - cuts[s]))
            sure[at] = high[rank]
        n_words, n_removed, kept = [], [], []
        for text, hi, n in zip(table["text"].to_pylist(), np.cumsum(counts).tolist(), counts.tolist()):
            words = (text or "").encode().split()
            n_words.append(len(words))
            starts = np.flatnonzero(sure[hi - n: hi])
            if len(starts):
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + size, -1)
                words = [w for w, depth in zip(words, np.cumsum(edge).tolist()) if not depth]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words).decode())
        return pa.table({"id": table["id"], "n_words": pa.array(n_words, pa.int64()),
                         "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.string())})

    return work


def substring_dedup(df: DataFrame, size: int = 35, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES, section_bytes: int = SECTION_BYTES) -> DataFrame:
    """Every word that lies in a window of ``size`` consecutive words whose
    sequence also starts elsewhere, in this or another row, is removed.

    Words are maximal runs without space, tab, line feed, vertical tab, form
    feed or carriage return.  Windows are judged on the input, so every copy
    goes, the first included.  Returns ``id, n_words, n_removed, kept``, one
    row per input row; kept is the remaining words joined by one space.  A
    null text has no words.  A repeated row is a copy like any other.  Rows
    with a null id are compared with nothing and kept whole.  Further columns
    are ignored.  An empty table gives an empty result.

    block_bytes and section_bytes: text that a block and a section of the
    sketch stand for, so their numbers grow with the input and their sizes do
    not; a small input has smaller sections, one for each task.  A row of the
    sketch has a counter or more for each byte of text.
    """
    docs = named_texts(df, id_col, text_col)
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))
    blocks = -(-total // block_bytes) or 1
    # A block sends a row to each section, so a small input has no more sections than tasks.
    sections = max(min(tasks, blocks), -(-total // section_bytes))
    bits = max(10, int(total // sections).bit_length())
    # The partition as salt: rows that repeat id and text are parted, too.
    block = F.pmod(F.xxhash64("id", "fingerprint", F.spark_partition_id()), F.lit(blocks))
    dealt = docs.withColumn("block", block).repartition(tasks, "block")

    def answered(rows: DataFrame, work) -> DataFrame:
        return (rows.repartition(tasks, "section").groupBy("section").applyInArrow(work, ANSWERS)
                .repartition(tasks, "block").groupBy("block"))

    sketches = dealt.groupBy("block").applyInArrow(_sketches(size, sections, bits), ANSWERS)
    estimates = answered(sketches, _merge(bits))
    keys = dealt.groupBy("block").cogroup(estimates).applyInArrow(_candidates(size, sections, bits), ANSWERS)
    return (dealt.groupBy("block").cogroup(answered(keys, _exact))
            .applyInArrow(_cut(size, sections), "id long, n_words long, n_removed long, kept string"))
