"""Documents packed into token sequences by best-two-fit.

The plan is made on counts: how many pieces there are of each length, at most
``size`` numbers whatever the corpus.  A bin is filled greedily with the
largest pieces that fit; then its smallest piece is taken out again if two
unpacked pieces fill the larger gap more tightly.  The bin is repeated as
long as its pieces last.  Pieces then find their place by their rank among
those of their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.tables import arrow_rows, written
from cabmeter.llm.textops import byte_values, prefix_sums, row_chunks, scramble, span_hash, utf8

PIECES_KEPT = 1_000_000
PIECES_AT_ONCE = 5_000
#: Rows of a batch that a Python worker is sent, and bytes of text that it encodes at once.
BATCH_ROWS = 1024
CHUNK_BYTES = 1 << 19
#: Of a byte: 2 for ASCII letters, 3 for digits, 1 for punctuation, 0 for others.
KINDS = np.zeros(256, np.uint8)
KINDS[0x21:0x7F] = 1
KINDS[0x30:0x3A] = 3
KINDS[0x41:0x5B] = KINDS[0x61:0x7B] = 2
PIECES = "id long, piece int, start long, length int, ids_crc32 long, part int, place long"


class Encoder:
    """Token ids of texts, each distinct piece of text encoded once.

    A byte-level tokenizer never joins what a space between two other visible
    characters separates.  Texts are cut at such spaces; pieces already seen
    are looked up by a 64-bit hash, new ones encoded many at a time.  If the
    tokenizer splits texts by the usual expression of byte-level tokenizers,
    words are also parted from the punctuation and line feeds behind them."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        splitter = self.tokenizer.pre_tokenizer
        self.fine = isinstance(splitter, ByteLevel) and splitter.use_regex and self.tokenizer.normalizer is None
        vocabulary = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # a token has a character for each byte
            self.lengths[i] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.names = np.zeros(0, np.uint64)  # sorted
        self.starts = self.counts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, names: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray, joinable: np.ndarray) -> None:
        """Encode new pieces.  Joinable ones begin with a space and end with a
        visible character, so they are encoded in a row and told apart by
        their tokens' lengths."""
        found, counts = [], np.zeros(len(names), np.int64)
        order = np.concatenate((np.flatnonzero(joinable), np.flatnonzero(~joinable)))
        many = int(joinable.sum())
        for lo in range(0, many, PIECES_AT_ONCE):
            part = order[lo: min(lo + PIECES_AT_ONCE, many)]
            pieces = [raw[s:e] for s, e in zip(starts[part].tolist(), ends[part].tolist())]
            ids = np.array(self._encode([b"".join(pieces).decode()])[0], np.uint32)
            stops = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(ends[part] - starts[part])) + 1
            counts[part] = np.diff(stops, prepend=0)
            found.append(ids)
        for lo in range(many, len(order), PIECES_AT_ONCE):
            part = order[lo: lo + PIECES_AT_ONCE]
            each = self._encode([raw[s:e].decode() for s, e in zip(starts[part].tolist(), ends[part].tolist())])
            counts[part] = [len(ids) for ids in each]
            found.append(np.fromiter(chain.from_iterable(each), np.uint32, int(counts[part].sum())))
        places = np.empty(len(names), np.int64)
        places[order] = len(self.ids) + np.cumsum(counts[order]) - counts[order]
        self.ids = np.concatenate([self.ids, *found])
        all_names = np.concatenate((self.names, names))
        by = np.argsort(all_names)
        self.names = all_names[by]
        self.starts = np.concatenate((self.starts, places))[by]
        self.counts = np.concatenate((self.counts, counts))[by]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows of a UTF-8 buffer, and where each row's begin."""
        starts, ends, row, joinable = cut_pieces(data, offsets, self.fine)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        names = scramble(span_hash(prefix_sums(byte_values()[data]), starts, ends) + (ends - starts).astype(np.uint64), 61)
        unique, first, which = np.unique(names, return_index=True, return_inverse=True)
        if len(self.names) > PIECES_KEPT:
            self._forget()
        at = np.minimum(np.searchsorted(self.names, unique), max(len(self.names) - 1, 0))
        new = first[self.names[at] != unique] if len(self.names) else first
        if len(new):
            self._learn(names[new], data.tobytes(), starts[new], ends[new], joinable[new])
        at = np.searchsorted(self.names, unique)[which]
        counts = self.counts[at]
        stops = np.cumsum(counts)
        ids = self.ids[np.arange(stops[-1]) + np.repeat(self.starts[at] - (stops - counts), counts)]
        edges = np.concatenate(([0], stops))
        return ids, edges[np.searchsorted(row, np.arange(len(offsets)))]


def cut_pieces(data: np.ndarray, offsets: np.ndarray, fine: bool = False):
    """Starts, ends and rows of the pieces between which no token goes, and
    whether each begins with a space and ends with a visible character.

    A cut is before a space whose neighbours are visible: not ASCII control
    or white space, nor a character that may be Unicode white space.  Fine
    cuts are also between an ASCII letter and ASCII punctuation after it, and
    on both sides of a line feed between visible ASCII characters; they hold
    for ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, bool)
    visible = (data > 0x20) & (data != 0x7F)
    opens = np.zeros(n + 3, bool)
    opens[:n] = (data >= 0xE1) & (data <= 0xE3)  # first bytes of three-byte white space
    after = visible & (data != 0xC2) & ~opens[:n]
    before = visible.copy()
    before[1:] &= data[:-1] != 0xC2
    before[2:] &= ~opens[: n - 2] if n > 2 else True
    cut = np.zeros(n, bool)
    cut[1:-1] = (data[1:-1] == 0x20) & before[:-2] & after[2:]
    begin = offsets[:-1][np.diff(offsets) > 0]
    joined = cut.copy()
    if fine:
        kinds = KINDS[data]
        seen = kinds > 0
        cut[1:] |= (kinds[:-1] == 2) & (kinds[1:] == 1)
        feed = np.flatnonzero((data[1:-1] == 0x0A) & seen[:-2] & seen[2:]) + 1
        cut[feed] = cut[feed + 1] = True
    cut[begin] = True
    joined[begin] = False  # a row's first byte follows another row's text
    joined[begin[1:] - 1] = False
    cut[begin[1:] - 1] = np.isin(begin[1:] - 1, begin)
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], n)
    row = np.searchsorted(offsets, starts, "right") - 1
    last = ends - 1
    return starts, ends, row, joined[starts] & before[last]


def cut_lengths(n: int, size: int) -> list[int]:
    """Lengths of the pieces of n tokens: the first may be shorter."""
    if n <= size:
        return [n]
    rest = n % size
    return ([rest] if rest else []) + [size] * (n // size)


def plan_bins(counts: np.ndarray, size: int) -> list[tuple[int, list[int]]]:
    """Bins for counts[length] pieces of each length: (how many, lengths)."""
    left = counts.astype(np.int64).copy()
    lengths = np.flatnonzero(left).tolist()
    bins = []
    while lengths:
        used: dict[int, int] = {}
        free = lambda x: left[x] - used.get(x, 0)
        gap, at = size, len(lengths)
        while gap and at:
            at = bisect_right(lengths, gap, 0, at)
            while at and not free(lengths[at - 1]):
                at -= 1
            if at:
                best = lengths[at - 1]
                take = int(min(gap // best, free(best)))
                used[best] = used.get(best, 0) + take
                gap -= take * best
        smallest = min(used)
        used[smallest] -= 1
        pair = _tightest_pair(left, used, lengths, gap + smallest, size)
        if pair and sum(pair) > smallest:
            for x in pair:
                used[x] = used.get(x, 0) + 1
        else:
            used[smallest] += 1
        used = {x: k for x, k in used.items() if k}
        times = int(min(left[x] // k for x, k in used.items()))
        bins.append((times, [x for x in sorted(used, reverse=True) for _ in range(used[x])]))
        for x, k in used.items():
            left[x] -= times * k
            if not left[x]:
                lengths.remove(x)
    return bins


def _tightest_pair(left: np.ndarray, used: dict, lengths: list[int], room: int, size: int) -> tuple[int, int] | None:
    """Two unpacked pieces with the largest sum that fits the room."""
    free = left.copy()
    for x, k in used.items():
        free[x] -= k
    able = np.array([x for x in lengths if x < room and free[x] > 0], np.int64)
    if not len(able):
        return None
    below = np.zeros(size + 1, np.int64)  # the largest length up to each number
    below[able] = able
    np.maximum.accumulate(below, out=below)
    other = below[room - able]
    lone = (other == able) & (free[able] < 2)
    other[lone] = below[able[lone] - 1]
    total = np.where(other > 0, able + other, 0)
    best = int(total.argmax())
    return (int(able[best]), int(other[best])) if total[best] else None


def _slots(bins: list[tuple[int, list[int]]], size: int) -> dict[str, np.ndarray]:
    """The plan by length: from which rank on pieces go to which sequence."""
    rows, taken, sequence = [], np.zeros(size + 1, np.int64), 0
    for times, lengths in bins:
        offset = 0
        for x in lengths:
            rows.append((x, taken[x], sequence, offset))
            taken[x] += times
            offset += x
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": (table[:, 0] << 44) | table[:, 1], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def _cut_batches(tokenizer: str, size: int, end_id: int):
    """Of batches (id, text): the pieces of each document."""
    def work(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encode, part = Encoder(tokenizer).encode, TaskContext.get().partitionId()
        places, end = np.zeros(size + 1, np.int64), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in row_chunks(offsets, CHUNK_BYTES):
                ids, edges = encode(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
                rows = []
                for i, doc in enumerate(batch.column(0)[lo:hi].to_pylist()):
                    body = ids[edges[i]: edges[i + 1]].astype("<u4").tobytes() + end
                    start = 0
                    for piece, n in enumerate(cut_lengths(len(body) // 4, size)):
                        rows.append((doc, piece, start, n, zlib.crc32(body[4 * start: 4 * (start + n)]), part, int(places[n])))
                        places[n] += 1
                        start += n
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], [c.split()[0] for c in PIECES.split(", ")])

    return work


def tokenized_pieces(df: DataFrame, tokenizer: str, size: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces of all documents, with their place among the pieces of the same
    length of the same task."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    with arrow_rows(df.sparkSession, BATCH_ROWS):
        return written(docs.mapInArrow(_cut_batches(tokenizer, size, end_id), PIECES), "pieces")


def pack_documents(df: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's tokens, ended by ``end_id``, placed in sequences of at
    most ``size`` tokens.

    tokenizer: path of a tokenizer file that every executor has.  Documents
    longer than ``size`` are cut into pieces of that length, the first of
    which may be shorter; others stay whole.  Returns per piece ``id, piece,
    start, length, ids_crc32, sequence_id, offset``: ids_crc32 is of the
    little-endian 32-bit ids; offsets fill each sequence from 0 without gaps.
    A null or empty text is the end token alone.  Rows with a null id and
    repeated rows are packed like any other.  Further columns are ignored.
    An empty table gives an empty result.
    """
    pieces = tokenized_pieces(df, tokenizer, size, end_id, id_col, text_col)
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = np.zeros(size + 1, np.int64)
    for row in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
        counts[row.length] = row.n
    plan = df.sparkSession.sparkContext.broadcast(_slots(plan_bins(counts, size), size))
    from pyspark.sql import Window

    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    base = by_part.select("length", "part", F.coalesce(before, F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["length", "part"]).select(
        "id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", (F.col("base") + F.col("place")).alias("rank"))

    def place(batches):
        import pyarrow as pa

        slots = plan.value
        for batch in batches:
            length, rank = np.asarray(batch.column(3)), np.asarray(batch.column(5))
            at = np.searchsorted(slots["key"], (length << 44) | rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(slots["sequence"][at] + rank - slots["rank"][at]), pa.array(slots["offset"][at])],
                ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
