"""Vectorised text work on Arrow string columns: words, hashes, shingles.

Everything here runs inside a Spark task on one Arrow batch.  Texts are taken
as their UTF-8 buffer, so no Python string is made per row.  Hashes are
polynomials modulo 2^64 over random byte values, read off prefix sums, then
scrambled; they depend on content only, never on position or partition.
"""

from __future__ import annotations

import numpy as np

SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
GOLDEN = 0x9E3779B97F4A7C15
BASES = (0xD6E8FEB86659FD93, 0xA3EC647659359ACD)
CHUNK_BYTES = 1 << 20

_cache: dict = {}


def scramble(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (bijective) of uint64 values."""
    x = x + np.uint64((salt * GOLDEN) & (2**64 - 1))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2^64, at least n of each."""
    have = _cache.get(("pw", which))
    if have is None or len(have[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        out = []
        for base in (BASES[which], pow(BASES[which], -1, 2**64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _cache[("pw", which)] = tuple(out)
    return have


def byte_values(which: int = 0) -> np.ndarray:
    """256 fixed random 64-bit values, one for each byte."""
    key = ("bytes", which)
    if key not in _cache:
        _cache[key] = scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(GOLDEN), 11 + which)
    return _cache[key]


def prefix_sums(values: np.ndarray, which: int = 0) -> np.ndarray:
    """Prefix sums of values times powers, from which any span's hash follows."""
    n = len(values)
    out = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(n, which)[0][:n], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts, ends, which: int = 0) -> np.ndarray:
    """Hash of values[start:end] for each span, independent of its position."""
    inverse = _powers(len(sums), which)[1]
    return (sums[ends] - sums[starts]) * inverse[starts]


def run_hashes(values: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """``span_hash`` of all runs of ``size`` values, by doubling: a few passes
    in order instead of look-ups for each run."""
    powers = _powers(size, which)[0]
    out, done, part, width = None, 0, values, 1
    while width <= size:
        if size & width:
            if out is None:
                out = part
            else:
                more = powers[done] * part[done:]
                more += out[: len(more)]
                out = more
            done += width
        if 2 * width <= size:
            more = powers[width] * part[width:]
            more += part[: len(more)]
            part = more
        width *= 2
    return out


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (rows + 1) of an Arrow string or binary array;
    a null row is empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def longs(column) -> tuple[np.ndarray, np.ndarray]:
    """Values (0 for null) and the null mask of an Arrow integer array."""
    nulls = np.asarray(column.is_null())
    filled = column.fill_null(0) if column.null_count else column
    return np.asarray(filled).astype(np.int64), nulls


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Ranges of rows with about ``limit`` bytes each; a longer row is alone."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def _space_table(separators: bytes) -> np.ndarray:
    key = ("sep", separators)
    if key not in _cache:
        table = np.zeros(256, bool)
        table[list(separators)] = True
        _cache[key] = table
    return _cache[key]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    if "lower" not in _cache:
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        _cache["lower"] = table
    return _cache["lower"][data]


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: bytes = SPACES):
    """Byte spans of the words of every row (maximal runs without separators)
    and the index of each row's first word (rows + 1)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    space = _space_table(separators)[data]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    edges = offsets[offsets < len(data)]
    before[edges] = True
    after = np.empty_like(space)
    after[-1], after[:-1] = True, space[1:]
    after[edges[edges > 0] - 1] = True
    solid = ~space
    starts = np.flatnonzero(solid & before)
    ends = np.flatnonzero(solid & after) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = prefix_sums(byte_values()[data])
    return scramble(span_hash(sums, starts, ends), 1)


def hashed_words(column, lower: bool):
    """Chunks of an Arrow text column: first row, last row, hashes of all
    their words, and the index of each row's first word in them."""
    data, offsets = utf8(column)
    for lo, hi in row_chunks(offsets):
        part = data[offsets[lo]: offsets[hi]]
        if lower:
            part = lower_ascii(part)
        starts, ends, first = word_spans(part, offsets[lo: hi + 1] - offsets[lo])
        yield lo, hi, word_hashes(part, starts, ends), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int):
    """Hashes of all runs of ``size`` words of each row, and the index of each
    row's first run.  A row with fewer words is one run; an empty row none."""
    counts = np.diff(first)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    total = np.zeros(len(first), np.int64)
    np.cumsum(runs, out=total[1:])
    if not total[-1]:
        return np.zeros(0, np.uint64), total
    at = np.arange(total[-1]) + np.repeat(first[:-1] - total[:-1], runs)
    length = np.repeat(np.minimum(counts, size), runs)
    sums = prefix_sums(words)
    return scramble(span_hash(sums, at, at + length) + length.astype(np.uint64), 2), total


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edges[0::2], edges[1::2]
