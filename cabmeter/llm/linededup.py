"""Near-duplicate lines by MinHash of their characters.

A line's signature is one-permutation MinHash of its character shingles, with
empty bins filled from others by a fixed hash; bands of few rows make recall
high.  Lines that share a band are candidates, the exact Jaccard similarity
confirms them, union-find joins them, and of each component the first line of
the corpus stays.

Band keys of all lines go through the packed shuffle of ``repeats``; only
lines that share one become rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabmeter.llm.components import components
from cabmeter.llm.repeats import hit_mask, named_texts, repeated
from cabmeter.llm.tables import arrow_rows, drop_written, partitions, written
from cabmeter.llm.textops import GOLDEN, longs, prefix_sums, run_hashes, scramble, span_hash

SHINGLE = 8
BANDS, ROWS = 20, 5
BLOCK_CHARS = 8 << 20
BLOCK = 1024
#: Bits of the bit maps that lines are compared by before their shingles are.
LEAST_BITS, MOST_BITS = 1 << 9, 1 << 17
#: Shingle hashes of a block's lines that are held at once.
SET_HASHES = 1 << 22
#: Rows of a batch that a Python worker is sent.
BATCH_ROWS = 4096
#: Characters whose shingles are made at once.
CHARS_AT_ONCE = 1 << 17
#: Characters of buckets' lines whose bit maps are made at once.
MAP_CHARS = 1 << 20
#: Buckets of at most so many lines have all their pairs' maps compared at
#: once, if these have at most so many words.
SMALL_BUCKET, PAIR_WORDS = 64, 1 << 20
#: Attempts to fill empty bins one by one, and empty bins looked up at once.
QUICK_ATTEMPTS, FILLED_AT_ONCE = 8, 1 << 13
_turn_tables: dict[int, np.ndarray] = {}
_source_tables: dict[int, np.ndarray] = {}
_triangles: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_value_tables: dict[str, np.ndarray] = {}
LINES = "id long, fingerprint long, line int, name long, keys array<long>, body string"


def normal_lines(text: str | None) -> list[str]:
    """Lines as they are compared: in lower case, without outer white space."""
    return [line.strip() for line in (text or "").lower().split("\n")]


def _common_values() -> np.ndarray:
    """A value for each of the common code points."""
    if "common" not in _value_tables:
        _value_tables["common"] = scramble(np.arange(1 << 12, dtype=np.uint64), 51)
    return _value_tables["common"]


def char_shingles(lines: list[str], size: int, named: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Hashes of the character runs of ``size`` of lines that are not empty
    (a shorter line is one run), the line of each, and if ``named`` a name for
    each line."""
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    common = _common_values()
    values = common.take(points, mode="clip")
    if len(points) and points.max() >= len(common):
        rare = np.flatnonzero(points >= len(common))
        values[rare] = scramble(points[rare].astype(np.uint64), 51)
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    edge = np.concatenate(([0], np.cumsum(length)))
    start, end = edge[:-1], edge[1:]
    short = np.flatnonzero(length < size)
    sums = prefix_sums(values) if named or len(short) else None
    whole = run_hashes(values, size) + np.uint64(size)
    begins = np.ones(len(values), bool)
    tail = end[:, None] - np.arange(1, size)
    begins[tail[tail > start[:, None]] if len(short) else tail.ravel()] = False
    if len(short):
        hashes = np.zeros(len(values), np.uint64)
        hashes[: len(whole)] = whole
        hashes[start[short]] = span_hash(sums, start[short], end[short]) + length[short].astype(np.uint64)
        hashes = hashes[begins]
    else:
        hashes = whole[begins[: len(whole)]]  # the last runs of the last line end with it
    names = scramble(span_hash(sums, start, end) + length.astype(np.uint64), 53) if named else None
    return scramble(hashes, 52), np.repeat(np.arange(len(lines)), np.maximum(length - size + 1, 1)), names


def _source(bins: int, column: np.ndarray, attempt: int) -> np.ndarray:
    """The bins that empty bins ask at an attempt (from 1)."""
    return (scramble((column + bins * attempt).astype(np.uint64), 55) % np.uint64(bins)).astype(np.int64)


def _quick_sources(bins: int) -> np.ndarray:
    """The bins that each bin asks at the first attempts (rows)."""
    if bins not in _source_tables:
        _source_tables[bins] = np.stack([_source(bins, np.arange(bins), k) for k in range(1, QUICK_ATTEMPTS + 1)])
    return _source_tables[bins]


def _turns(bins: int) -> np.ndarray:
    """At which attempt (from 1) an empty bin (row) first asks each bin
    (column)."""
    if bins not in _turn_tables:
        out, attempt = np.zeros((bins, bins), np.int32), 0
        column = np.arange(bins)
        while not out.all():
            attempt += 1
            source = _source(bins, column, attempt)
            fresh = out[column, source] == 0
            out[column[fresh], source[fresh]] = attempt
        _turn_tables[bins] = out
    return _turn_tables[bins]


def minhash(shingles: np.ndarray, owner: np.ndarray, sets: int, bins: int) -> np.ndarray:
    """One-permutation MinHash (sets x bins) of sets that are not empty: the
    least hash in each bin; an empty bin takes another's by a fixed order.

    Most empty bins find a full one in a few attempts; those of short lines
    look up which of the full bins they ask first."""
    none = np.iinfo(np.uint64).max
    least = np.full(sets * bins, none, np.uint64)
    high = shingles >> np.uint64(32)
    place = high * np.uint64(bins)
    place >>= np.uint64(32)
    place = place.view(np.int64)
    place += owner * bins
    high |= shingles << np.uint64(32)
    np.minimum.at(least, place, high)
    flat = least.copy()
    empty = np.flatnonzero(least == none)
    column = empty % bins
    for attempt, source in enumerate(_quick_sources(bins), 1):
        asked = least[empty + (source - np.arange(bins))[column]]
        found = asked != none
        flat[empty[found]] = scramble(asked[found], 56 + (attempt & 1023))
        found = ~found
        empty, column = empty[found], column[found]
    row, least, filled = empty // bins, least.reshape(sets, bins), flat.reshape(sets, bins)
    full = least != none
    turns = _turns(bins) if len(row) else None
    for lo in range(0, len(row), FILLED_AT_ONCE):
        r, c = row[lo: lo + FILLED_AT_ONCE], column[lo: lo + FILLED_AT_ONCE]
        turn = np.where(full[r], turns[c], np.iinfo(turns.dtype).max)
        source = turn.argmin(axis=1)
        attempt = turn[np.arange(len(r)), source]
        salt = (56 + (attempt & 1023)).astype(np.uint64) * np.uint64(GOLDEN)
        filled[r, c] = scramble(least[r, source] + salt)
    return filled


def _band_keys(lines: list[str], size: int, bands: int, rows: int, named: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Names of lines that are not empty (none if not ``named``), and their
    band keys."""
    out_names, out_keys, lo = [np.zeros(0, np.uint64)], [np.zeros((0, bands), np.uint64)], 0
    weights = scramble(np.arange(bands * rows, dtype=np.uint64), 57) | np.uint64(1)
    salts = scramble(np.arange(bands, dtype=np.uint64), 58)
    ends = np.cumsum([len(line) for line in lines])
    while lo < len(lines):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHARS_AT_ONCE, "right")))
        shingles, owner, names = char_shingles(lines[lo:hi], size, named)
        slots = minhash(shingles, owner, hi - lo, bands * rows)
        slots *= weights
        slots = slots.reshape(-1, rows)
        if named:
            out_names.append(names)
        keys = slots[:, 0].copy()
        for r in range(1, rows):
            keys += slots[:, r]
        out_keys.append(scramble(keys.reshape(-1, bands) + salts, 59))
        lo = hi
    return np.concatenate(out_names), np.concatenate(out_keys)


def _key_blocks(size: int, bands: int, rows: int):
    def blocks(batches):
        ids, counts, lines, held = [], [], [], 0

        def block():
            place = {line: k for k, line in enumerate(dict.fromkeys(lines))}
            keys = _band_keys(list(place), size, bands, rows, named=False)[1][[place[line] for line in lines]] if lines else np.zeros(0, np.uint64)
            return np.concatenate(ids), np.array(counts), keys.ravel(), None

        for batch in batches:
            names = np.column_stack((longs(batch.column(0))[0], longs(batch.column(1))[0]))
            lo = 0
            for hi, text in enumerate(batch.column(2), 1):
                body = text.as_py()
                own = [line for line in normal_lines(body) if line]
                lines += own
                counts.append(len(own) * bands)
                held += len(body or "")
                if held >= BLOCK_CHARS:
                    ids.append(names[lo:hi])
                    yield block()
                    ids, counts, lines, held, lo = [], [], [], 0, hi
            if lo < len(names):
                ids.append(names[lo:])
        if counts:
            yield block()

    return blocks


def _shared_lines(size: int, bands: int, rows: int):
    """From batches (id, fingerprint, text, hits): lines that share a band.
    A line's keys and text come once a batch."""
    def work(batches):
        import pyarrow as pa

        for batch in batches:
            batch = batch.filter(batch.column(3).is_valid())
            at, number, bodies, masks = [], [], [], [np.zeros((0, bands), bool)]
            for i, (text, hits) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                lines = [(k, line) for k, line in enumerate(normal_lines(text)) if line]
                mask = hit_mask(hits, len(lines) * bands).reshape(-1, bands)
                rows_hit = np.flatnonzero(mask.any(axis=1))
                masks.append(mask[rows_hit])
                for r in rows_hit.tolist():
                    at.append(i)
                    number.append(lines[r][0])
                    bodies.append(lines[r][1])
            unique = list(dict.fromkeys(bodies))
            place = dict(zip(unique, range(len(unique))))
            names, keys = _band_keys(unique, size, bands, rows)
            which = np.array([place[body] for body in bodies], np.int64)
            fresh = np.zeros(len(bodies), bool)
            fresh[np.unique(which, return_index=True)[1]] = True
            picked = np.concatenate(masks) & fresh[:, None]
            ends = np.concatenate(([0], np.cumsum(picked.sum(axis=1)))).astype(np.int32)
            own_keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[which][picked].view(np.int64)), mask=pa.array(~fresh))
            who = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(who), batch.column(1).take(who), pa.array(number, pa.int32()), pa.array(names[which].view(np.int64)),
                 own_keys, pa.array([body if new else None for body, new in zip(bodies, fresh.tolist())], pa.string())],
                ["id", "fingerprint", "line", "name", "keys", "body"])

    return work


def bit_maps(lines: list[str], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each line a bit map of its shingles (uint64; a power of two of bits,
    four or more for each shingle up to MOST_BITS) and how many shingles it
    has, repeats counted.

    Each bit that two maps differ in stands for at least one shingle that only
    one of the lines has, so lines whose maps differ in more bits than their
    sizes allow at the threshold are not similar (``near_maps``)."""
    maps, sizes, lo = [], np.zeros(len(lines), np.int64), 0
    ends = np.cumsum([len(line) for line in lines])
    while lo < len(lines):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHARS_AT_ONCE, "right")))
        shingles, owner, _ = char_shingles(lines[lo:hi], size)
        n = np.bincount(owner, minlength=hi - lo)
        bits = np.array([min(max(1 << (4 * int(k) - 1).bit_length(), LEAST_BITS), MOST_BITS) for k in n])
        edge = np.concatenate(([0], np.cumsum(bits)))
        flat = np.zeros(edge[-1], bool)
        flat[edge[owner] + (shingles & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)] = True
        packed = np.packbits(flat).view(np.uint64)
        maps += [packed[x: y] for x, y in zip(edge[:-1] // 64, edge[1:] // 64)]
        sizes[lo:hi] = n
        lo = hi
    return maps, sizes


def folded(maps: np.ndarray, words: int) -> np.ndarray:
    """Maps (rows x words) as they would be with fewer bits."""
    return maps if maps.shape[1] == words else np.bitwise_or.reduce(maps.reshape(len(maps), -1, words), axis=1)


def near_maps(one: np.ndarray, two: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether lines with these maps (rows x words, or one row) and so many
    shingles together can be similar: 100 (T - D) >= percent (T + D) holds for
    T shingles of which D are in one line only."""
    words = min(one.shape[1], two.shape[1])
    differing = np.bitwise_count(folded(one, words) ^ folded(two, words)).sum(axis=1, dtype=np.int64)
    return differing * (100 + percent) <= sizes * (100 - percent)


def _mapped(size: int):
    """From batches (name, body): (name, n, map)."""
    def work(batches):
        import pyarrow as pa

        for batch in batches:
            maps, sizes = bit_maps(batch.column(1).to_pylist(), size)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array([m.tobytes() for m in maps], pa.binary())], ["name", "n", "map"])

    return work


def _map(body: bytes) -> np.ndarray:
    return np.frombuffer(body, np.uint64)


def _near(percent: int):
    """Of batches (a, b, sizes, map_a, map_b): the pairs that can be similar."""
    def work(batches):
        import pyarrow as pa

        for batch in batches:
            rows = zip(np.asarray(batch.column(2)), batch.column(3).to_pylist(), batch.column(4).to_pylist())
            keep = [bool(near_maps(_map(x)[None], _map(y)[None], total, percent)[0]) for total, x, y in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return work


def shingle_sets(lines: list[str], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each line."""
    out, lo = [], 0
    ends = np.cumsum([len(line) for line in lines])
    while lo < len(lines):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHARS_AT_ONCE, "right")))
        shingles, owner, _ = char_shingles(lines[lo:hi], size)
        edge = np.searchsorted(owner, np.arange(hi - lo + 1)).tolist()
        for x, y in zip(edge[:-1], edge[1:]):
            shingles[x:y].sort()
        fresh = np.ones(len(shingles), bool)
        fresh[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
        ranked, edge = shingles[fresh], np.searchsorted(owner[fresh], np.arange(hi - lo + 1)).tolist()
        out += [ranked[x:y] for x, y in zip(edge[:-1], edge[1:])]
        lo = hi
    return out


def alike(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    few, many = (one, two) if len(one) < len(two) else (two, one)
    both = int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum())
    return 100 * both >= percent * (len(few) + len(many) - both)


def similar(one: list[str], two: list[str], size: int, percent: int) -> list[bool]:
    """Whether the lines at the same place have similar sets of shingles."""
    out, lo = [], 0
    ends = np.cumsum([len(x) + len(y) for x, y in zip(one, two)])
    while lo < len(one):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + (1 << 20), "right")))
        unique = list(dict.fromkeys(one[lo:hi] + two[lo:hi]))
        sets = dict(zip(unique, shingle_sets(unique, size)))
        out += [alike(sets[x], sets[y], percent) for x, y in zip(one[lo:hi], two[lo:hi])]
        lo = hi
    return out


def _confirm(size: int, percent: int):
    """Of batches (a, b, one, two): the pairs of similar lines."""
    def work(batches):
        import pyarrow as pa

        for batch in batches:
            keep = similar(batch.column(2).to_pylist(), batch.column(3).to_pylist(), size, percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return work


def near_pairs(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of lines that can be similar by their maps."""
    one, two = (maps.select(F.col("name").alias(x), F.col("n").alias(f"n_{x}"), F.col("map").alias(f"map_{x}")) for x in "ab")
    return (pairs.join(one, "a").join(two, "b").select("a", "b", (F.col("n_a") + F.col("n_b")).alias("sizes"), "map_a", "map_b")
            .mapInArrow(_near(percent), "a long, b long"))


def confirmed(pairs: DataFrame, bodies: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole lines are similar."""
    return (pairs.join(bodies.select(F.col("name").alias("a"), F.col("body").alias("one")), "a")
            .join(bodies.select(F.col("name").alias("b"), F.col("body").alias("two")), "b")
            .select("a", "b", "one", "two").mapInArrow(_confirm(size, percent), "a long, b long"))


def _triangle(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs x < y of rows of n."""
    if n not in _triangles:
        _triangles[n] = np.triu_indices(n, 1)
    return _triangles[n]


def _open_pairs(comp, side, maps: list[np.ndarray], n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray] | None:
    """The pairs of a small bucket's rows that are in different components, on
    different sides, and that maps allow; None if their maps are too large."""
    x, y = _triangle(len(comp))
    open_ = (comp[x] != comp[y]) & (side[x] != side[y])
    x, y = x[open_], y[open_]
    words = np.array([len(m) for m in maps])
    if len(x) * int(words.max()) > PAIR_WORDS:
        return None
    widths = np.unique(words)
    near = np.zeros(len(x), bool)
    for w in widths:
        at = np.flatnonzero(np.minimum(words[x], words[y]) == w) if len(widths) > 1 else np.arange(len(x))
        if len(at):
            rows = np.flatnonzero(words >= w)
            stack = np.stack([folded(maps[r][None], w)[0] for r in rows])
            one, two = np.searchsorted(rows, x[at]), np.searchsorted(rows, y[at])
            near[at] = near_maps(stack[one], stack[two], n[x[at]] + n[y[at]], percent)
    return x[near], y[near]


def _cross_small(pairs: list[tuple], comp, bodies: list[str], size: int, percent: int) -> list[tuple[int, int]]:
    """Links of small buckets (first row, row after the last, x, y), as
    ``_cross_block`` finds them; the shingles of all are made together."""
    rows = np.unique(np.concatenate([np.concatenate((x, y)) + lo for lo, _, x, y in pairs])) if pairs else []
    unique = list(dict.fromkeys(bodies[r] for r in rows))
    sets = dict(zip(unique, shingle_sets(unique, size)))
    links = []
    for lo, hi, xs, ys in pairs:
        own = comp[lo:hi].tolist()
        for x, y in zip(xs.tolist(), ys.tolist()):
            if own[x] != own[y] and alike(sets[bodies[lo + x]], sets[bodies[lo + y]], percent):
                links.append((lo + x, lo + y))
                gone, stays = own[y], own[x]
                own = [stays if c == gone else c for c in own]
    return links


def _cross_block(comp, side, bodies: list[str], maps: list[np.ndarray], n: np.ndarray, size: int, percent: int) -> list[tuple[int, int]]:
    """Links between the components of one bucket's two blocks, as rows: as
    many as it takes to join what is similar, so fewer than there are
    components.  Pairs that maps (``bit_maps`` of the bodies) allow are looked
    at until they are joined."""
    comp, words = comp.copy(), np.array([len(m) for m in maps])
    widths = [(w, np.flatnonzero(words == w)) for w in np.unique(words)]
    stacks = [np.stack([maps[r] for r in rows]) for _, rows in widths]
    sets: dict[int, np.ndarray] = {}
    held, links = 0, []

    def set_of(row):
        nonlocal held
        if row not in sets:
            if held > SET_HASHES:
                sets.clear()
                held = 0
            sets[row] = shingle_sets([bodies[row]], size)[0]
            held += len(sets[row])
        return sets[row]

    for k, (w, rows) in enumerate(widths):
        for (w2, rows2), stack in zip(widths[k:], stacks[k:]):
            wide = folded(stack, w)
            for at, x in enumerate(rows):
                y = (comp[rows2] != comp[x]) & (side[rows2] != side[x])
                if w == w2:
                    y &= rows2 > x
                y = np.flatnonzero(y)
                other = rows2[y[near_maps(wide[y], stacks[k][at: at + 1], n[rows2[y]] + n[x], percent)]] if len(y) else y
                while len(other):
                    first, other = int(other[0]), other[1:]
                    if alike(set_of(int(x)), set_of(first), percent):
                        links.append((int(x), first))
                        comp[comp == comp[first]] = comp[x]
                        other = other[comp[other] != comp[x]]
    return links


def _cross(size: int, percent: int):
    """From batches (key, i, j, side, name, comp, body), sorted by the first
    three: the links of each block pair.  A block paired with itself has a side
    of its own for each row."""
    def work(batches):
        import pyarrow as pa

        def found(table):
            key, i, j, sides, name, comp = (np.asarray(table[c]) for c in ("key", "i", "j", "side", "name", "comp"))
            bodies = table["body"].to_pylist()
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            ends = np.append(cuts, len(key))
            chars = np.cumsum([len(body) for body in bodies])
            links = []
            lo = k = 0
            while lo < len(key):  # maps of the next buckets together, of one at least
                fit = np.searchsorted(chars, (chars[lo - 1] if lo else 0) + MAP_CHARS, "right")
                upto = max(int(np.searchsorted(ends, fit, "right")), k + 1)
                first, alone, small = lo, ends[k] > fit, []
                maps, n = bit_maps(bodies[first: ends[upto - 1]], size)
                for hi in ends[k:upto].tolist():
                    at = slice(lo - first, hi - first)
                    side = sides[lo:hi] if i[lo] != j[lo] else np.arange(hi - lo)
                    near = _open_pairs(comp[lo:hi], side, maps[at], n[at], percent) if hi - lo <= SMALL_BUCKET and not alone else None
                    if near is None:
                        links += [(lo + x, lo + y) for x, y in _cross_block(comp[lo:hi], side, bodies[lo:hi], maps[at], n[at], size, percent)]
                    elif len(near[0]):
                        small.append((lo, hi, *near))
                    lo = hi
                links += _cross_small(small, comp, bodies, size, percent)
                k = upto
            a, b = name[[x for x, _ in links]], name[[y for _, y in links]]
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            if not held.num_rows:
                continue
            last = [np.asarray(held[c]) for c in ("key", "i", "j")]
            open_ = np.logical_and.reduce([c == c[-1] for c in last])
            start = int(np.flatnonzero(~open_)[-1]) + 1 if not open_.all() else 0
            if start:
                yield found(held.slice(0, start))
                held = held.slice(start)
        if held is not None and held.num_rows:
            yield found(held)

    return work


def block_pairs(members: DataFrame, block: int) -> DataFrame:
    """``(key, name, comp, i, j, side)`` from members (key, name, size, comp)
    of buckets: the block pairs in which every two members of a bucket meet
    that are in different components.

    A bucket of at most ``block`` members is one block.  In a greater one the
    members of the largest component (blocks i < 0) meet only those outside
    it, and those meet each other: with a bounded number outside, the rows
    grow with the bucket and not with its square.
    """
    tally = members.groupBy("key", "comp").agg(F.count("*").alias("n"))
    largest = tally.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("main")).select("key", F.col("main.n").alias("n_main"), F.col("main.comp").alias("c_main"))

    def blocks(n):
        return F.ceil(n / F.lit(block)).cast("int")

    def part(n):
        return F.pmod(F.xxhash64("name"), blocks(n)).cast("int")

    def pair(i, j, side):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))

    n_main, n_out = F.col("n_main"), F.col("size") - F.col("n_main")
    zero, one, own = F.lit(0), F.lit(1), F.col("own")
    inside = F.transform(F.sequence(zero, blocks(n_out) - 1), lambda o: pair(-1 - own, o, zero))
    outside = F.concat(F.transform(F.sequence(zero, blocks(n_main) - 1), lambda m: pair(-1 - m, own, one)),
                       F.transform(F.sequence(zero, blocks(n_out) - 1), lambda o: pair(F.least(own, o), F.greatest(own, o), own > o)))
    is_main = F.col("comp") == F.col("c_main")
    pairs = F.when(F.col("size") <= block, F.array(pair(zero, zero, zero))).when(is_main, inside).otherwise(outside)
    return (members.join(largest, "key").withColumn("own", F.when(is_main, part(n_main)).otherwise(part(n_out)))
            .select("key", "name", "comp", F.explode(pairs).alias("at")).select("key", "name", "comp", "at.i", "at.j", "at.side"))


def repeated_lines(docs: DataFrame, size: int, percent: int, bands: int, rows: int) -> DataFrame:
    """``(id, fingerprint, gone)``: the numbers of the lines of each row that
    another line of the corpus stands for."""
    key = ["id", "fingerprint"]
    hits = repeated(docs.where("id is not null"), _key_blocks(size, bands, rows), width=5, sections=2 * partitions(docs))
    lines = written(docs.join(hits.hint("shuffle_hash"), key).select(*key, "text", "hits").mapInArrow(_shared_lines(size, bands, rows), LINES), "lines")

    keys = lines.where("keys is not null").select("name", "keys").dropDuplicates(["name"]).select("name", F.explode("keys").alias("key"))
    of_key, of_name = Window.partitionBy("key"), Window.partitionBy("name")
    shared = written(keys.withColumn("size", F.count("*").over(of_key)).where("size > 1"), "shared")
    pivots = (shared.withColumn("degree", F.sum("size").over(of_name))
              .select("name", F.max(F.struct("degree", "name")).over(of_key)["name"].alias("p1"), F.min("name").over(of_key).alias("p2")))
    pairs = (pivots.select("name", F.explode(F.array("p1", "p2")).alias("p")).where("name != p")
             .select(F.least("name", "p").alias("a"), F.greatest("name", "p").alias("b")).distinct())
    bodies = written(lines.where("body is not null").select("name", "body").join(shared.select("name").distinct(), "name").dropDuplicates(["name"]), "bodies")
    maps = written(bodies.mapInArrow(_mapped(size), "name long, n long, map binary"), "maps")
    links = written(confirmed(near_pairs(pairs, maps, percent), bodies, size, percent), "links")
    roots = components(links)

    label = shared.join(roots.withColumnRenamed("node", "name"), "name", "left").select("key", "name", "size", F.coalesce("root", "name").alias("comp"))
    split = label.where("size > 2").withColumn("c0", F.min("comp").over(of_key)).withColumn("c1", F.max("comp").over(of_key))
    open_ = written(split.where("c0 < c1").drop("c0", "c1"), "open")
    if not open_.isEmpty():
        rest = block_pairs(open_, BLOCK).join(bodies, "name")
        dealt = rest.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        more = written(dealt.select("key", "i", "j", "side", "name", "comp", "body").mapInArrow(_cross(size, percent), "a long, b long").distinct(), "links")
        if not more.isEmpty():
            # The components so far are stars, so only the new links need rounds.
            roots = components(roots.toDF("a", "b").unionByName(more))
        drop_written(more)

    first = lines.groupBy("name").agg(F.min(F.struct("id", "line")).alias("first"), F.count("*").alias("n"))
    member = written(first.join(roots.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name")), "member")
    best = member.groupBy("root").agg(F.min("first").alias("keep"), F.sum("n").alias("total")).where("total > 1")
    stays = member.join(best, "root").select("name", "keep")
    gone = written(lines.select(*key, "line", "name").join(stays, "name").where("struct(id, line) != keep")
                   .groupBy(*key).agg(F.collect_set("line").alias("gone")), "gone")
    drop_written(lines, shared, bodies, maps, links, open_, member)
    return gone


def without_lines(text: Column, gone: Column) -> Column:
    """``text`` without the lines of these numbers, in time linear in both:
    the lines are cut once, as the one element of an array."""
    cut = F.array(F.struct(F.split(text, "\n", -1).alias("lines"), gone.alias("gone")))

    def left(t):
        numbers = F.array_except(F.sequence(F.lit(0), F.size(t["lines"]) - 1), t["gone"])
        return F.array_join(F.transform(numbers, lambda k: F.get(t["lines"], k)), "\n")

    return F.transform(cut, left)[0]


def line_dedup(df: DataFrame, percent: int = 80, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
               id_col: str = "doc_id", text_col: str = "text", out: str = "removed_lines") -> DataFrame:
    """``df`` without the lines that an earlier line stands for, and with the
    number of them in a column ``out``.

    Lines end at line feeds.  They are compared in lower case and without
    outer white space, by the Jaccard similarity of their sets of ``size``
    characters (a shorter line is one): ``percent`` / 100 or more links two.
    Of each component the line with the smallest id, then number, stays as it
    is written.  Lines without characters always stay.  A null text stays
    null.  Rows with a null id are compared with nothing.  Rows that repeat
    both id and text are one document and keep the same lines.  A column
    named ``out`` is replaced; all others stay.  An empty table gives an empty
    result.

    Two lines at exactly 0.8 share none of the 20 bands of 5 rows with a
    probability of 0.0004; above it, with less.
    """
    docs = named_texts(df, id_col, text_col)
    with arrow_rows(df.sparkSession, BATCH_ROWS):
        gone = repeated_lines(docs, size, percent, bands, rows)
    text = F.col(text_col).cast("string")
    fingerprint = F.xxhash64(text)
    found = gone.select(F.col("id").alias("__id"), F.col("fingerprint").alias("__fingerprint"), F.col("gone").alias("__gone"))
    held = df.withColumn("__print", fingerprint).withColumn("__key", F.col(id_col).cast("long"))
    # Neither join sorts the texts: the other side has a short row for each (id, fingerprint).
    held = held.join(found.hint("shuffle_hash"), (F.col("__key") == F.col("__id")) & (F.col("__print") == F.col("__fingerprint")), "left")

    return (held.withColumn(out, F.coalesce(F.size("__gone"), F.lit(0)))
            .withColumn(text_col, F.when(F.col("__gone").isNull(), text).otherwise(without_lines(text, F.col("__gone"))))
            .drop("__print", "__key", "__id", "__fingerprint", "__gone"))
