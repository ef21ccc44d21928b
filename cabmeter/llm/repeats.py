"""Which of very many keys occur more than once, by one packed shuffle.

Operators that look at every window or line of a corpus ask this about
hundreds of keys for each document.  As Spark rows those keys would be far
larger than the text itself.  Here a map task packs the keys of a block of
documents, by section of the hash space, into binary rows of a few bytes per
key; a section's task counts them and answers with the positions of the keys
that others have too; the answers are put together by block.

Every key takes part.  Keys repeated inside a block are sent once or twice
only, so a key that is in a third of all documents costs each block as much
as any other and never fills a section.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.tables import partitions
from cabmeter.llm.textops import runs_of

PACKED = "section int, block long, body binary"
HITS = "id long, fingerprint long, hits binary"


def pack_positions(at: np.ndarray) -> bytes:
    """Ascending positions as their count, first and differences, the last in
    one, two or four bytes each."""
    gaps = np.diff(at)
    top = int(gaps.max()) if len(gaps) else 0
    width = 1 if top < 256 else 2 if top < 65536 else 4
    head = np.array([len(at), at[0] if len(at) else 0, width], np.int64).tobytes()
    return head + gaps.astype(f"u{width}").tobytes()


def unpack_positions(body: bytes) -> tuple[np.ndarray, int]:
    """The positions and the number of bytes they took."""
    n, first, width = np.frombuffer(body, np.int64, 3)
    if not n:
        return np.zeros(0, np.int64), 24
    gaps = np.frombuffer(body, f"u{width}", n - 1, 24)
    out = np.empty(n, np.int64)
    out[0] = first
    np.cumsum(gaps, out=out[1:])
    out[1:] += first
    return out, 24 + int(width) * (int(n) - 1)


def _block_id(*parts: np.ndarray) -> int:
    """A block's name: a hash of the rows and keys in it."""
    import hashlib

    digest = hashlib.blake2b(digest_size=8)
    for part in parts:
        digest.update(np.ascontiguousarray(part))
    return int.from_bytes(digest.digest(), "little", signed=True)


def pack_block(ids, counts, keys, extra, sections: int, width: int, once: bool) -> Iterator[tuple]:
    """Rows (section, block, body) of one block.

    ids and counts: the block's rows (id and text fingerprint) and how many
    keys each has.  keys: a uint64 for each; extra: a uint8 matrix of further
    key bytes, or None.
    once: a key that repeats inside the block is sent once, else twice.
    """
    ids, counts = np.asarray(ids, np.int64), np.asarray(counts, np.int64)
    block, n = _block_id(ids, counts, keys), len(keys)
    same = keys
    if extra is not None:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, : extra.shape[1]] = extra
        same = keys ^ (wide.view(np.uint64).ravel() * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(same)
    ranked = same[order]
    fresh = np.ones(n, bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    times = np.ones(n, np.int64)
    later = leader = np.zeros(0, np.int64)
    if n and not fresh.all():
        several = ~fresh  # only the keys that repeat
        several[:-1] |= ~fresh[1:]
        members, heads = order[several], np.flatnonzero(fresh[several])
        first = np.minimum.reduceat(members, heads)
        leads = np.repeat(first, np.diff(np.append(heads, len(members))))
        others = members != leads
        later, leader = members[others], leads[others]
        times[later] = 0
        if not once:
            times[first] = 2
    send = np.repeat(np.arange(n), times)
    section = ((keys >> np.uint64(32)) % np.uint64(sections)).astype(np.int32)
    head = np.array([len(ids), len(later)], np.int64).tobytes()
    yield int(block % sections), block, b"H" + head + ids.tobytes() + counts.tobytes() + later.tobytes() + leader.tobytes()
    part = section[send]
    by = np.argsort(part.astype(np.int16) if sections < 1 << 15 else part, kind="stable")  # NumPy sorts 16 bits by radix
    cuts = np.searchsorted(part[by], np.arange(sections + 1))
    dealt = send[by]
    raw = np.ascontiguousarray(keys[dealt].astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)[:, :width])
    for s in np.flatnonzero(np.diff(cuts)):
        at = dealt[cuts[s]: cuts[s + 1]]
        body = pack_positions(at) + raw[cuts[s]: cuts[s + 1]].tobytes()
        if extra is not None:
            body += extra[at].tobytes()
        yield int(s), block, b"K" + body


def _equal_before(*columns) -> np.ndarray:
    out = np.ones(len(columns[0]) - 1, bool)
    for c in columns:
        out &= c[1:] == c[:-1]
    return out


def count_exactly(keys: np.ndarray, extra: np.ndarray | None, width: int, tag: bool) -> np.ndarray:
    """True for the keys that occur twice or more, or under two tags or more
    when the extra bytes are a tag and not part of the key."""
    n = len(keys)
    if not n:
        return np.zeros(0, bool)
    if extra is None:
        order = np.argsort(keys)
        marks = (keys[order],)
    else:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, : extra.shape[1]] = extra
        more = wide.view(np.uint64).ravel()
        order = np.lexsort((more, keys))
        marks = (keys[order], more[order])
    shared = np.zeros(n, bool)
    if tag and extra is not None:
        equal = _equal_before(marks[0])
        new_tag = equal & (marks[1][1:] != marks[1][:-1])
        heads = np.concatenate(([0], np.flatnonzero(~equal) + 1))
        several = np.add.reduceat(np.concatenate(([False], new_tag)).astype(np.int64), heads) > 0
        shared[order] = np.repeat(several, np.diff(np.append(heads, n)))
        return shared
    equal = _equal_before(*marks)
    twice = np.zeros(n, bool)
    twice[1:] |= equal
    twice[:-1] |= equal
    shared[order] = twice
    return shared


def repeated(df: DataFrame, blocks: Callable, width: int, extra: int = 0, tag: bool = False,
             count: Callable = count_exactly, sections: int | None = None) -> DataFrame:
    """``(id, fingerprint, hits)`` of rows with keys that other rows or places hold.

    blocks: from an iterator of record batches makes (ids, counts, keys,
    extra) for one block of documents after another; it runs in the tasks.
    ids has two columns, a row's id and a fingerprint of its text: rows that
    share both are copies and get the same answer.
    hits: int32 pairs (from, to) of positions among the row's own keys.
    A row with no such key is left out.
    """
    sections = sections or 2 * partitions(df)

    def send(batches):
        import pyarrow as pa

        for ids, counts, keys, more in blocks(batches):
            rows = list(pack_block(ids, counts, keys, more, sections, width, tag))
            for lo in range(0, len(rows), 256):
                s, b, body = zip(*rows[lo: lo + 256])
                yield pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(b, pa.int64()), pa.array(body, pa.binary())],
                                                 ["section", "block", "body"])

    def answer(table):
        import pyarrow as pa

        out_b, out, parts = [], [], []
        for block, body in zip(table["block"].to_pylist(), table["body"].to_pylist()):
            if body[:1] == b"H":
                out_b.append(block)
                out.append(body)
                continue
            at, used = unpack_positions(body[1:])
            n, start = len(at), 1 + used
            raw = np.zeros((n, 8), np.uint8)
            raw[:, :width] = np.frombuffer(body, np.uint8, n * width, start).reshape(n, width)
            more = np.frombuffer(body, np.uint8, n * extra, start + n * width).reshape(n, extra) if extra else None
            parts.append((block, at, raw.view("<u8").ravel(), more))
        if parts:
            keys = np.concatenate([p[2] for p in parts])
            more = np.concatenate([p[3] for p in parts]) if extra else None
            shared = count(keys, more, width, tag)
            lo = 0
            for block, at, own, _ in parts:
                hit = at[shared[lo: lo + len(own)]]
                lo += len(own)
                if len(hit):
                    out_b.append(block)
                    out.append(b"K" + pack_positions(hit))
        return pa.table({"block": pa.array(out_b, pa.int64()), "body": pa.array(out, pa.binary())})

    def gather(table):
        import pyarrow as pa

        head, found = None, []
        for body in table["body"].to_pylist():
            if body[:1] == b"H":
                head = body
            else:
                found.append(unpack_positions(body[1:])[0])
        if head is None:
            raise RuntimeError("a block came back under another name: the input's rows changed between two attempts of a task")
        n, k = np.frombuffer(head, np.int64, 2, 1)
        ids = np.frombuffer(head, np.int64, 2 * n, 17).reshape(n, 2)
        counts = np.frombuffer(head, np.int64, n, 17 + 16 * n)
        later = np.frombuffer(head, np.int64, k, 17 + 24 * n)
        leader = np.frombuffer(head, np.int64, k, 17 + 24 * n + 8 * k)
        ends = np.cumsum(counts)
        mask = np.zeros(int(ends[-1]) if n else 0, bool)
        for at in found:
            mask[at] = True
        mask[later] = mask[leader]
        rows, out = [], []
        for i, hi in enumerate(ends):
            own = mask[hi - counts[i]: hi]
            if own.any():
                a, b = runs_of(own)
                rows.append(i)
                out.append(np.column_stack((a, b)).astype(np.int32).tobytes())
        return pa.table({"id": pa.array(ids[rows, 0]), "fingerprint": pa.array(ids[rows, 1]), "hits": pa.array(out, pa.binary())})

    packed = df.mapInArrow(send, PACKED)
    answers = packed.groupBy("section").applyInArrow(answer, "block long, body binary")
    hits = answers.groupBy("block").applyInArrow(gather, HITS)
    return hits.groupBy("id", "fingerprint").agg(F.first("hits").alias("hits"))


def named_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, fingerprint, text)`` of every row, for ``repeated`` and for
    joins with its answer."""
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("fingerprint"), text.alias("text"))


def hit_mask(hits: bytes | None, n: int) -> np.ndarray:
    """The positions of a row's hits as a mask of length n."""
    if not hits:
        return np.zeros(n, bool)
    pairs = np.frombuffer(hits, np.int32).reshape(-1, 2)
    mask = np.bincount(pairs[:, 0], minlength=n + 1) - np.bincount(pairs[:, 1], minlength=n + 1)
    return np.cumsum(mask)[:n] > 0
