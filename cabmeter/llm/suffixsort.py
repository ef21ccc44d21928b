"""Suffix order by two-stage sorting, and adjacent common prefixes.

Itoh and Tanaka's two-stage method on one task's text: suffixes smaller than
their successor (type B) are sorted directly; every other one (type A) is
placed by scanning the buckets of first bytes in order, as the predecessor of
a suffix that has its place already.  Orders hold to ``depth`` bytes, which
is all that a comparison of ``depth``-byte strings needs.
"""

from __future__ import annotations

import numpy as np

SORT_AT_ONCE = 50_000


def _words(text: np.ndarray, pad: int) -> np.ndarray:
    """The eight bytes from each position on, as a number in byte order."""
    wide = np.zeros(len(text) + pad + 8, np.uint8)
    wide[: len(text)] = text
    out = np.zeros(len(text) + pad, np.uint64)
    for j in range(8):
        out <<= np.uint64(8)
        out |= wide[j: j + len(out)]
    return out


def _types(text: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than their successor."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(np.diff(text.astype(np.int16)))
    step[-1] = -1  # the empty suffix is the smallest
    at = np.where(step != 0, np.arange(n), n - 1)
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def _needed(wanted: np.ndarray, small: np.ndarray) -> np.ndarray:
    """The wanted suffixes and those that their places are induced from: all
    successors up to the first that is smaller than its own."""
    n = len(wanted)
    at = np.arange(n)
    last = np.maximum.accumulate(np.where(wanted, at, -1))
    run = np.maximum.accumulate(np.where(small, at + 1, 0))  # where this run of larger ones began
    out = wanted | (~small & (last >= run))
    out[1:] |= out[:-1] & ~small[:-1]
    return out


def _sort_directly(raw: bytes, words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the ``depth`` bytes from them on."""
    at = at[np.lexsort((words[at + 8], words[at]))]
    one, two = words[at], words[at + 8]
    tied = np.zeros(len(at) + 1, bool)
    tied[1:-1] = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
    edges = np.flatnonzero(np.diff(tied.astype(np.int8)))
    lo = None
    for start, end in zip(edges[0::2], edges[1::2] + 1):  # groups that share sixteen bytes
        if lo is None:
            lo = start
        group_end = end
        if group_end - lo >= SORT_AT_ONCE:
            at[lo:group_end] = sorted(at[lo:group_end].tolist(), key=lambda p: raw[p: p + depth])
            lo = None
    if lo is not None:
        at[lo:group_end] = sorted(at[lo:group_end].tolist(), key=lambda p: raw[p: p + depth])
    return at


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The wanted positions in suffix order, and the words of the text."""
    words = _words(text, depth + 16)
    if not wanted.any():
        return np.zeros(0, np.int64), words
    small = _types(text)
    need = _needed(wanted, small)
    direct = _sort_directly(text.tobytes(), words, np.flatnonzero(need & small), depth)
    cuts = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if need[-1]:  # induced by the empty suffix, which comes first
        induced[text[-1]].append(np.array([len(text) - 1]))
    order = []
    present = np.zeros(256, bool)
    present[np.unique(text)] = True
    for c in np.flatnonzero(present):
        front = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        parts = []
        while len(front):
            parts.append(front)
            before = front - 1
            before = before[before >= 0]
            front = before[(text[before] == c) & need[before]]
        parts.append(direct[cuts[c]: cuts[c + 1]])
        bucket = np.concatenate(parts)
        order.append(bucket)
        before = bucket - 1
        before = before[before >= 0]
        before = before[(text[before] > c) & need[before]]
        if len(before):
            heads = text[before]
            by = np.argsort(heads, kind="stable")
            before, heads = before[by], heads[by]
            marks = np.concatenate(([0], np.flatnonzero(np.diff(heads)) + 1, [len(heads)]))
            for lo, hi in zip(marks[:-1], marks[1:]):
                induced[heads[lo]].append(before[lo:hi])
    ranked = np.concatenate(order)
    return ranked[wanted[ranked]], words


def common_prefixes(words: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each pair of neighbours in the order, the length of their common
    prefix, counted up to ``depth`` bytes."""
    left, right = order[:-1], order[1:]
    out = np.zeros(len(left), np.int64)
    alive = np.arange(len(left))
    for at in range(0, depth, 8):
        if not len(alive):
            break
        differ = words[left[alive] + at] ^ words[right[alive] + at]
        equal = differ == 0
        gone = differ[~equal]
        lead = np.zeros(len(gone), np.int64)
        for j in range(1, 8):
            lead += gone < (np.uint64(1) << np.uint64(64 - 8 * j))
        out[alive[~equal]] = at + lead
        alive = alive[equal]
    out[alive] = depth
    return np.minimum(out, depth)
