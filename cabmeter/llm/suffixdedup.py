"""Repeated byte strings removed by a corpus-wide suffix array.

A suffix array over all texts is out of reach of one task, so the work is
split without losing a match:

1. Each window of ``size`` bytes belongs to its *anchor*, the first of its
   least-hashed grams.  Equal windows have equal anchors at equal places, so
   an anchor found once in the corpus owns no repeated window.
2. The remaining contexts (an anchor with all the windows it owns) go, each
   different one once with its number of copies, to the task of their anchor.
   That task builds the suffix array of its contexts by two-stage sorting and
   reads repeats off adjacent common prefixes.
3. An anchor with very many different contexts (a line that a third of all
   documents have) would make one task's text grow with the corpus; its
   windows are grouped one by one instead, by 128 bits of their content.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.repeats import hit_mask, named_texts, repeated
from cabmeter.llm.suffixsort import common_prefixes, suffix_order
from cabmeter.llm.tables import drop_written, partitions, written
from cabmeter.llm.textops import byte_values, longs, prefix_sums, row_chunks, runs_of, scramble, span_hash, utf8

BLOCK_BYTES = 16 << 20
TASK_TEXT = 2 << 20
CROWD = 1024  # contexts of one anchor: about half a megabyte of text
STRETCHES = ("id long, fingerprint long, at int, body binary, "
             "runs array<struct<anchor:long,a:long,b:long,lo:int,hi:int>>")


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    n = len(values)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1: n])


def owned_runs(data: np.ndarray, offsets: np.ndarray, size: int, gram: int):
    """Runs of windows with the same anchor: first and last window (places in
    ``data``), the anchor's hash, and how many runs each row has."""
    counts = np.maximum(np.diff(offsets) - size + 1, 0)
    total = int(counts.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    at = np.arange(len(data) - gram + 1)
    grams = scramble(span_hash(prefix_sums(byte_values()[data]), at, at + gram), 7)
    mixed = (grams >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
    anchors = (_sliding_least(mixed, size - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = np.cumsum(counts)
    windows = np.arange(total) + np.repeat(offsets[:-1] - (ends - counts), counts)
    own = anchors[windows]
    fresh = np.ones(total, bool)
    fresh[1:] = (own[1:] != own[:-1]) | (windows[1:] != windows[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], total) - 1
    per_row = np.diff(np.searchsorted(first, np.concatenate(([0], ends))))
    return windows[first], windows[last], grams[own[first]], per_row


def anchor_blocks(size: int, gram: int, block_bytes: int = BLOCK_BYTES):
    """Blocks of anchor keys for ``repeated`` from batches (id, fingerprint, text)."""

    def blocks(batches):
        ids, counts, keys, held = [], [], [], 0
        for batch in batches:
            names = np.column_stack((longs(batch.column(0))[0], longs(batch.column(1))[0]))
            data, offsets = utf8(batch.column(2))
            for lo, hi in row_chunks(offsets, 1 << 18):
                _, _, anchors, n = owned_runs(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], size, gram)
                ids.append(names[lo:hi])
                counts.append(n)
                keys.append(anchors)
                held += int(offsets[hi] - offsets[lo])
                if held >= block_bytes:
                    yield np.concatenate(ids), np.concatenate(counts), np.concatenate(keys), None
                    ids, counts, keys, held = [], [], [], 0
        if ids:
            yield np.concatenate(ids), np.concatenate(counts), np.concatenate(keys), None

    return blocks


def _stretches(size: int, gram: int):
    """From batches (id, fingerprint, text, hits): the text around the runs
    whose anchors others have too, neighbouring runs in one stretch."""

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            batch = batch.filter(batch.column(3).is_valid())
            names, prints = longs(batch.column(0))[0], longs(batch.column(1))[0]
            data, offsets = utf8(batch.column(2))
            for lo, hi in row_chunks(offsets, 1 << 18):
                part, edge = data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
                first, last, anchors, n = owned_runs(part, edge, size, gram)
                if not len(first):
                    continue
                mask = np.concatenate([hit_mask(h, int(k)) for h, k in zip(batch.column(3)[lo:hi].to_pylist(), n)])
                row = np.repeat(np.arange(hi - lo), n)
                joined = np.zeros(len(first), bool)
                joined[1:] = row[1:] == row[:-1]
                begin, end = [], []
                for a, b in zip(*runs_of(mask)):
                    inner = np.concatenate(([a], a + 1 + np.flatnonzero(~joined[a + 1: b]), [b]))
                    begin.extend(inner[:-1].tolist())
                    end.extend(inner[1:].tolist())
                if not begin:
                    continue
                begin, end = np.array(begin), np.array(end)
                start = first[begin]
                pick = np.flatnonzero(mask)
                base = np.repeat(start, end - begin)
                bytes_of = byte_values()[part]
                a = span_hash(prefix_sums(bytes_of), first[pick], last[pick] + size)
                b = span_hash(prefix_sums(byte_values(1)[part], 1), first[pick], last[pick] + size, 1)
                structs = pa.StructArray.from_arrays(
                    [pa.array(x) for x in (anchors[pick].view(np.int64), scramble(a, 8).view(np.int64), scramble(b, 9).view(np.int64),
                                           (first[pick] - base).astype(np.int32), (last[pick] - base).astype(np.int32))],
                    ["anchor", "a", "b", "lo", "hi"])
                sizes = np.concatenate(([0], np.cumsum(end - begin))).astype(np.int32)
                raw = part.tobytes()
                who = row[begin]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[lo + who]), pa.array(prints[lo + who]), pa.array((start - edge[who]).astype(np.int32)),
                     pa.array([raw[s: e] for s, e in zip(start.tolist(), (last[end - 1] + size).tolist())], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(sizes), structs)],
                    ["id", "fingerprint", "at", "body", "runs"])

    return work


def _search(size: int):
    """One task's contexts (bucket, anchor, a, b, copies, body): the windows
    of each that repeat, by suffix array and adjacent common prefixes."""

    def work(table):
        import pyarrow as pa

        text, offsets = utf8(table["body"])
        copies = np.asarray(table["copies"])
        windows = np.maximum(np.diff(offsets) - size + 1, 0)
        place = np.arange(len(text))
        owner = np.repeat(np.arange(len(windows)), np.diff(offsets))
        wanted = place - offsets[owner] < windows[owner]
        order, words = suffix_order(text, wanted, size)
        reach = common_prefixes(words, order, size) >= size
        again = np.zeros(len(text), bool)
        again[order[1:][reach]] = True
        again[order[:-1][reach]] = True
        again |= wanted & (copies[owner] > 1)
        out = []
        for i in range(len(windows)):
            lo, hi = runs_of(again[offsets[i]: offsets[i] + windows[i]])
            out.append(np.column_stack((lo, hi)).astype(np.int32).tobytes() if len(lo) else None)
        return pa.table({"anchor": table["anchor"], "a": table["a"], "b": table["b"], "spans": pa.array(out, pa.binary())})

    return work


def _single_windows(size: int):
    """Every window of contexts (anchor, a, b, copies, body) as a row."""

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                text, _ = utf8(batch.column(4)[i:i + 1])
                at = np.arange(max(len(text) - size + 1, 0))
                one = span_hash(prefix_sums(byte_values()[text]), at, at + size)
                two = span_hash(prefix_sums(byte_values(1)[text], 1), at, at + size, 1)
                same = [pa.array(np.full(len(at), batch.column(j)[i].as_py(), np.int64)) for j in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(scramble(one, 8).view(np.int64)), pa.array(scramble(two, 9).view(np.int64)), pa.array(at.astype(np.int32))],
                    ["anchor", "a", "b", "copies", "wa", "wb", "at"])

    return work


def repeated_spans(docs: DataFrame, size: int, gram: int, crowd: int) -> DataFrame:
    """``(id, fingerprint, spans)``: where windows start that also start
    elsewhere, as structs (base, spans) with int32 pairs from, to."""
    key, context = ["id", "fingerprint"], ["anchor", "a", "b"]
    hits = repeated(docs.where("id is not null"), anchor_blocks(size, gram), width=6, sections=2 * partitions(docs))
    stretches = written(docs.join(hits, key, "left").select(*key, "text", "hits").mapInArrow(_stretches(size, gram), STRETCHES), "stretches")
    runs = stretches.select(*key, "at", F.explode("runs").alias("r")).select(*key, "at", "r.*")
    kinds = runs.groupBy(*context).agg(F.count("*").alias("copies"), F.min(F.struct(*key, "at", "lo", "hi")).alias("first"))
    groups = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("copies").alias("total"), F.sum(F.expr("first.hi - first.lo") + size).alias("bytes"))
    kinds = written(kinds.join(groups.where("total > 1"), "anchor").select(*context, "copies", "kinds", "first.*"), "kinds")
    amount = kinds.where(F.col("kinds") <= crowd).agg(F.sum(F.col("hi") - F.col("lo") + size)).first()[0] or 0
    buckets = max(1, -(-amount // TASK_TEXT))
    bodies = (kinds.join(stretches.select(*key, "at", "body"), [*key, "at"])
              .select(F.pmod("anchor", F.lit(buckets)).alias("bucket"), *context, "copies", "kinds",
                      F.expr(f"substring(body, lo + 1, hi - lo + {size})").alias("body")))
    sorted_ = (bodies.where(F.col("kinds") <= crowd).drop("kinds").repartition(min(buckets, partitions(docs) * 4), "bucket")
               .groupBy("bucket").applyInArrow(_search(size), "anchor long, a long, b long, spans binary").where("spans is not null"))
    single = (bodies.where(F.col("kinds") > crowd).select(*context, "copies", "body")
              .mapInArrow(_single_windows(size), "anchor long, a long, b long, copies long, wa long, wb long, at int"))
    again = single.groupBy("wa", "wb").agg(F.sum("copies").alias("n")).where("n > 1")
    # A context with copies repeats as a whole; only single ones need an answer for each window.
    crowded = (single.where("copies = 1").join(again, ["wa", "wb"]).groupBy(*context).agg(F.sort_array(F.collect_set("at")).alias("ats"))
               .unionByName(kinds.where((F.col("kinds") > crowd) & (F.col("copies") > 1))
                            .select(*context, F.sequence(F.lit(0), F.col("hi") - F.col("lo")).alias("ats"))))
    found = written(sorted_.select(*context, "spans", F.lit(None).cast("array<int>").alias("ats"))
                    .unionByName(crowded.select(*context, F.lit(None).cast("binary").alias("spans"), "ats")), "spans")
    placed = (runs.join(found, context).select(*key, F.struct((F.col("at") + F.col("lo")).alias("base"), "spans", "ats").alias("s"))
              .groupBy(*key).agg(F.collect_list("s").alias("spans")))
    out = written(placed, "removals")
    drop_written(stretches, kinds, found)
    return out


def covered(spans: list | None, n: int, size: int) -> np.ndarray:
    """The bytes that the repeated windows cover."""
    edge = np.zeros(n + 1, np.int64)
    for s in spans or ():
        if s["spans"]:
            pairs = np.frombuffer(s["spans"], np.int32).reshape(-1, 2).astype(np.int64) + s["base"]
            np.add.at(edge, pairs[:, 0], 1)
            np.add.at(edge, pairs[:, 1] + size - 1, -1)
        if s["ats"]:
            at = np.array(s["ats"], np.int64) + s["base"]
            np.add.at(edge, at, 1)
            np.add.at(edge, at + size, -1)
    return np.cumsum(edge)[:n] > 0


def suffix_dedup(df: DataFrame, size: int = 400, gram: int = 100, crowd: int = CROWD,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every byte that a ``size``-byte string covers which also starts
    elsewhere, in this or another row, is removed; overlaps count.

    Texts are UTF-8 bytes and strings never cross rows.  Strings are judged
    on the input, so every copy goes, the first included.  Returns ``id,
    n_bytes, n_removed, n_spans, kept``, one row per input row; n_spans is the
    number of maximal removed runs and kept the remaining bytes.  A null text
    is empty; a text shorter than ``size`` stays whole.  A repeated row is a
    copy like any other.  Rows with a null id are compared with nothing and
    kept whole.  Further columns are ignored.  An empty table gives an empty
    result.  ``gram`` sets how specific anchors are and ``crowd`` from how
    many contexts on an anchor's windows are grouped singly; neither changes
    the result.
    """
    if not 8 <= gram <= size:
        raise ValueError("gram must be between 8 and size")
    docs = named_texts(df, id_col, text_col)
    key = ["id", "fingerprint"]
    both = docs.join(repeated_spans(docs, size, gram, crowd), key, "left").select("id", "text", "spans")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            out = [], [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = (text or "").encode()
                dead = covered(spans, len(raw), size) if spans else np.zeros(0, bool)
                kept = np.frombuffer(raw, np.uint8)[~dead].tobytes() if spans else raw
                for x, v in zip(out, (len(raw), len(raw) - len(kept), len(runs_of(dead)[0]), kept)):
                    x.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.binary())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return both.mapInArrow(cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
