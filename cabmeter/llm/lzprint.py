"""Document fingerprints from Lempel-Ziv phrases.

A document's UTF-8 bytes are parsed into LZ78 phrases: each is the longest
phrase so far that the text goes on with, and one byte more.  Documents that
compress each other well share many phrases.  The distinct phrases are hashed,
and the least hashes are the fingerprint; two fingerprints estimate the
Jaccard similarity of both phrase sets from the least hashes of their union,
exactly if both sets are small.

``neighbour_prints`` needs each document's successor in the order of ids.
Documents are dealt by ranges of ids, each range closed by a copy of the first
document of the next one that has any, and a task streams through its ranges
in order.  Nothing is ranked over the whole table in one task.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.tables import partitions
from cabmeter.llm.textops import byte_values, prefix_sums, scramble, span_hash

KEEP = 128
CHUNK_BYTES = 1 << 20
MOST_RANGES = 1 << 14
PRINTS = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def lz_phrases(data: bytes, trie: dict[int, int], cuts: list[int], node: int, at: int) -> int:
    """Parse ``data`` further: new phrases go into ``trie``, their ends (counted
    from ``at``) into ``cuts``.  Returns the node reached in an open phrase.
    Nodes are multiples of 256, so that node and byte make a key."""
    known, add, fresh = trie.get, cuts.append, len(trie) << 8
    for at, c in enumerate(data, at + 1):
        step = node | c
        node = known(step, 0)
        if not node:
            fresh += 256
            trie[step] = fresh
            add(at)
    return node


def phrase_ends(text: bytes, half: int, tail: bytes) -> tuple[list[int], list[int]]:
    """Phrase ends of ``text`` and of its first ``half`` bytes with ``tail``
    behind them; the common part is parsed once."""
    trie: dict[int, int] = {}
    cuts: list[int] = []
    node = lz_phrases(text[:half], trie, cuts, 0, 0)
    common = list(cuts)
    lz_phrases(text[half:], trie, cuts, node, half)
    for _ in range(len(cuts) - len(common)):
        trie.popitem()
    lz_phrases(tail, trie, common, node, half)
    return cuts, common


def signatures(texts: list[bytes], ends: list[list[int]], keep: int) -> list[np.ndarray]:
    """The least ``keep`` hashes (uint32, ascending) of each text's phrases."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    offset = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    counts = np.array([len(e) for e in ends])
    owner = np.repeat(np.arange(len(texts)), counts)
    stop = np.concatenate([np.array(e, np.int64) for e in ends])
    first = np.ones(len(stop), bool)
    first[1:] = owner[1:] != owner[:-1]
    start = np.concatenate(([0], stop[:-1]))[: len(stop)]
    start[first] = 0
    sums = prefix_sums(byte_values(1)[data], 1)
    hashes = scramble(span_hash(sums, start + offset[owner], stop + offset[owner], 1) + (stop - start).astype(np.uint64), 81) >> np.uint64(32)
    both = np.sort(owner.astype(np.uint64) << np.uint64(32) | hashes)
    both = both[np.concatenate(([True], both[1:] != both[:-1]))] if len(both) else both
    edge = np.searchsorted(both, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    low = (both & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [low[a: min(b, a + keep)] for a, b in zip(edge[:-1], edge[1:])]


def likeness(one: np.ndarray, two: np.ndarray, keep: int) -> float:
    """Estimated Jaccard similarity of two phrase sets by their least hashes;
    1 for two empty ones."""
    if not len(one) and not len(two):
        return 1.0
    ranked = np.sort(np.concatenate((one, two)))
    twice = np.concatenate((ranked[1:] == ranked[:-1], [False]))
    fresh = np.concatenate(([True], ~twice[:-1]))
    distinct = twice[fresh][:keep]
    return float(distinct.sum()) / len(distinct)


def print_text(signature: np.ndarray) -> str:
    return base64.b64encode(signature.astype("<u4").tobytes()).decode()


def print_signature(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u4")


def _edited(text: str, following: str) -> tuple[bytes, int, bytes]:
    """A text's bytes, how many of them its edited form keeps, and what comes
    behind them: the first code points of the following text in place of the
    last half."""
    gone = len(text) // 2
    whole = text.encode()
    return whole, len(text[: len(text) - gone].encode()), following[:gone].encode()


def _chunk(texts: list[str], keep: int) -> tuple:
    """Signatures of all texts but the last, which only follows, and of their
    edited forms, with the digests of those."""
    parts = [_edited(t, n) for t, n in zip(texts, texts[1:])]
    ends = [phrase_ends(*p) for p in parts]
    edited = [whole[:half] + tail for whole, half, tail in parts]
    found = signatures([p[0] for p in parts] + edited, [e[0] for e in ends] + [e[1] for e in ends], keep)
    return found[: len(parts)], found[len(parts):], [hashlib.sha256(e).hexdigest() for e in edited]


def _prints(keep: int):
    """From batches (bucket, copy, id, text) in order, one range after another,
    each closed by a copy of the row after it: the prints of all other rows."""
    def work(batches):
        import pyarrow as pa

        kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in PRINTS.split(", ")])
        rows: list[tuple] = []
        size, before, out = 0, None, []
        for batch in batches:
            for _, copy, id_, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                rows.append((id_, text))
                size += len(text)
                if not copy and (size < CHUNK_BYTES or len(rows) < 2):
                    continue
                texts = [t for _, t in rows]
                ready = list(zip(rows, *_chunk([*texts, ""] if copy else texts, keep)))
                for (own, body), whole, edited, digest in ready:
                    if before:
                        out.append((*before[0], likeness(before[1], whole, keep)))
                    before = (own, len(body), digest, print_text(whole), print_text(edited), likeness(whole, edited, keep)), whole
                if copy:
                    before = None
                rows = [] if copy else rows[-1:]
                size = sum(len(t) for _, t in rows)
                while len(out) >= 4096 or copy and out:
                    part, out = out[:4096], out[4096:]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)

    return work


def _ranges(docs: DataFrame, most: int) -> tuple[DataFrame, int]:
    """``docs`` (id, text) with the number of its range of ids, the largest
    ids first and null ones last, and a hash of its text; and how many ranges
    there can be."""
    from pyspark.ml.feature import Bucketizer

    n = min(partitions(docs), most)
    points = docs.select(F.percentile_approx("id", [k / n for k in range(1, n)] or [0.5], 8 * n)).first()[0] or [0]
    cuts = [float("-inf"), *sorted({float(p) for p in points}), float("inf")]
    # As doubles ids keep their order, so a range may join neighbours but never parts equal ids.
    place = Bucketizer(splits=cuts, inputCol="__id", outputCol="__place", handleInvalid="keep")
    placed = place.transform(docs.withColumn("__id", F.coalesce(F.col("id").cast("double"), F.lit(0.0))))
    bucket = F.when(F.col("id").isNull(), len(cuts)).otherwise(len(cuts) - 2 - F.col("__place")).cast("int")
    return placed.select(bucket.alias("bucket"), "id", F.xxhash64("text").alias("hash"), "text"), len(cuts) + 1


def neighbour_prints(df: DataFrame, keep: int = KEEP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``, one row per input row.

    The fingerprint holds the least ``keep`` 32-bit hashes of the text's LZ78
    phrases, in base 64 (``print_signature`` reads it, ``likeness`` compares
    two).  Documents follow each other by falling id; after the last comes the
    first.  The edited text has the first code points of the next document in
    place of its last half (rounded down), as many or as there are.
    near_edited and near_next are the likeness of the fingerprint to those of
    the edited text and of the next document, 0 to 1.  Equal texts have equal
    fingerprints and likeness 1.  The standard error of an estimate is at most
    0.5 / sqrt(keep), and there is none for two sets with fewer phrases in all.

    A null text is empty; its fingerprint is empty too, and two empty ones
    have likeness 1.  Rows that repeat an id follow each other by a hash of
    their text; rows with a null id come last.  A single row is its own next.
    Other columns are ignored.  An empty table gives an empty result.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ranged, n = _ranges(docs, MOST_RANGES)
    # One row for each range: at most MOST_RANGES and two of the driver's small rows.
    firsts = sorted(ranged.groupBy("bucket").agg(F.max(F.struct("id", "hash")).alias("first")).collect())
    turned = [(a["bucket"], *b["first"]) for a, b in zip(firsts, firsts[1:] + firsts[:1])]
    after = df.sparkSession.createDataFrame(turned, "into int, next_id long, next_hash long")
    copies = (ranged.join(F.broadcast(after), F.col("id").eqNullSafe(F.col("next_id")) & (F.col("hash") == F.col("next_hash")))
              .dropDuplicates(["into"]).select(F.col("into").alias("bucket"), F.lit(1).alias("copy"), "id", "hash", "text"))
    rows = ranged.select("bucket", F.lit(0).alias("copy"), "id", "hash", "text").unionByName(copies)
    dealt = rows.repartitionById(n, "bucket").sortWithinPartitions("bucket", "copy", F.col("id").desc_nulls_last(), F.col("hash").desc())
    return dealt.select("bucket", "copy", "id", "text").mapInArrow(_prints(keep), PRINTS)
