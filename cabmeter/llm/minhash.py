"""Near-duplicate documents by SuperMinHash.

Each element of a set draws one value for every slot along a random
permutation of the slots: its j-th draw lies in [j, j + 1) and goes to the
j-th slot of the permutation (Ertl, "SuperMinHash").  Draws of one element
are thus spread over all slots, which lowers the variance, and levels above
the largest slot value cannot matter, so the work stops early.  Signatures
are cut into bands; documents that share a band are candidates; candidates
are confirmed on their full sets; confirmed links are joined by union-find.

Equal sets are one class before anything else, so copies cost nothing
further.  A band's members are not paired with each other: they are first
compared with its most connected members, and then only with members that
are still in another component and whose signatures allow the threshold.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.components import components
from cabmeter.llm.tables import arrow_rows, drop_written, written
from cabmeter.llm.textops import GOLDEN, hashed_words, scramble, shingle_hashes

BANDS, ROWS = 40, 6
BLOCK = 1024
#: Rows of a batch that a Python worker is sent.
BATCH_ROWS = 1024
SIGNATURES = "id long, n long, fa long, fb long, bands array<long>, sketch binary"


def superminhash(elements: np.ndarray, owner: np.ndarray, sets: int, slots: int) -> np.ndarray:
    """Signatures (sets x slots, uint64) of sets given as elements and owners.

    A slot holds level * 2^40 plus the fraction; slots of an empty set hold
    the largest value.
    """
    least = np.full(sets * slots, np.iinfo(np.uint64).max, np.uint64)
    low24, order = np.uint64((1 << 24) - 1), None
    for level in range(slots):
        if not len(elements):
            break
        x = scramble(elements + np.uint64(((level + 1) * GOLDEN) & (2**64 - 1)))
        other = level + (((x & low24) * np.uint64(slots - level)) >> np.uint64(24)).astype(np.int64)
        if level:
            rows = np.arange(len(elements))
            place = order[rows, other]
            order[rows, other] = order[:, level]
        else:
            place, first = other, other
        np.minimum.at(least, owner * slots + place, (x >> np.uint64(24)) + np.uint64(level << 40))
        open_ = (least.reshape(sets, slots) >= np.uint64((level + 1) << 40)).any(axis=1)
        stay = open_[owner]
        if level == 0:
            elements, owner, first = elements[stay], owner[stay], first[stay]
            order = np.broadcast_to(np.arange(slots, dtype=np.uint16), (len(elements), slots)).copy()
            order[np.arange(len(elements)), first] = 0
        elif stay.sum() * 2 < len(stay):
            elements, owner, order = elements[stay], owner[stay], order[stay]
    return least.reshape(sets, slots)


def distinct_shingles(words: np.ndarray, first: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each row."""
    shingles, cuts = shingle_hashes(words, first, size)
    return [np.unique(shingles[cuts[i]: cuts[i + 1]]) for i in range(len(cuts) - 1)]


def _signatures(size: int, bands: int, rows: int):
    def work(batches):
        import pyarrow as pa

        slots = bands * rows
        weights = scramble(np.arange(slots, dtype=np.uint64), 21).reshape(bands, rows) | np.uint64(1)
        salts = scramble(np.arange(bands, dtype=np.uint64), 22)
        for batch in batches:
            for lo, hi, words, first in hashed_words(batch.column(1), lower=True):
                sets = distinct_shingles(words, first, size)
                n = np.array([len(s) for s in sets])
                elements = np.concatenate([*sets, np.zeros(0, np.uint64)])
                owner = np.repeat(np.arange(hi - lo), n)
                least = superminhash(elements, owner, hi - lo, slots)
                keys = scramble((scramble(least, 23).reshape(-1, bands, rows) * weights).sum(axis=2) + salts, 24)
                sketch = (scramble(least, 25) & np.uint64(255)).astype(np.uint8)
                sums = [np.zeros(hi - lo, np.uint64) for _ in range(2)]
                for k, total in enumerate(sums):
                    np.add.at(total, owner, scramble(elements, 26 + k))
                cuts = np.concatenate(([0], np.cumsum(np.where(n > 0, bands, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(n), *(pa.array(s.view(np.int64)) for s in sums),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(keys[n > 0].ravel().view(np.int64))),
                     pa.array([s.tobytes() if k else None for s, k in zip(sketch, n)], pa.binary())],
                    ["id", "n", "fa", "fb", "bands", "sketch"])

    return work


def _sets(size: int):
    def work(batches):
        import pyarrow as pa

        for batch in batches:
            for lo, hi, words, first in hashed_words(batch.column(1), lower=True):
                sets = distinct_shingles(words, first, size)
                cuts = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(sets).view(np.int64)))],
                    ["id", "members"])

    return work


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("members").alias("one"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("two"))
    both = F.size(F.array_intersect("one", "two"))
    return (pairs.join(left, "a").join(right, "b")
            .select("a", "b", both.alias("i"), (F.size("one") + F.size("two")).alias("t"))
            .where(F.lit(100).cast("long") * F.col("i") >= F.lit(percent) * (F.col("t") - F.col("i"))).select("a", "b"))


def _cross_links(slots: int, percent: int):
    """Links between members of one bucket's two blocks (key, i, j, side, id,
    comp, n, sketch, bands, members) that are in different components.

    Full sets confirm the pairs whose sizes and signatures allow the threshold:
    agreement not 5.5 standard deviations under it.  A pair that shares several
    bands is looked at in the first."""
    share = percent / 100
    least = math.floor(slots * share - 5.5 * math.sqrt(slots * share * (1 - share)))

    def work(table):
        import pyarrow as pa

        ids, comp, n, side = (np.asarray(table[c]) for c in ("id", "comp", "n", "side"))
        sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(len(ids), slots)
        bands = np.asarray(pa.concat_arrays(table["bands"].chunks).flatten()).reshape(len(ids), -1)
        band = int(np.flatnonzero(bands[0] == table["key"][0].as_py())[0])
        members = np.asarray(pa.concat_arrays(table["members"].chunks).flatten())
        cuts = np.concatenate(([0], np.cumsum(n)))
        same = table["i"][0].as_py() == table["j"][0].as_py()
        left, right = (np.arange(len(ids)),) * 2 if same else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        a, b = [], []
        for x in left:
            y = right[(comp[right] != comp[x]) & (100 * np.minimum(n[right], n[x]) >= percent * np.maximum(n[right], n[x]))]
            if same:
                y = y[y > x]
            y = y[(sketch[y] == sketch[x]).sum(axis=1) >= least]
            y = y[~(bands[y, :band] == bands[x, :band]).any(axis=1)]
            if not len(y):
                continue
            own = members[cuts[x]: cuts[x + 1]]
            others = np.concatenate([members[cuts[k]: cuts[k + 1]] for k in y])
            at = np.minimum(np.searchsorted(own, others), len(own) - 1)
            both = np.add.reduceat((own[at] == others).astype(np.int64), np.concatenate(([0], np.cumsum(n[y])[:-1])))
            y = y[100 * both >= percent * (n[x] + n[y] - both)]
            a.append(np.full(len(y), ids[x]))
            b.append(ids[y])
        none = [np.zeros(0, np.int64)]
        return pa.table({"a": np.concatenate(a or none), "b": np.concatenate(b or none)})

    return work


def minhash_components(df: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of
    at least ``percent`` / 100.

    Words are maximal runs without ASCII white space, with A-Z in lower case;
    a set holds the distinct runs of ``shingle`` words, or the whole sequence
    if there are fewer.  Returns ``id, n_shingles, component, kept``, one row
    per input row: component is the smallest id reachable, kept marks it.  A
    null or blank text has an empty set and is linked with nothing.  A row
    with a null id is linked with nothing, has a null component and is kept.
    Rows that repeat an id are one document, linked with whatever any of them
    is linked with.  Further columns are ignored.
    An empty table gives an empty result.

    A pair at exactly the threshold shares none of the 40 bands of 6 rows
    with a probability of 5e-6; above it, with less.  In buckets that are not
    one component after a comparison with their best-connected members, pairs
    whose signatures agree in 5.5 standard deviations less than the threshold
    asks for are not compared: 2e-8 of the pairs at the threshold.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    with arrow_rows(df.sparkSession, BATCH_ROWS):
        signed = written(docs.mapInArrow(_signatures(shingle, bands, rows), SIGNATURES), "signatures")
    same = ["n", "fa", "fb"]
    classes = written(signed.where("n > 0 and id is not null").groupBy(*same).agg(F.min("id").alias("rep")), "classes")
    # Rows that repeat id and set are dropped where the join has put them: band keys are shuffled once less.
    reps = signed.join(classes.select(F.col("rep").alias("id"), *same), ["id", *same]).dropDuplicates(["id", *same])
    keys = reps.select("id", F.explode("bands").alias("key"))
    crowds = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = written(keys.join(crowds, "key"), "shared")
    degree = shared.groupBy("id").agg(F.sum("size").alias("degree"))
    pivots = (shared.join(degree, "id").groupBy("key")
              .agg(F.max(F.struct("degree", "id"))["id"].alias("p1"), F.min("id").alias("p2")))
    pairs = (shared.select("key", "id").join(pivots, "key").select("id", F.explode(F.array("p1", "p2")).alias("p"))
             .where("id != p").select(F.least("id", "p").alias("a"), F.greatest("id", "p").alias("b")).distinct())
    pairs = written(pairs, "pairs")
    wanted = shared.select("id").distinct()
    with arrow_rows(df.sparkSession, BATCH_ROWS):
        sets = written(docs.join(wanted, "id").mapInArrow(_sets(shingle), "id long, members array<long>"), "sets")
    # Sets that share an id are one document's.
    several = signed.where("n > 0 and id is not null").groupBy("id").agg(F.min(F.struct(*same)).alias("one"), F.max(F.struct(*same)).alias("two")).where("one != two")
    several = written(several.select("id"), "several")
    found = _confirmed(pairs, sets, percent)
    if not several.isEmpty():
        held = signed.join(several, "id").join(classes, same).select("id", "rep")
        found = found.unionByName(held.join(held.groupBy("id").agg(F.min("rep").alias("a")), "id").select("a", F.col("rep").alias("b")))
    links = written(found, "links")
    roots = written(components(links), "roots")

    label = shared.join(roots.withColumnRenamed("node", "id"), "id", "left").select("key", "id", "size", F.coalesce("root", "id").alias("comp"))
    split = label.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1 and c0 is not null").select("key")
    open_ = written(label.where("size > 2").join(split, "key").distinct(), "open")
    if not open_.isEmpty():
        blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
        own = F.pmod(F.xxhash64("id"), blocks).cast("int")
        asked = open_.select("id").distinct()
        whole = (signed.select("id", "n", "sketch", "bands").join(asked, "id", "left_semi").dropDuplicates(["id", "bands"])
                 .join(sets.select("id", F.array_sort("members").alias("members")), "id").where(F.col("n") == F.size("members")))
        rest = (open_.select("key", "id", "comp", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("o"))
                .select("key", "id", "comp", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), (F.col("own") > F.col("o")).cast("int").alias("side"))
                .join(whole, "id").where(F.array_contains("bands", F.col("key"))))
        more = written(rest.groupBy("key", "i", "j").applyInArrow(_cross_links(bands * rows, percent), "a long, b long").distinct(), "links")
        if not more.isEmpty():
            # The components so far are stars, so only the new links need rounds.
            old, roots = roots, written(components(roots.toDF("a", "b").unionByName(more)), "roots")
            drop_written(old)
        drop_written(more)
    drop_written(shared, pairs, sets, links, open_, several)
    place = (classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
             .select(*same, F.coalesce("root", "rep").alias("component")))
    return (signed.select("id", *same).join(place, same, "left")
            .select("id", F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))
            .withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(True))))


def minhash_dedup(df: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: of each component
    the document with the smallest id, and every row that has no words or no
    id.  Rows that repeat an id stay or go together."""
    groups = minhash_components(df, shingle, percent, id_col=id_col, text_col=text_col)
    gone = groups.where("not kept").select(F.col("id").alias(id_col)).distinct()
    return df.join(gone, id_col, "left_anti")
