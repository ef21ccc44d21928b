"""Benchmark passages found in documents by SimHash windows.

Only Spark expressions.  Windows of a document that have as many words as a
benchmark item get a SimHash of their words.  A multi-index over blocks of
the fingerprints (one block more than the radius has bits) finds every item
within the radius, since some block must then be equal.  Candidates are
verified by the weighted Jaccard similarity of their five-word shingles.

Fingerprints of all windows of a corpus would cost a thousand times its
reading.  A window that can pass must share most of the item's shingles, so
only windows around shared shingles are made; ``_stride`` says how far apart
shingles may be looked up without passing over such a window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.tables import written

SHINGLE = 5
RADIUS = 15
BLOCK_BITS = 4
BROADCAST_ROWS = 500_000
BROADCAST_WINDOWS = 2_000_000
LANES = 0x0001000100010001


def words(text: Column) -> Column:
    """Lower-case words: maximal runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingle_count(n: Column) -> Column:
    return F.greatest(n - (SHINGLE - 1), F.lit(1))


def _missing(m: int, least: float) -> int:
    """How many of a window's m shingles an item may lack at most."""
    return m - math.ceil(round(2 * least / (1 + least) * m, 9))


def _stride(low: int, high: int, least: float) -> int:
    """Any window with low to high shingles that passes has a run of so many
    consecutive shingles of the item."""
    return max(1, min(math.ceil((m - k) / (k + 1)) for m in range(low, high + 1) for k in [_missing(m, least)]))


def simhash(array: Column) -> Column:
    """64-bit SimHash of an array of words, each occurrence of weight 1.

    Sixteen sums of four 16-bit lanes count, for every bit, the words whose
    hash has it."""
    hashes = F.transform(array, lambda w: F.xxhash64(w))

    def lane(k):
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(LANES)))

    def fingerprint(lanes):
        def bit(so_far, b):
            votes = F.call_function("shiftrightunsigned", F.element_at(lanes, b % 16 + 1), F.floor(b / 16).cast("int") * 16).bitwiseAND(F.lit(0xFFFF))
            one = F.call_function("shiftleft", F.lit(1).cast("long"), b)
            return so_far.bitwiseOR(F.when(votes * 2 > F.size(array), one).otherwise(F.lit(0).cast("long")))

        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), bit)

    # The lanes are an array in an array, so that they are summed once and not for every bit.
    return F.transform(F.array(F.array(*map(lane, range(16)))), fingerprint)[0]


def with_simhash(df: DataFrame, array: str) -> DataFrame:
    return df.withColumn("fingerprint", simhash(F.col(array)))


def _blocks(n: Column, fingerprint: Column) -> Column:
    """Keys of the index: size, block and the block's bits."""
    count, mask = 64 // BLOCK_BITS, (1 << BLOCK_BITS) - 1
    return F.array(*((n.cast("long") * count + b) * (mask + 1) + F.shiftrightunsigned(fingerprint, b * BLOCK_BITS).bitwiseAND(F.lit(mask))
                     for b in range(count)))


def _shingles(array: Column, size: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), shingle_count(size)), lambda i: F.array_join(F.slice(array, i, SHINGLE), " "))


def _weighted(one: Column, two: Column) -> Column:
    """Weighted Jaccard similarity of two bags of shingles."""
    def least(a, s):
        return a + F.least(F.size(F.filter(one, lambda x: x == s)), F.size(F.filter(two, lambda x: x == s)))

    plain = (F.size(F.array_distinct(one)) == F.size(one)) & (F.size(F.array_distinct(two)) == F.size(two))
    both = F.when(plain, F.size(F.array_intersect(one, two))).otherwise(F.aggregate(F.array_distinct(one), F.lit(0), least))
    return F.transform(F.array(both), lambda i: i / (F.size(one) + F.size(two) - i))[0]


def _first_equal_block(xor: Column) -> Column:
    """The lowest bit of the first block of BLOCK_BITS in which two
    fingerprints agree, from their difference."""
    ones = sum(1 << (BLOCK_BITS * b) for b in range(64 // BLOCK_BITS))
    any_bit = xor
    for k in range(1, BLOCK_BITS):
        any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(xor, k))
    zero = F.bitwise_not(any_bit).bitwiseAND(F.lit(ones))
    return zero.bitwiseAND(-zero)


def _small(df: DataFrame) -> DataFrame:
    """``df`` (a written table) marked for broadcast if it is of a bounded
    size; beyond it the join is an ordinary one."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def contamination(df: DataFrame, benchmark: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(id, item, similarity)`` for every document and benchmark item where
    an item-sized window of the document has a weighted shingle similarity of
    at least ``least``; similarity is the highest of all windows.

    Words are lower-case runs of letters and digits; a shingle is five words,
    or the whole sequence if that is shorter; its weight is how often it
    occurs.  A document shorter than the item is one window.  A null or empty
    text or item matches nothing; rows with a null id are left out; rows that
    repeat an id count as one document; of items that repeat an id each is
    looked for.  Further columns are ignored.  Empty tables give an empty
    result.
    """
    share = 2 * least / (1 + least)
    items = (benchmark.select(F.col(item_col).cast("long").alias("item"), words(F.col(item_text_col)).alias("item_words"))
             .withColumn("n", F.size("item_words")).where("n > 0").withColumn("m", shingle_count(F.col("n"))).distinct())
    items = written(with_simhash(items, "item_words").withColumn("item_shingles", _shingles(F.col("item_words"), F.col("n"))), "items")
    low, high = items.agg(F.min("m"), F.max("m")).first()
    stride = _stride(max(1, math.ceil(low * least)), high, least) if low else 1
    known = written(items.select("item", "n", "m", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("m")), lambda i: F.xxhash64(F.slice("item_words", i, SHINGLE)))).alias("h")).distinct(), "known")

    texts = (df.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).cast("long").alias("id"), words(F.col(text_col)).alias("words")))
    looked = (texts.where("size(words) > 0").withColumn("size", F.size("words"))
              .select("id", "size", F.explode(F.transform(
                  F.sequence(F.lit(0), F.greatest(F.col("size") - SHINGLE, F.lit(0)), F.lit(stride)),
                  lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice("words", i + 1, SHINGLE)).alias("h")))).alias("s"))
              .select("id", "size", "s.at", "s.h"))
    # Items shorter than a shingle: slices of their sizes are looked up too, at
    # every place; the first is enough, since only equal ones pass.
    short = [r.n for r in items.where(F.col("n") < SHINGLE).select("n").distinct().collect()]
    if short:
        slices = F.flatten(F.array(*(F.when(F.col("size") > n, F.transform(
            F.sequence(F.lit(0), F.greatest(F.col("size") - n, F.lit(0))),
            lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice("words", i + 1, n)).alias("h"), F.lit(n).alias("k"))))
            .otherwise(F.array().cast("array<struct<at:int,h:bigint,k:int>>")) for n in sorted(short))))
        within = (texts.where("size(words) > 0").withColumn("size", F.size("words"))
                  .select("id", "size", F.explode(slices).alias("s")).select("id", "size", "s.at", "s.h", "s.k"))
    hits = looked.join(_small(known), "h").groupBy("id", "size", "item", "n", "m").agg(F.collect_set("at").alias("ats"))
    if short:
        whole = within.join(_small(known.where(F.col("n") < SHINGLE).withColumnRenamed("n", "k")), ["h", "k"])
        hits = hits.unionByName(whole.select("id", "size", "item", F.col("k").alias("n"), "m", "at")
                                .groupBy("id", "size", "item", "n", "m").agg(F.array(F.min("at")).alias("ats")))
    here = F.least("m", shingle_count(F.col("size")))  # shingles of a window
    lack = here - F.ceil(F.round(here * F.lit(share), 9)).cast("int")
    need = F.greatest(F.lit(1), F.floor(here / stride).cast("int") - lack)
    last = F.greatest(F.col("size") - F.col("n"), F.lit(0))
    starts = F.array_distinct(F.flatten(F.transform("ats", lambda p: F.sequence(
        F.greatest(p - here + 1, F.lit(0)), F.greatest(F.least(p, last), F.least(F.greatest(p - here + 1, F.lit(0)), last))))))
    enough = F.filter("starts", lambda s: F.size(F.filter("ats", lambda p: (p >= s) & (p < s + here))) >= F.col("need"))
    windows = (hits.withColumn("need", need).where(F.size("ats") >= F.col("need")).withColumn("starts", starts)
               .select("id", F.explode(F.transform(enough, lambda s: F.struct(s.alias("start"), F.col("n").alias("n")))).alias("w"))
               .groupBy("id").agg(F.collect_set("w").alias("windows")))
    windows = written(windows, "windows")

    amount = windows.agg(F.sum(F.size("windows"))).first()[0] or 0
    near = F.broadcast(windows) if amount <= BROADCAST_WINDOWS else windows
    cut = (df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(near, "id")
           .select("id", words(F.col("text")).alias("words"), "windows")
           .select("id", F.explode(F.transform("windows", lambda w: F.struct(
               w["start"].alias("start"), w["n"].alias("n"), F.slice("words", w["start"] + 1, w["n"]).alias("words")))).alias("w"))
           .select("id", "w.*"))
    marked = with_simhash(cut, "words")
    marked = marked.select("id", "start", "n", "words", "fingerprint", F.posexplode(_blocks(F.col("n"), F.col("fingerprint"))).alias("block", "key"))
    index = written(items.select("item", F.col("fingerprint").alias("item_print"), F.explode(_blocks(F.col("n"), F.col("fingerprint"))).alias("key")), "index")
    xor = F.col("fingerprint").bitwiseXOR(F.col("item_print"))
    # A pair that agrees in several blocks is taken at the first of them.
    close = (marked.join(_small(index), "key")
             .where((F.bit_count(xor) <= RADIUS) & (_first_equal_block(xor) == F.call_function("shiftleft", F.lit(1).cast("long"), F.col("block") * BLOCK_BITS)))
             .select("id", "item", "item_print", "words"))
    bags = items.select("item", F.col("fingerprint").alias("item_print"), "item_shingles")
    exact = (close.join(_small(bags), ["item", "item_print"])
             .select("id", "item", _weighted(F.col("item_shingles"), _shingles(F.col("words"), F.size("words"))).alias("similarity")))
    return exact.groupBy("id", "item").agg(F.max("similarity").alias("similarity")).where(F.col("similarity") >= least)


def contaminated(df: DataFrame, benchmark: DataFrame, least: float = 0.8, id_col: str = "doc_id", **columns) -> DataFrame:
    """One row per input row: ``id, n_items, best_item, best_similarity,
    contaminated``.  best_item is the smallest of the most similar items;
    both are null where no item is found.  Rows with a null id have none."""
    found = contamination(df, benchmark, least, id_col, **columns)
    best = found.groupBy("id").agg(F.count("*").alias("n_items"), F.max(F.struct("similarity", (-F.col("item")).alias("item"))).alias("best"))
    return (df.select(F.col(id_col).cast("long").alias("id")).join(best, "id", "left")
            .select("id", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), (-F.col("best.item")).alias("best_item"),
                    F.round("best.similarity", 6).alias("best_similarity"), F.col("best").isNotNull().alias("contaminated")))


def decontaminate(df: DataFrame, benchmark: DataFrame, least: float = 0.8, id_col: str = "doc_id", **columns) -> DataFrame:
    """The rows of ``df`` without a benchmark passage, all columns kept."""
    found = written(contamination(df, benchmark, least, id_col, **columns).select(F.col("id").alias(id_col)).distinct(), "contaminated")
    return df.join(found, id_col, "left_anti")
