"""How the words of each source differ from those of its whole language.

Two parts.  ``pair``: the distance of every two sources of a language, summed
over the language's kept terms.  ``term``: the terms a source uses more than
its language, the most striking first.

A term beats another of the same group for certain (it *dominates* it) if its
count in the group is no lower, its count in the language no higher and its
UTF-8 form earlier: its value is then no lower and it wins the tie.  A term
with k dominators cannot be among the first k.  Each partition keeps the terms
that fewer than k others dominate (the k-skyband), skybands of several
partitions are merged into theirs, and only what is left is ranked.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabmeter.llm.tables import drop_written, partitions, written
from cabmeter.llm.textops import lower_ascii, row_chunks, utf8, word_spans

#: Every ASCII character but the letters ends a term.
NOT_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())
SCALE, PRIOR = 1_000_000_000, 5
CHUNK_BYTES = 4 << 20
BLOCK = 512
#: Cells (terms by sources) of one tile of the distance sums.
TILE_SOURCES, TILE_CELLS = 512, 1 << 21


def _counted(batches):
    """From batches (lang, source, text): how often each term occurs in a
    chunk's documents of each group, and in how many of them."""
    import pyarrow as pa

    for batch in batches:
        pairs = [c.dictionary_encode() for c in (batch.column(0), batch.column(1))]
        group = np.asarray(pairs[0].indices).astype(np.int64) * max(len(pairs[1].dictionary), 1) + np.asarray(pairs[1].indices)
        data, offsets = utf8(batch.column(2))
        for lo, hi in row_chunks(offsets, CHUNK_BYTES):
            part = lower_ascii(data[offsets[lo]: offsets[hi]])
            starts, ends, first = word_spans(part, offsets[lo: hi + 1] - offsets[lo], NOT_LETTERS)
            if not len(starts):
                continue
            inside = np.zeros(len(part) + 1, np.int8)
            inside[starts] = 1
            inside[ends] -= 1
            solid = part[np.cumsum(inside[:-1]).astype(bool)]
            cuts = np.concatenate(([0], np.cumsum(ends - starts)))
            terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(solid.tobytes())).dictionary_encode()
            code, n_terms = np.asarray(terms.indices).astype(np.int64), len(terms.dictionary)
            row = np.repeat(np.arange(hi - lo), np.diff(first))
            in_row, times = np.unique(row * n_terms + code, return_counts=True)
            key = group[lo + in_row // n_terms] * n_terms + in_row % n_terms
            order = np.argsort(key, kind="stable")
            key, times = key[order], times[order]
            heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            names = key[heads] // n_terms
            width = max(len(pairs[1].dictionary), 1)
            yield pa.RecordBatch.from_arrays(
                [pairs[0].dictionary.take(pa.array(names // width)), pairs[1].dictionary.take(pa.array(names % width)),
                 terms.dictionary.take(pa.array(key[heads] % n_terms)).cast(pa.string()),
                 pa.array(np.add.reduceat(times, heads)), pa.array(np.diff(np.append(heads, len(key))))],
                ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)`` of a frame (lang, source, text)
    without nulls."""
    counted = docs.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _rate(count: str, total: str, terms: str) -> F.Column:
    """The smoothed share in billionths, in exact decimals."""
    return F.expr(f"1 + ({SCALE}L * CAST({count} + {PRIOR} AS DECIMAL(20, 0))) div CAST({total} + {PRIOR} * {terms} AS DECIMAL(20, 0))")


def skyband(high: np.ndarray, low: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Rows that fewer than k others dominate (high no lower, low no higher,
    name earlier), in rank order.

    Only earlier rows of the order (high falling, low rising, name rising) can
    dominate.  Rows that are kept suffice to count by: of the dominators of
    any row, the first k are kept."""
    order = np.lexsort((name, low, -high))
    kept = np.zeros(0, np.int64)
    for lo in range(0, len(order), BLOCK):
        block = order[lo: lo + BLOCK]
        beaten = np.zeros(len(block), np.int64)
        for at in range(0, len(kept), 8 * BLOCK):
            old = kept[at: at + 8 * BLOCK]
            beaten += ((low[old] <= low[block, None]) & (name[old] < name[block, None])).sum(axis=1)
        block = block[beaten < k]
        beaten = beaten[beaten < k]
        within = (low[block] <= low[block, None]) & (name[block] < name[block, None])
        beaten += np.tril(within, -1).sum(axis=1)
        kept = np.concatenate((kept, block[beaten < k]))
    return kept


def _table_skyband(table, k: int):
    """The rows of one group's table that are in its skyband."""
    import pyarrow as pa
    import pyarrow.compute as pc

    name = np.empty(table.num_rows, np.int64)
    name[np.asarray(pc.sort_indices(table["term"]))] = np.arange(table.num_rows)
    return table.take(pa.array(skyband(np.asarray(table["n"]), np.asarray(table["lang_n"]), name, k)))


def _local_skyband(k: int, salts: int):
    """Skybands of the groups in each partition; batches of the same group
    are merged as they come."""
    def work(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % salts
        held: dict = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            codes = [c.combine_chunks().dictionary_encode() for c in (table["lang"], table["source"])]
            group = np.asarray(codes[0].indices).astype(np.int64) * len(codes[1].dictionary) + np.asarray(codes[1].indices)
            order = np.argsort(group, kind="stable")
            heads = np.flatnonzero(np.concatenate(([True], np.diff(group[order]) != 0)))
            for lo, hi in zip(heads, np.append(heads[1:], len(order))):
                own = table.take(pa.array(order[lo:hi]))
                key = own["lang"][0].as_py(), own["source"][0].as_py()
                if key in held:
                    own = pa.concat_tables([held[key], own])
                held[key] = _table_skyband(own, k)
        for own in held.values():
            yield from own.append_column("salt", pa.array(np.full(own.num_rows, salt, np.int32))).combine_chunks().to_batches()

    return work


def _merged_skyband(k: int):
    return lambda table: _table_skyband(table, k)


def striking_terms(rates: DataFrame, top: int) -> DataFrame:
    """The first ``top`` terms of each group that it uses more than its
    language; ``rates`` has lang, source, term, n, lang_n, p, q."""
    columns = "lang string, source string, term string, n long, lang_n long, p long, q long"
    ahead = rates.where("p > q").select("lang", "source", "term", "n", "lang_n", "p", "q")
    salts = max(1, round(partitions(ahead) ** 0.5))
    local = ahead.mapInArrow(_local_skyband(top, salts), columns + ", salt int")
    merged = local.groupBy("lang", "source", "salt").applyInArrow(lambda table: _table_skyband(table.drop_columns(["salt"]), top), columns)
    band = merged.groupBy("lang", "source").applyInArrow(_merged_skyband(top), columns)
    place = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return (band.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top))


def _tile(table):
    """Distance sums of the sources of one tile over one bucket of terms.
    A row without a term holds a source's rate of the terms it lacks."""
    import pyarrow as pa

    side, block = np.asarray(table["side"]), table["i"][0].as_py() != table["j"][0].as_py()
    term, source, p = table["term"].combine_chunks(), table["source"].combine_chunks().dictionary_encode(), np.asarray(table["p"])
    who, names = np.asarray(source.indices), source.dictionary
    blank = np.asarray(term.is_null())
    n_sources = len(names)
    base, right = np.zeros(n_sources, np.int64), np.zeros(n_sources, bool)
    base[who[blank]] = p[blank]
    right[who] = side == 1
    coded = term.filter(pa.array(~blank)).dictionary_encode()
    row = np.asarray(coded.indices)
    n_terms = len(coded.dictionary)
    sums = np.zeros((n_sources, n_sources), np.int64)
    step = max(1, TILE_CELLS // max(n_sources, 1))
    order = np.argsort(row, kind="stable")
    ranked, of, rate = row[order], who[~blank][order], p[~blank][order]
    for lo in range(0, n_terms, step):
        hi = min(lo + step, n_terms)
        a, b = np.searchsorted(ranked, (lo, hi))
        cells = np.repeat(base[:, None], hi - lo, axis=1)
        cells[of[a:b], ranked[a:b] - lo] = rate[a:b]
        for s in range(n_sources - 1):
            sums[s, s + 1:] += np.abs(cells[s + 1:] - cells[s]).sum(axis=1)
    sums += sums.T
    gaps = np.abs(base[:, None] - base)
    one, two = np.nonzero(right[:, None] != right if block else ~np.eye(n_sources, dtype=bool))
    lang = pa.array([table["lang"][0].as_py()] * len(one), pa.string())
    return pa.table({"lang": lang, "source": names.take(pa.array(one)), "item": names.take(pa.array(two)), "value": sums[one, two],
                     "seen": pa.array(np.full(len(one), n_terms)), "gap": gaps[one, two]})


def source_distances(rates: DataFrame, groups: DataFrame) -> DataFrame:
    """Every two sources of a language and their distance over its kept terms.

    ``rates``: lang, source, term, p.  ``groups``: lang, source, sources (how
    many the language has), terms (its kept ones), zero (the rate of a term
    that the group lacks).  Terms are dealt into buckets and sources into
    blocks, so that a tile is bounded; a language with few of both is one."""
    shape = (F.ceil(F.col("sources") / TILE_SOURCES).cast("int").alias("blocks"),
             F.greatest(F.lit(1), F.ceil(F.col("terms") * F.least("sources", F.lit(2 * TILE_SOURCES)) / TILE_CELLS)).cast("int").alias("buckets"))
    sized = groups.select("lang", "source", "zero", *shape)
    filled = (rates.join(sized.drop("zero"), ["lang", "source"])
              .select("lang", "source", "blocks", F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int").alias("bucket"), "term", "p"))
    empty = sized.select("lang", "source", "blocks", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"),
                         F.lit(None).cast("string").alias("term"), F.col("zero").alias("p"))
    tiles = (filled.unionByName(empty).withColumn("own", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("lang", "bucket", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), (F.col("own") > F.col("o")).cast("int").alias("side"),
                     "source", "term", "p"))
    sums = (tiles.groupBy("lang", "bucket", "i", "j").applyInArrow(_tile, "lang string, source string, item string, value long, seen long, gap long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"), F.first("gap").alias("gap")))
    whole = groups.select("lang", "source", "terms")
    place = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return (sums.join(whole, ["lang", "source"])
            .select("lang", "source", F.lit("pair").alias("part"), "item", (F.col("value") + (F.col("terms") - F.col("seen")) * F.col("gap")).alias("value"))
            .withColumn("rank", F.row_number().over(place)))


def source_divergence(df: DataFrame, least_docs: int = 30, top: int = 50, text_col: str = "text", lang_col: str = "lang",
                      source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank`` for each source of each
    language.

    Terms are maximal runs of ASCII letters and characters beyond ASCII, with
    A-Z in lower case.  A language keeps the terms that at least
    ``least_docs`` of its rows hold.  With V kept terms, of which a group has
    N occurrences, a term with c of them has the rate
    1 + floor(10^9 (c + 5) / (N + 5 V)).

    ``pair``: every other source of the language, by the sum of the absolute
    differences of both rates over all kept terms, all ranks.  ``term``: the
    terms that occur in the group with a higher rate than in the language, by
    the difference, the first ``top``.  Larger values come first, equal ones
    by the item's UTF-8 form.

    A null text, language or source is an empty one.  A row is a document,
    also if it repeats another.  A group without kept terms has pairs only; a
    language of one source, or without kept terms, has no terms, and its pairs
    have value 0.  Other columns are ignored.  An empty table gives an empty
    result.
    """
    docs = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    counts = written(term_counts(docs), "counts")
    kept = (counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("lang_docs"))
            .where(F.col("lang_docs") >= least_docs).drop("lang_docs"))
    held = written(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "held")
    per_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    per_group = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.groupBy("lang", "source").count().drop("count")
    n_sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = (groups.join(n_sources, "lang").join(per_lang, "lang", "left").join(per_group, ["lang", "source"], "left")
              .select("lang", "source", "sources", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("terms", "lang_total", "total"))))
    groups = written(groups.withColumn("zero", F.when(F.col("terms") > 0, _rate("0", "total", "terms")).otherwise(0)), "groups")
    rates = (held.join(groups.select("lang", "source", "terms", "lang_total", "total"), ["lang", "source"])
             .withColumn("p", _rate("n", "total", "terms")).withColumn("q", _rate("lang_n", "lang_total", "terms")))
    drop_written(counts)
    return (source_distances(rates.select("lang", "source", "term", "p"), groups)
            .unionByName(striking_terms(rates, top))
            .select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")))
