"""Connected components of a link table by alternating star steps.

Large-star then small-star (Kiveris et al., "Connected Components in
MapReduce and Beyond"): every round is a few aggregates and key joins, each
frame is linear in the links, and no task or driver ever holds a component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.tables import drop_written, written


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every linked node that is not the smallest of its
    component; root is the smallest.  Links with a null end, self links and
    repeats count for nothing."""
    links = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    links = written(links, "links")
    before = _state(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u != v").distinct())
        new = written(small, "links")
        drop_written(links)
        links, now = new, _state(new)
        if now == before:
            break
        before = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
