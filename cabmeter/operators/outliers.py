"""Outlier drill-down for all groups at once (§2.6).

Each row is tagged with the ids of every group it belongs to (groups
overlap) and exploded, then every report is one aggregate keyed by
``group_id``: one scan instead of nine per group.  Empty groups come back
with zero counts by a left join from the (six-row, broadcast) group list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..functions.quantiles import attach, multi_quantiles
from .rules import outlier_conditions
from .topk import hash_order


def _group_list(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(gid, label) for gid, label, _ in S.OUTLIER_GROUPS], "group_id INT, label STRING")


def tag_groups(df: DataFrame, **cols) -> DataFrame:
    """One row per (row, matching group)."""
    tags = F.array(*[F.when(cond, F.lit(gid)) for gid, _, cond in outlier_conditions(**cols)])
    return df.withColumn("group_id", F.explode(F.filter(tags, lambda t: t.isNotNull())))


def outlier_profile(df: DataFrame, method: str = "exact") -> DataFrame:
    """Per group: rows, percent of all rows, min/median/mean/max of duration
    and distance.

    Groups overlap, so rows are counted once, by the set of groups they are
    in (a bit mask), and the counts of the masks are added up into groups."""
    ids = [gid for gid, _, _ in S.OUTLIER_GROUPS]
    bits = [F.when(cond, F.lit(1 << ids.index(gid))).otherwise(F.lit(0)) for gid, _, cond in outlier_conditions()]
    masked = df.withColumn("_mask", sum(bits[1:], bits[0]))
    members = df.sparkSession.createDataFrame(
        [(mask, gid) for mask in range(1 << len(ids)) for k, gid in enumerate(ids) if mask >> k & 1], "_mask INT, group_id INT")
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    extra = [("trips", "count", None),
             ("dur_min", "min", S.DURATION), ("dur_mean", "avg", S.DURATION),
             ("dur_max", "max", S.DURATION),
             ("dist_min", "min", S.DISTANCE), ("dist_mean", "avg", S.DISTANCE),
             ("dist_max", "max", S.DISTANCE)]
    stats = multi_quantiles(masked.where("_mask > 0"), [(S.DURATION, 0.5, "dur_median"),
                                                        (S.DISTANCE, 0.5, "dist_median")], by=["_mask"],
                            method=method, extra=extra, groups=F.broadcast(members))
    out = attach(attach(F.broadcast(_group_list(df)), stats, ["group_id"]), total, [])
    trips = F.coalesce(F.col("trips"), F.lit(0)).cast("long")
    return out.select("group_id", "label", trips.alias("trips"),
                      C.pct(trips, F.col("_total")).alias("pct"),
                      "dur_min", "dur_median", "dur_mean", "dur_max",
                      "dist_min", "dist_median", "dist_mean", "dist_max")


def _distribution(tagged: DataFrame, key, name: str) -> DataFrame:
    counts = tagged.groupBy("group_id", key.alias(name)).agg(F.count(F.lit(1)).alias("cnt"))
    share = C.pct(F.col("cnt"), F.sum("cnt").over(Window.partitionBy("group_id")))
    return counts.withColumn("pct", share)


def outlier_passengers(df: DataFrame) -> DataFrame:
    """Passenger distribution per group (half-even INT), with share.
    The window runs over at most a few distinct counts per group."""
    return _distribution(tag_groups(df), C.half_even_int(S.PASSENGERS), "pax")


def outlier_years(df: DataFrame, ts: str = S.PICKUP) -> DataFrame:
    return _distribution(tag_groups(df), C.year_of(ts), "year")


def outlier_vendors(df: DataFrame) -> DataFrame:
    return _distribution(tag_groups(df), F.col(S.VENDOR), S.VENDOR)


def outlier_top_zones(df: DataFrame, n: int = 10) -> DataFrame:
    """Top n pickup and top n dropoff zones per group, with share of the
    group.  Ranked over zone counts (bounded by the number of zones)."""
    tagged = tag_groups(df)
    sides = F.explode(F.array(
        F.struct(F.lit("pickup").alias("side"), F.col(S.PU_ZONE).alias("zone")),
        F.struct(F.lit("dropoff").alias("side"), F.col(S.DO_ZONE).alias("zone"))))
    long = tagged.select("group_id", sides.alias("s")).select("group_id", "s.side", "s.zone")
    counts = long.groupBy("group_id", "side", "zone").agg(F.count(F.lit(1)).alias("cnt"))
    w_all = Window.partitionBy("group_id", "side")
    w_rank = w_all.orderBy(F.col("cnt").desc(), F.col("zone").asc_nulls_last())
    ranked = counts.select("group_id", "side", "zone", "cnt",
                           F.row_number().over(w_rank).alias("rank"),
                           C.pct(F.col("cnt"), F.sum("cnt").over(w_all)).alias("pct"))
    return ranked.where(F.col("rank") <= n)


def top_n_per_group(df: DataFrame, group: str, order, n: int,
                    tie: list[str] | None = None) -> DataFrame:
    """Exact top-n rows per group by ``order`` (then ``tie`` columns).

    Spark plans a partial window group limit before the shuffle: each input
    partition keeps at most n rows of a group, so a group holding a third of
    all rows never lands in one task.
    """
    w = Window.partitionBy(group).orderBy(
        F.col("_o").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in tie or []])
    return df.withColumn("_o", order).withColumn("rank", F.row_number().over(w)) \
             .where(F.col("rank") <= n).drop("_o")


def outlier_samples(df: DataFrame, n: int = 10, seed: int = 42) -> DataFrame:
    """n example rows per group, chosen by a seeded md5 of the row key."""
    tagged = tag_groups(df)
    top = top_n_per_group(tagged, "group_id", hash_order(seed), n,
                          tie=list(S.RAW_COLUMNS))
    return top.select("group_id", "rank", *S.RAW_COLUMNS)
