"""Sorts, limits, top-k and sampling (§2.5).

Global top-k is ``orderBy(...).limit(k)`` which Spark runs as
TakeOrderedAndProject: each partition keeps its own k rows, only those are
merged.  Ties are always broken by the key, so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from .profile import duration_by_hour, zone_duration


def busiest_hours(df: DataFrame, n: int = 5, ts: str = S.PICKUP,
                  value: str = S.DURATION) -> DataFrame:
    return duration_by_hour(df, ts, value).orderBy(F.col("trips").desc(), "hour").limit(n)


def zone_extremes(df: DataFrame, n: int = 10, min_trips: int = 5000,
                  zone: str = S.PU_ZONE, duration: str = S.DURATION) -> DataFrame:
    """The n zones with the longest and the n with the shortest mean
    duration; a zone can be in both lists when there are fewer than 2n."""
    z = zone_duration(df, min_trips, zone, duration)
    longest = z.orderBy(F.col("avg_dur").desc(), "zone").limit(n) \
               .withColumn("side", F.lit("longest"))
    shortest = z.orderBy(F.col("avg_dur").asc(), "zone").limit(n) \
                .withColumn("side", F.lit("shortest"))
    return longest.unionByName(shortest).select("side", "zone", "avg_dur", "trips")


def busiest_quietest_month(df: DataFrame, year: str = S.YEAR, month: str = S.MONTH,
                           duration: str = S.DURATION) -> DataFrame:
    """Month with most / fewest trips (ties: earliest) and the range of the
    monthly mean duration."""
    m = df.groupBy(year, month).agg(F.count(F.lit(1)).alias("trips"),
                                   F.avg(duration).alias("avg_dur"))
    m = m.withColumn("period", C.period_label(year, month))
    most = F.struct(F.col("trips"), -F.col(year), -F.col(month))
    fewest = F.struct(F.col("trips"), F.col(year), F.col(month))
    return m.agg(F.max_by("period", most).alias("busiest_period"),
                 F.max("trips").alias("busiest_trips"),
                 F.min_by("period", fewest).alias("quietest_period"),
                 F.min("trips").alias("quietest_trips"),
                 F.min("avg_dur").alias("min_avg_dur"),
                 F.max("avg_dur").alias("max_avg_dur"))


def row_key(cols: Sequence[str] = (S.PICKUP, S.DROPOFF, S.PU_ZONE, S.DO_ZONE, S.VENDOR)):
    """Text key of a trip built from columns whose text form is the same in
    every SQL engine (timestamps and integers)."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def hash_order(seed: int = 42, key_cols: Sequence[str] | None = None):
    key = row_key(key_cols) if key_cols else row_key()
    return F.md5(F.concat(F.lit(f"{seed}|"), key))


def sample_rows(df: DataFrame, n: int = 10, seed: int = 42, method: str = "hash",
                key_cols: Sequence[str] | None = None) -> DataFrame:
    """n example rows.  ``hash``: ordered by a seeded md5 of the row key
    (repeatable, engine-independent); ``random``: ``rand(seed)``."""
    order = hash_order(seed, key_cols) if method == "hash" else F.rand(seed)
    tie = [F.col(c).asc_nulls_first() for c in df.columns]
    return df.withColumn("_o", order).orderBy("_o", *tie).limit(n).drop("_o")
