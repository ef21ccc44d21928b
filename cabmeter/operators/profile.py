"""Aggregations and profiles (§2.4).

Every report is a grouped or global aggregate with map-side partial
aggregation; quantiles go through ``functions.quantiles`` so no group is
ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..functions.quantiles import attach, quantiles
from ..session import scratch_path

PROFILE_PROBS = [0.01, 0.25, 0.5, 0.75, 0.95, 0.99]
PROFILE_NAMES = ["p01", "p25", "median", "p75", "p95", "p99"]


def trips_by_year(df: DataFrame, ts: str = S.PICKUP) -> DataFrame:
    return df.groupBy(C.year_of(ts).alias("year")).agg(F.count(F.lit(1)).alias("trips"))


def datetime_range(df: DataFrame, pickup: str = S.PICKUP, dropoff: str = S.DROPOFF) -> DataFrame:
    return df.agg(F.min(pickup).alias("min_pickup"), F.max(pickup).alias("max_pickup"),
                  F.min(dropoff).alias("min_dropoff"), F.max(dropoff).alias("max_dropoff"))


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs and percent per column, one pass, unpivoted."""
    fields = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}")
                   for i, c in enumerate(fields)])
    rows = ", ".join(f"{i + 1}, '{c}', n{i}" for i, c in enumerate(fields))
    long = agg.selectExpr("_total", f"stack({len(fields)}, {rows}) AS (position, column_name, null_count)")
    return long.select("position", "column_name", "null_count",
                       C.pct(F.col("null_count"), F.col("_total")).alias("null_pct"))


def null_total(df: DataFrame) -> DataFrame:
    """Sum of NULLs over all columns."""
    total = None
    for c in df.columns:
        n = F.count_if(F.col(f"`{c}`").isNull())
        total = n if total is None else total + n
    return df.agg(total.alias("null_total"))


def numeric_profile(df: DataFrame, value: str, probs: Sequence[float] = PROFILE_PROBS,
                    names: Sequence[str] = PROFILE_NAMES, by: Sequence[str] = (),
                    method: str = "exact") -> DataFrame:
    """min, quantiles, mean, max (and row count) of one column."""
    by = list(by)
    extra = [("min", "min", value), ("mean", "avg", value), ("max", "max", value),
             ("n", "count", value)]
    q = quantiles(df, value, probs, names, by=by, method=method, extra=extra)
    return q.select(*by, "n", "min", *names, "mean", "max")


def duration_profile(df: DataFrame, duration: str = S.DURATION, method: str = "exact") -> DataFrame:
    return numeric_profile(df, duration, method=method)


def distance_profile(df: DataFrame, distance: str = S.DISTANCE, method: str = "exact") -> DataFrame:
    return numeric_profile(df, distance, method=method)


def distinct_zones(df: DataFrame, pickup_zone: str = S.PU_ZONE, dropoff_zone: str = S.DO_ZONE,
                   approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    if approximate:
        return df.agg(F.approx_count_distinct(pickup_zone, rsd).alias("pickup_zones"),
                      F.approx_count_distinct(dropoff_zone, rsd).alias("dropoff_zones"))
    return df.agg(F.count_distinct(pickup_zone).alias("pickup_zones"),
                  F.count_distinct(dropoff_zone).alias("dropoff_zones"))


def value_counts(df: DataFrame, column: str = S.VENDOR) -> DataFrame:
    """Frequency, share and number of distinct values of one column."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("trips"))
    totals = counts.agg(F.sum("trips").alias("_total"), F.count(F.lit(1)).alias("n_distinct"))
    out = attach(counts, totals, [])
    return out.select("value", "trips", C.pct(F.col("trips"), F.col("_total")).alias("pct"),
                      "n_distinct")


def long_haul_distribution(df: DataFrame, flag: str = S.LONG_HAUL) -> DataFrame:
    counts = df.groupBy(F.col(flag).alias(flag)).agg(F.count(F.lit(1)).alias("trips"))
    total = counts.agg(F.sum("trips").alias("_total"))
    out = attach(counts, total, [])
    label = F.when(F.col(flag) == 1, F.lit(S.LONG_HAUL_LABELS[1])).otherwise(F.lit(S.LONG_HAUL_LABELS[0]))
    return out.select(flag, label.alias("label"), "trips",
                      C.pct(F.col("trips"), F.col("_total")).alias("pct"))


# ---------------------------------------------------------------------------
# Duplicates: all-column groups; partial aggregation collapses a hot group
# on the map side, so even one group holding a third of all rows is cheap.
# ---------------------------------------------------------------------------
def _group_counts(df: DataFrame, cols: Sequence[str] | None, by: Sequence[str] = ()) -> DataFrame:
    cols = list(cols or [c for c in df.columns if c not in by])
    return df.groupBy(*by, *cols).agg(F.count(F.lit(1)).alias("cnt"))


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None,
                    by: Sequence[str] = ()) -> DataFrame:
    """Surplus rows of all-column duplicate groups (NULLs compare equal)."""
    by = list(by)
    g = _group_counts(df, cols, by)
    dups = g.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col("cnt") > 1, F.col("cnt") - 1)), F.lit(0)).cast("long")
        .alias("duplicate_rows"),
        F.count_if(F.col("cnt") > 1).alias("duplicate_groups"),
        F.sum("cnt").cast("long").alias("total_rows"))
    return dups.select(*by, "duplicate_rows", "duplicate_groups", "total_rows",
                       C.pct(F.col("duplicate_rows"), F.col("total_rows")).alias("duplicate_pct"))


def duplicate_groups(df: DataFrame, n: int = 5, cols: Sequence[str] | None = None) -> DataFrame:
    """``n`` example duplicate groups with their multiplicity; deterministic
    order (largest first, then by the columns)."""
    cols = list(cols or df.columns)
    g = _group_counts(df, cols).where(F.col("cnt") > 1)
    return g.orderBy(F.col("cnt").desc(), *[F.col(f"`{c}`").asc_nulls_first() for c in cols]).limit(n)


def row_print(cols: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes (``_p1``, ``_p2``) of the columns' values.  Which are
    NULL is hashed with them, since Spark's hash passes NULLs over."""
    held = [F.col(f"`{c}`") for c in cols]
    nulls = [c.isNull() for c in held]
    return [F.xxhash64(*nulls, *held).alias("_p1"), F.xxhash64(F.lit(1), *held[::-1], *nulls).alias("_p2")]


def repeated_rows(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The all-column groups of two rows or more, with their size ``cnt``.

    Made for wide rows that seldom repeat: the first pass shuffles 16 bytes a
    row (and ``by``) instead of the columns, and writes the prints that occur
    twice; only rows with such a print are then grouped by the columns
    themselves, so two rows that merely share a print stay apart.  The written
    table has a known size, by which Spark broadcasts it or shuffles."""
    by = list(by)
    cols = list(cols or [c for c in df.columns if c not in by])
    rows = df.select(*by, *[F.col(f"`{c}`") for c in cols], *row_print([*by, *cols]))
    prints = rows.groupBy("_p1", "_p2").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_p1", "_p2")
    path = scratch_path(df.sparkSession, "row_prints")
    prints.write.parquet(path)
    shared = df.sparkSession.read.schema(prints.schema).parquet(path)
    return _group_counts(rows.join(shared, ["_p1", "_p2"], "left_semi").drop("_p1", "_p2"), cols, by).where(F.col("cnt") > 1)


def duplicate_count_wide(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """``duplicate_count`` for wide rows, by ``repeated_rows``; each value of
    ``by`` has a row, with or without duplicates."""
    by = list(by)
    groups = repeated_rows(df, cols, by).groupBy(*by).agg(F.sum(F.col("cnt") - 1).alias("_surplus"), F.count(F.lit(1)).alias("_groups"))
    total = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total_rows"))
    out = attach(total, groups, by)
    surplus = F.coalesce(F.col("_surplus"), F.lit(0)).cast("long")
    return out.select(*by, surplus.alias("duplicate_rows"), F.coalesce(F.col("_groups"), F.lit(0)).cast("long").alias("duplicate_groups"),
                      "total_rows", C.pct(surplus, F.col("total_rows")).alias("duplicate_pct"))


def duplicate_reconcile(df: DataFrame, split_col: str = "split",
                        cols: Sequence[str] | None = None) -> DataFrame:
    """Duplicates of the whole table against the sum over its splits."""
    cols = list(cols or [c for c in df.columns if c != split_col])
    whole = duplicate_count(df, cols).select(F.col("duplicate_rows").alias("source_duplicates"))
    per = duplicate_count(df, cols, by=[split_col]) \
        .agg(F.coalesce(F.sum("duplicate_rows"), F.lit(0)).cast("long").alias("split_duplicates"))
    out = attach(whole, per, [])
    return out.withColumn("equal", F.col("source_duplicates") == F.col("split_duplicates"))


def dedup_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per all-column group."""
    return df.dropDuplicates(list(cols) if cols else None)


# ---------------------------------------------------------------------------
# Duration by dimension.
# ---------------------------------------------------------------------------
def _mean_count(df: DataFrame, keys: Sequence[Column], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias("avg_dur"), F.count(F.lit(1)).alias("trips"))


def duration_by_hour(df: DataFrame, ts: str = S.PICKUP, value: str = S.DURATION) -> DataFrame:
    return _mean_count(df, [C.hour_of(ts).alias("hour")], value)


def duration_by_dow(df: DataFrame, ts: str = S.PICKUP, value: str = S.DURATION) -> DataFrame:
    out = _mean_count(df, [C.dow_sunday0(ts).alias("dow")], value)
    return out.select("dow", C.weekday_name_sunday0("dow").alias("day"), "avg_dur", "trips")


def duration_by_month(df: DataFrame, ts: str = S.PICKUP, value: str = S.DURATION) -> DataFrame:
    out = _mean_count(df, [C.year_of(ts).alias("year"), C.month_of(ts).alias("month")], value)
    return out.select("year", "month", C.period_label("year", "month").alias("period"),
                      "avg_dur", "trips")


def month_extremes(df: DataFrame, ts: str = S.PICKUP, value: str = S.DURATION) -> DataFrame:
    """Months with the lowest and highest mean duration (ties: earliest)."""
    m = duration_by_month(df, ts, value)
    key_min = F.struct(F.col("avg_dur"), F.col("year"), F.col("month"))
    key_max = F.struct(F.col("avg_dur"), -F.col("year"), -F.col("month"))
    return m.agg(F.min("avg_dur").alias("min_avg_dur"),
                 F.min_by("period", key_min).alias("min_period"),
                 F.max("avg_dur").alias("max_avg_dur"),
                 F.max_by("period", key_max).alias("max_period"))


def distance_duration_corr(df: DataFrame, distance: str = S.DISTANCE,
                           duration: str = S.DURATION) -> DataFrame:
    return df.agg(F.corr(distance, duration).alias("pearson_r"))


def duration_by_distance_group(df: DataFrame, distance: str = S.DISTANCE,
                               duration: str = S.DURATION) -> DataFrame:
    out = df.groupBy(C.distance_group(distance).alias("dist_group")).agg(
        F.avg(duration).alias("avg_dur"), F.count(F.lit(1)).alias("trips"),
        F.min(distance).alias("min_distance"))
    return out.orderBy(F.col("min_distance").asc_nulls_last(), "dist_group")


def zone_duration(df: DataFrame, min_trips: int = 5000, zone: str = S.PU_ZONE,
                  duration: str = S.DURATION) -> DataFrame:
    out = df.groupBy(F.col(zone).alias("zone")).agg(
        F.avg(duration).alias("avg_dur"), F.count(F.lit(1)).alias("trips"))
    return out.where(F.col("trips") >= min_trips)


def duration_by_passengers(df: DataFrame, passengers: str = S.PASSENGERS,
                           duration: str = S.DURATION) -> DataFrame:
    """1-6 passengers; the range filter runs before the half-even cast."""
    kept = df.where(F.col(passengers).between(1, 6))
    return _mean_count(kept, [C.half_even_int(passengers).alias("pax")], duration)


def duration_by_vendor(df: DataFrame, vendor: str = S.VENDOR, duration: str = S.DURATION,
                       method: str = "exact") -> DataFrame:
    med = quantiles(df, duration, [0.5], ["median_dur"], by=[vendor], method=method,
                    extra=[("avg_dur", "avg", duration), ("trips", "count", None)])
    return med.select(vendor, "avg_dur", "median_dur", "trips")


def duration_histogram(df: DataFrame, duration: str = S.DURATION, lo: float = 0.0,
                       hi: float = 120.0, zoom_max: int = 30) -> DataFrame:
    """1-minute bins on [lo, hi] (inclusive); ``in_zoom`` marks bins <= zoom_max."""
    d = F.col(duration)
    out = df.where(d.between(lo, hi)).groupBy(F.floor(d).cast("int").alias("bucket")) \
            .agg(F.count(F.lit(1)).alias("trips"))
    return out.withColumn("in_zoom", F.col("bucket") <= zoom_max)


def monthly_stats(df: DataFrame, year: str = S.YEAR, month: str = S.MONTH,
                  duration: str = S.DURATION, distance: str = S.DISTANCE,
                  method: str = "exact") -> DataFrame:
    by = [year, month]
    out = quantiles(df, duration, [0.5, 0.95], ["med_dur", "p95_dur"], by=by, method=method,
                    extra=[("trips", "count", None), ("avg_dur", "avg", duration),
                           ("avg_dist", "avg", distance)])
    return out.select(F.col(year).alias("yr"), F.col(month).alias("mo"), "trips", "avg_dur",
                      "med_dur", "p95_dur", "avg_dist")


def period_consistency(df: DataFrame, year: str = S.YEAR, month: str = S.MONTH,
                       duration: str = S.DURATION, distance: str = S.DISTANCE,
                       method: str = "exact") -> DataFrame:
    """Per half-year: count, mean, p25, p50, p75, p95, mean distance."""
    half = F.when(F.col(month) <= 6, F.lit("H1")).otherwise(F.lit("H2"))
    labelled = df.select(F.concat_ws(" ", F.col(year).cast("string"), half).alias("period"),
                         duration, distance)
    q = quantiles(labelled, duration, [0.25, 0.5, 0.75, 0.95], ["p25", "p50", "p75", "p95"],
                  by=["period"], method=method,
                  extra=[("trips", "count", None), ("avg_dur", "avg", duration),
                         ("avg_dist", "avg", distance)])
    return q.select("period", "trips", "avg_dur", "p25", "p50", "p75", "p95", "avg_dist")
