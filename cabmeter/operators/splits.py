"""Temporal splits (§2.7): one ``split`` column instead of three re-scans,
reports as grouped aggregates keyed by the split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..functions.quantiles import attach, multi_quantiles, quantiles
from .profile import duplicate_count

SPLITS = ("train", "validation", "test")


def _ym(year: str, month: str) -> Column:
    return F.col(year) * 100 + F.col(month)


def temporal_split(df: DataFrame, train_end: tuple[int, int] = (2024, 1),
                   validation_end: tuple[int, int] = (2024, 7),
                   start: tuple[int, int] | None = (2023, 1),
                   end: tuple[int, int] | None = (2025, 1),
                   year: str = S.YEAR, month: str = S.MONTH, out: str = "split") -> DataFrame:
    """Label rows by (year, month) cut-offs, each bound exclusive:
    train = [start, train_end), validation = [train_end, validation_end),
    test = [validation_end, end).  Rows outside get NULL."""
    ym = _ym(year, month)

    def code(t):
        return F.lit(t[0] * 100 + t[1])

    inside = F.lit(True)
    if start is not None:
        inside = inside & (ym >= code(start))
    if end is not None:
        inside = inside & (ym < code(end))
    label = (F.when(~inside, F.lit(None).cast("string"))
             .when(ym < code(train_end), F.lit("train"))
             .when(ym < code(validation_end), F.lit("validation"))
             .otherwise(F.lit("test")))
    return df.withColumn(out, label)


def split_report(df: DataFrame, split: str = "split", method: str = "exact") -> DataFrame:
    """Per split: rows, share of all rows, first and last pickup hour,
    min/median/mean/max of duration and distance, NULLs and duplicates."""
    data_cols = [c for c in df.columns if c != split]
    nulls = None
    for c in data_cols:
        n = F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0)
        nulls = n if nulls is None else nulls + n
    rows = df.select(split, S.DURATION, S.DISTANCE, nulls.cast("long").alias("_nulls"),
                     C.pickup_hour_start(S.YEAR, S.MONTH, S.DAY, S.HOUR).alias("_first"),
                     C.pickup_hour_end(S.YEAR, S.MONTH, S.DAY, S.HOUR).alias("_last"))
    # All figures but the duplicates come from the first scan of the quantiles.
    base = multi_quantiles(rows, [(S.DURATION, 0.5, "dur_median"), (S.DISTANCE, 0.5, "dist_median")],
                           by=[split], method=method, extra=[
                               ("rows", "count", None), ("first_hour", "min", "_first"), ("last_hour", "max", "_last"),
                               ("dur_min", "min", S.DURATION), ("dur_mean", "avg", S.DURATION), ("dur_max", "max", S.DURATION),
                               ("dist_min", "min", S.DISTANCE), ("dist_mean", "avg", S.DISTANCE), ("dist_max", "max", S.DISTANCE),
                               ("nulls", "sum", "_nulls")])
    dups = duplicate_count(df, data_cols, by=[split]).select(split, "duplicate_rows")
    out = attach(base, dups, [split])
    out = attach(out, base.agg(F.sum("rows").alias("_total")), [])
    share = C.pct(F.col("rows"), F.col("_total"))
    return out.select(split, "rows", share.alias("share"), "first_hour", "last_hour",
                      "dur_min", "dur_median", "dur_mean", "dur_max",
                      "dist_min", "dist_median", "dist_mean", "dist_max",
                      "nulls", F.col("duplicate_rows").alias("duplicates"))


def _check(i: int, text: str, earlier: str, later: str) -> Column:
    return F.struct(F.lit(i).alias("check_id"), F.lit(text).alias("check"),
                    F.col(earlier).cast("string").alias("left_value"),
                    F.col(later).cast("string").alias("right_value"),
                    F.coalesce(F.col(earlier) < F.col(later), F.lit(False)).alias("ok"))


def split_integrity(df: DataFrame, split: str = "split", strict: bool = False,
                    source: DataFrame | None = None) -> DataFrame:
    """Checks: split rows sum to the rows of ``source`` (``df`` itself if not
    given); train ends before validation starts; validation ends before test
    starts.  An empty split fails its order check.  ``strict`` turns a failed
    check into a job error.

    With the written splits as ``df`` and the frame they were cut from as
    ``source``, the first check sees rows lost on the way."""
    hs = C.pickup_hour_start(S.YEAR, S.MONTH, S.DAY, S.HOUR)
    he = C.pickup_hour_end(S.YEAR, S.MONTH, S.DAY, S.HOUR)
    s = F.col(split)
    a = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(s).alias("in_splits"),
        F.max(F.when(s == "train", he)).alias("train_max"),
        F.min(F.when(s == "validation", hs)).alias("val_min"),
        F.max(F.when(s == "validation", he)).alias("val_max"),
        F.min(F.when(s == "test", hs)).alias("test_min"))
    if source is not None:
        a = attach(a.drop("total"), source.agg(F.count(F.lit(1)).alias("total")), [])
    checks = F.array(
        F.struct(F.lit(1).alias("check_id"), F.lit("split rows sum to total").alias("check"),
                 F.col("in_splits").cast("string").alias("left_value"),
                 F.col("total").cast("string").alias("right_value"),
                 (F.col("in_splits") == F.col("total")).alias("ok")),
        _check(2, "train ends before validation starts", "train_max", "val_min"),
        _check(3, "validation ends before test starts", "val_max", "test_min"),
    )
    out = a.select(F.explode(checks).alias("c")).select("c.*")
    if strict:
        out = out.withColumn("ok", F.when(F.col("ok"), F.col("ok")).otherwise(
            F.raise_error(F.concat(F.lit("split check failed: "), F.col("check")))
            .cast("boolean")))
    return out


def candidate_tags(first_year: int, second_year: int, year: str = S.YEAR,
                   month: str = S.MONTH) -> list[tuple[str, str, Column]]:
    y, m = F.col(year), F.col(month)
    y1, y2 = (y == first_year), (y == second_year)
    return [
        ("A", "train", y1), ("A", "validation", y2 & (m <= 6)), ("A", "test", y2 & (m >= 7)),
        ("B", "train", y1 & (m <= 9)), ("B", "validation", y1 & (m >= 10)), ("B", "test", y2),
        ("C", "train", y1), ("C", "validation", y2 & (m <= 9)), ("C", "test", y2 & (m >= 10)),
    ]


def split_candidates(df: DataFrame, first_year: int = 2023, second_year: int = 2024,
                     method: str = "exact") -> DataFrame:
    """Three candidate splits compared in one scan: rows, share inside the
    candidate, mean/median duration and mean distance per part.

    Rows are counted once, by month; months are added up into the parts of
    each candidate."""
    months = df.sparkSession.createDataFrame(
        [(y * 100 + m, y, m) for y in (first_year, second_year) for m in range(1, 13)], f"_ym INT, {S.YEAR} INT, {S.MONTH} INT")
    tags = F.array(*[F.when(cond, F.struct(F.lit(c).alias("candidate"), F.lit(p).alias("part")))
                     for c, p, cond in candidate_tags(first_year, second_year)])
    members = months.select("_ym", F.explode(F.filter(tags, lambda t: t.isNotNull())).alias("t")).select("_ym", "t.candidate", "t.part")
    rows = (df.where(F.col(S.YEAR).isin(first_year, second_year))
            .select(_ym(S.YEAR, S.MONTH).cast("int").alias("_ym"), S.DURATION, S.DISTANCE))
    out = quantiles(rows, S.DURATION, [0.5], ["med_dur"], by=["_ym"], method=method, groups=F.broadcast(members),
                    extra=[("rows", "count", None), ("avg_dur", "avg", S.DURATION),
                           ("avg_dist", "avg", S.DISTANCE)])
    share = C.pct(F.col("rows"), F.sum("rows").over(Window.partitionBy("candidate")))
    return out.select("candidate", "part", "rows", share.alias("share"), "avg_dur", "med_dur", "avg_dist")
