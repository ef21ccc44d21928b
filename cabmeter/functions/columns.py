"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs a UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wall_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 of a wall-clock timestamp,
    from its calendar fields only, so the session time zone (and its
    daylight-saving gaps) never enters."""
    t = col(ts)
    return (F.unix_date(F.to_date(t)).cast("long") * 86400 + F.hour(t) * 3600
            + F.minute(t) * 60 + F.second(t))


def trip_minutes(pickup: str | Column = S.PICKUP,
                 dropoff: str | Column = S.DROPOFF) -> Column:
    """Minutes between pickup and dropoff (whole seconds / 60)."""
    return (wall_seconds(dropoff) - wall_seconds(pickup)).cast("double") / F.lit(60.0)


def year_of(ts: str | Column) -> Column:
    return F.year(col(ts)).cast("int")


def month_of(ts: str | Column) -> Column:
    return F.month(col(ts)).cast("int")


def day_of(ts: str | Column) -> Column:
    return F.dayofmonth(col(ts)).cast("int")


def dow_sunday0(ts: str | Column) -> Column:
    """Day of week with 0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(col(ts)) - 1).cast("int")


def hour_of(ts: str | Column) -> Column:
    return F.hour(col(ts)).cast("int")


def weekend_flag(dow: str | Column, days: Sequence[int] = S.WEEKEND_DAYS_SUNDAY0) -> Column:
    return F.when(col(dow).isin(*days), 1).otherwise(0).cast("int")


def long_haul_flag(distance: str | Column = S.DISTANCE,
                   threshold: float = S.LONG_HAUL_MILES) -> Column:
    return F.when(col(distance) > F.lit(float(threshold)), 1).otherwise(0).cast("int")


def half_even_int(c: str | Column) -> Column:
    """Round half-to-even, then to INT (0.5 -> 0, 1.5 -> 2, 2.5 -> 2).

    NaN and out-of-range values become NULL instead of failing the job.
    """
    r = F.rint(col(c))
    ok = (~F.isnan(r)) & (r >= F.lit(-2147483648.0)) & (r <= F.lit(2147483647.0))
    return F.when(ok, r.cast("int"))


def pickup_hour_start(year, month, day, hour) -> Column:
    """First instant of the pickup hour, rebuilt from its parts."""
    return F.make_timestamp_ntz(col(year), col(month), col(day), col(hour),
                                F.lit(0), F.lit(0))


def pickup_hour_end(year, month, day, hour) -> Column:
    """Last whole second of the pickup hour, rebuilt from its parts."""
    return F.make_timestamp_ntz(col(year), col(month), col(day), col(hour),
                                F.lit(59), F.lit(59))


def period_label(year: str | Column, month: str | Column) -> Column:
    """``YYYY-MM``."""
    return F.format_string("%d-%02d", col(year), col(month))


def _label_array(labels: Sequence[str]) -> Column:
    return F.array(*[F.lit(x) for x in labels])


def month_name(month: str | Column) -> Column:
    return F.element_at(_label_array(S.MONTH_SHORT), col(month))


def weekday_name_sunday0(dow: str | Column) -> Column:
    return F.element_at(_label_array(S.DOW_SHORT_SUNDAY0), col(dow) + 1)


def distance_group(distance: str | Column = S.DISTANCE) -> Column:
    """7 EDA groups; NULL and NaN fall to the open last group."""
    d = col(distance)
    expr = None
    for upper, label in S.DISTANCE_GROUPS:
        if upper is None:
            return expr.otherwise(F.lit(label))
        cond = d < F.lit(upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def error_bucket_index(distance: str | Column = S.DISTANCE,
                       edges: Sequence[float] = S.ERROR_BUCKET_EDGES) -> Column:
    """Left-closed bucket index: below the first edge -> 0, at or above the
    last edge, NaN or NULL -> len(edges)."""
    d = col(distance)
    expr = None
    for i, edge in enumerate(edges):
        cond = d < F.lit(float(edge))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(edges))).cast("int")


def time_band(hour: str | Column) -> Column:
    h = col(hour)
    expr = None
    for lo, hi, label in S.TIME_BANDS:
        cond = (h >= lo) & (h <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def pct(part: Column, total: Column) -> Column:
    """``part * 100 / total``; NULL when the total is 0."""
    return F.try_divide(part.cast("double") * F.lit(100.0), total.cast("double"))


def ratio(part: Column, total: Column) -> Column:
    return F.try_divide(part.cast("double"), total.cast("double"))
