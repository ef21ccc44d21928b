"""Projections and scalar features (row-local: no shuffle, work on a
streaming DataFrame as well)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import columns as C


def trip_duration(df: DataFrame, pickup: str = S.PICKUP, dropoff: str = S.DROPOFF,
                  out: str = S.DURATION) -> DataFrame:
    """Minutes between pickup and dropoff."""
    return df.withColumn(out, C.trip_minutes(pickup, dropoff))


def calendar_features(df: DataFrame, ts: str = S.PICKUP, prefix: str = "pickup_") -> DataFrame:
    """Year, month, day, day of week (0 = Sunday) and hour as INT."""
    return df.withColumns({
        f"{prefix}year": C.year_of(ts),
        f"{prefix}month": C.month_of(ts),
        f"{prefix}day": C.day_of(ts),
        f"{prefix}day_of_week": C.dow_sunday0(ts),
        f"{prefix}hour": C.hour_of(ts),
    })


def is_weekend(df: DataFrame, dow: str = S.DOW, out: str = S.WEEKEND,
               days=S.WEEKEND_DAYS_SUNDAY0) -> DataFrame:
    return df.withColumn(out, C.weekend_flag(dow, days))


def is_long_haul(df: DataFrame, distance: str = S.DISTANCE, out: str = S.LONG_HAUL,
                 threshold: float = S.LONG_HAUL_MILES) -> DataFrame:
    return df.withColumn(out, C.long_haul_flag(distance, threshold))


def cast_codes(df: DataFrame, cols=(S.PASSENGERS, S.RATECODE, S.VENDOR, S.PU_ZONE,
                                     S.DO_ZONE)) -> DataFrame:
    """Code and count columns to INT with half-to-even rounding."""
    return df.withColumns({c: C.half_even_int(c) for c in cols})


def model_frame(trips: DataFrame, ts: str = S.PICKUP,
                long_haul_miles: float = S.LONG_HAUL_MILES) -> DataFrame:
    """The 14-column leakage-safe projection; both timestamps are dropped."""
    dow = C.dow_sunday0(ts)
    return trips.select(
        F.col(S.DURATION).cast("double").alias(S.DURATION),
        C.year_of(ts).alias(S.YEAR),
        C.month_of(ts).alias(S.MONTH),
        C.day_of(ts).alias(S.DAY),
        dow.alias(S.DOW),
        C.hour_of(ts).alias(S.HOUR),
        C.weekend_flag(dow).alias(S.WEEKEND),
        F.col(S.DISTANCE).cast("double").alias(S.DISTANCE),
        C.long_haul_flag(S.DISTANCE, long_haul_miles).alias(S.LONG_HAUL),
        C.half_even_int(S.PASSENGERS).alias(S.PASSENGERS),
        C.half_even_int(S.RATECODE).alias(S.RATECODE),
        C.half_even_int(S.VENDOR).alias(S.VENDOR),
        C.half_even_int(S.PU_ZONE).alias(S.PU_ZONE),
        C.half_even_int(S.DO_ZONE).alias(S.DO_ZONE),
    )


def check_schema(df: DataFrame, expected: T.StructType = S.CLEANED_SCHEMA) -> DataFrame:
    """Fail fast when a frame does not carry the declared columns and types."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in expected.fields]
    if got != want:
        raise ValueError(f"schema mismatch: expected {want}, got {got}")
    return df


_SQL_TYPE_NAMES = {
    T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.DoubleType: "DOUBLE",
    T.FloatType: "FLOAT", T.StringType: "VARCHAR", T.TimestampNTZType: "TIMESTAMP",
    T.TimestampType: "TIMESTAMP WITH TIME ZONE", T.BooleanType: "BOOLEAN",
    T.DateType: "DATE", T.ShortType: "SMALLINT", T.ByteType: "TINYINT",
}


def sql_type_name(dt: T.DataType) -> str:
    """Canonical SQL name of a Spark type."""
    return _SQL_TYPE_NAMES.get(type(dt), dt.simpleString().upper())


def column_profile(df: DataFrame, roles: Mapping[str, str] | None = None) -> DataFrame:
    """Position, column, type, NULL count, role and NULL flag per column.

    One pass: a ``count_if`` per column, unpivoted with ``stack`` and joined
    (broadcast, one row per column) to the schema listing.
    """
    spark = df.sparkSession
    roles = dict(S.COLUMN_ROLES if roles is None else roles)
    fields = df.schema.fields
    counts = df.agg(*[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"c{i}")
                      for i, f in enumerate(fields)])
    stack_args = ", ".join(f"{i + 1}, c{i}" for i in range(len(fields)))
    long = counts.selectExpr(f"stack({len(fields)}, {stack_args}) AS (position, null_count)")
    listing = spark.createDataFrame(
        [(i + 1, f.name, sql_type_name(f.dataType), roles.get(f.name, ""))
         for i, f in enumerate(fields)],
        "position INT, column_name STRING, column_type STRING, role STRING")
    out = F.broadcast(listing).join(long, "position")
    return out.select("position", "column_name", "column_type", "null_count", "role",
                      (F.col("null_count") > 0).alias("has_nulls"))


def time_labels(df: DataFrame, year: str = S.YEAR, month: str = S.MONTH,
                dow: str = S.DOW) -> DataFrame:
    """``YYYY-MM`` period, month name and weekday name (0 = Sunday)."""
    return df.withColumns({
        "period": C.period_label(year, month),
        "month_name": C.month_name(month),
        "weekday_name": C.weekday_name_sunday0(dow),
    })


def code_labels(df: DataFrame, ratecode: str = S.RATECODE, vendor: str = S.VENDOR) -> DataFrame:
    """Rate-code and vendor descriptions, by broadcast join with the fixed
    lookup tables (7 and 2 rows); unknown codes get NULL."""
    spark = df.sparkSession
    rates = spark.createDataFrame(list(S.RATECODE_LABELS.items()),
                                  "_rc INT, ratecode_label STRING")
    vendors = spark.createDataFrame(list(S.VENDOR_LABELS.items()),
                                    "_vd INT, vendor_label STRING")
    out = df.join(F.broadcast(rates), F.col(ratecode) == F.col("_rc"), "left") \
            .join(F.broadcast(vendors), F.col(vendor) == F.col("_vd"), "left")
    return out.drop("_rc", "_vd")


def distance_group(df: DataFrame, distance: str = S.DISTANCE, out: str = "dist_group") -> DataFrame:
    return df.withColumn(out, C.distance_group(distance))


def error_distance_bucket(df: DataFrame, distance: str = S.DISTANCE,
                          out: str = "distance_bucket") -> DataFrame:
    idx = C.error_bucket_index(distance)
    labels = F.array(*[F.lit(x) for x in S.ERROR_BUCKET_LABELS])
    return df.withColumns({f"{out}_id": idx, out: F.element_at(labels, idx + 1)})


def time_band(df: DataFrame, hour: str = S.HOUR, out: str = "time_band") -> DataFrame:
    return df.withColumn(out, C.time_band(hour))


def pickup_hour_bounds(df: DataFrame, year: str = S.YEAR, month: str = S.MONTH,
                       day: str = S.DAY, hour: str = S.HOUR) -> DataFrame:
    return df.withColumns({
        "hour_start": C.pickup_hour_start(year, month, day, hour),
        "hour_end": C.pickup_hour_end(year, month, day, hour),
    })
