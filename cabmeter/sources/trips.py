"""Trip sources.

``scan_trips`` reads one or more Parquet paths, casts each to the declared
schema and unions them by name (Spark refuses a type change between files;
casting per file keeps the union well typed).  The remaining functions derive
trip-shaped tables from the driver's test tables, so every query's work grows
with those tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.columns import half_even_int


def _cast_to(df: DataFrame, target: T.StructType, optional: Sequence[str]) -> DataFrame:
    absent = [f.name for f in target.fields if f.name not in df.columns]
    required = [name for name in absent if name not in optional]
    if required:
        raise ValueError(f"missing columns: {', '.join(required)}")
    cols = []
    for field in target.fields:
        if field.name in absent:
            value = F.lit(None).cast(field.dataType)
        elif isinstance(field.dataType, T.IntegerType) and isinstance(df.schema[field.name].dataType, (T.FloatType, T.DoubleType)):
            value = half_even_int(field.name)
        else:
            value = F.col(field.name).cast(field.dataType)
        cols.append(value.alias(field.name))
    return df.select(*cols)


def scan_trips(spark: SparkSession, paths: str | Sequence[str],
               schema: T.StructType | None = S.RAW_SCHEMA,
               optional: Sequence[str] = ()) -> DataFrame:
    """Union of Parquet files as one trip table.

    A missing path raises Spark's ``PATH_NOT_FOUND`` at call time (the read is
    resolved eagerly).  With ``schema`` each file is cast to it first, so a
    BIGINT file and a DOUBLE file of the same column union cleanly; fractions
    round half-to-even where an integer is declared.  A file that lacks a
    declared column raises ``ValueError``, unless the column is in
    ``optional``: then it is NULL.
    """
    if isinstance(paths, str):
        paths = [paths]
    if not paths:
        raise ValueError("scan_trips needs at least one path")
    frames = []
    for p in paths:
        df = spark.read.parquet(p)
        frames.append(_cast_to(df, schema, optional) if schema is not None else df)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scan_projected(df: DataFrame, numeric: Sequence[str] = (),
                   categorical: Sequence[str] = (),
                   target: str | None = S.DURATION) -> DataFrame:
    """Only the needed columns: numeric -> float, categorical -> int.

    Column pruning reaches the Parquet scan (``ReadSchema`` lists only these).
    """
    cols = [F.col(c).cast("float").alias(c) for c in numeric]
    cols += [F.col(c).cast("int").alias(c) for c in categorical]
    if target:
        cols.append(F.col(target).cast("float").alias(target))
    return df.select(*cols)


# ---------------------------------------------------------------------------
# Test-table adapters (see FIXTURES.md): trips derived from ``lineitem``.
# ---------------------------------------------------------------------------
def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """One trip per line item, by plain DOUBLE arithmetic (FIXTURES.md §2)."""
    h = ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 24).cast("int")
    distance = (F.col("l_extendedprice") / F.lit(1000.0)) \
        * (F.col("l_extendedprice") / F.lit(1000.0)) / F.lit(200.0)
    rush = F.when((h >= 8) & (h <= 18), F.lit(4.0)).otherwise(F.lit(0.0))
    duration = (
        F.when(F.col("l_partkey") % 97 == 0,
               F.lit(150.0) + F.col("l_tax") * F.lit(100.0))
        .when(F.col("l_partkey") % 89 == 0, F.col("l_tax") * F.lit(25.0))
        .otherwise(F.lit(2.5) + F.lit(2.2) * distance + rush
                   + F.col("l_tax") * F.lit(100.0))
    )
    pickup = (F.col("l_shipdate").cast("timestamp_ntz")
              + F.make_dt_interval(F.lit(0), h, (F.col("l_partkey") % 60).cast("int"),
                                   F.lit(0)))
    base = lineitem.select(
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).cast("int").alias(S.VENDOR),
        pickup.alias(S.PICKUP),
        duration.alias(S.DURATION),
        F.when(F.col("l_suppkey") % 50 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("l_linenumber").cast("double")).alias(S.PASSENGERS),
        distance.alias(S.DISTANCE),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2)
         .otherwise(99).cast("int").alias(S.RATECODE),
        (F.col("l_suppkey") % 265 + 1).cast("int").alias(S.PU_ZONE),
        (F.col("l_partkey") % 265 + 1).cast("int").alias(S.DO_ZONE),
    )
    dropoff = F.timestamp_add("SECOND", F.floor(F.col(S.DURATION) * 60).cast("long"),
                              F.col(S.PICKUP))
    return base.select(
        S.VENDOR, S.PICKUP, dropoff.alias(S.DROPOFF), S.PASSENGERS, S.DISTANCE,
        S.RATECODE, S.PU_ZONE, S.DO_ZONE, S.DURATION)


def fixture_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips (F1) derived from the driver's ``lineitem`` table (lazy)."""
    return trips_from_lineitem(_table(spark, sf_dir, "lineitem"))


_MATERIALIZED: dict[tuple[str, str], str] = {}


def materialized_trips(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """The derived trips written once per session as a Parquet table - the
    stand-in for the raw trip files the operators normally read.

    Rows are range-partitioned and sorted by pickup time, so each file and
    row group covers one time range: time filters (splits, periods) skip
    files by their min/max statistics, and every scan runs in parallel
    even though the test table is a single row group.  The table lives in
    the shared checkpoint folder, so a lost executor only re-reads files.
    """
    from ..session import scratch_path

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    path = _MATERIALIZED.get(key)
    if path is None:
        n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
        path = scratch_path(spark, "trips")
        (fixture_trips(spark, sf_dir)
         .repartitionByRange(n, F.col(S.PICKUP))
         .sortWithinPartitions(S.PICKUP)
         .write.mode("overwrite").option("compression", "zstd").parquet(path))
        _MATERIALIZED[key] = path
    return spark.read.parquet(path)


def dup_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A projection of ``lineitem`` with many all-column duplicates."""
    li = _table(spark, sf_dir, "lineitem")
    return li.select(
        F.year("l_shipdate").cast("int").alias("ship_year"),
        F.month("l_shipdate").cast("int").alias("ship_month"),
        F.col("l_linenumber"),
        F.col("l_returnflag"),
        F.col("l_linestatus"),
        (F.col("l_suppkey") % 25).alias("supp_mod"),
        F.col("l_quantity"),
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table seen through the trip operators' column
    parameters: ``ts`` as pickup time, ``value`` as the measured quantity."""
    return _table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", "value")


def requests_from_trips(trips: DataFrame) -> DataFrame:
    """Scoring requests (F4) derived from raw trips: Monday-based weekday,
    passenger count as given (bad rows included)."""
    ts = F.col(S.PICKUP)
    return trips.select(
        F.col(S.DISTANCE),
        F.col(S.PASSENGERS).cast("int").alias(S.PASSENGERS),
        F.hour(ts).cast("int").alias(S.HOUR),
        F.pmod(F.dayofweek(ts) - 2, F.lit(7)).cast("int").alias(S.DOW),
        F.month(ts).cast("int").alias(S.MONTH),
        F.col(S.PU_ZONE),
        F.col(S.DO_ZONE),
        F.col(S.RATECODE),
        F.col(S.VENDOR),
    )
