import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cabmeter import schema as S
from cabmeter.operators import model as M
from cabmeter.operators import profile as P
from cabmeter.operators import rules as R
from cabmeter.sources import trips as TR
from fixtures import frame, trip


def test_scan_trips_type_drift(spark):
    base = tempfile.mkdtemp(prefix="cabmeter-drift-")
    a, b = os.path.join(base, "a"), os.path.join(base, "b")
    spark.createDataFrame([(1, 2, 1.5)], "VendorID int, passenger_count bigint, trip_distance double") \
        .write.parquet(a)
    spark.createDataFrame([(2, 2.6, 3.0)], "VendorID int, passenger_count double, trip_distance double") \
        .write.parquet(b)
    df = TR.scan_trips(spark, [a, b], optional=S.RAW_COLUMNS)
    assert df.schema == S.RAW_SCHEMA
    assert sorted(r.passenger_count for r in df.collect()) == [2.0, 2.6]


def test_scan_trips_missing_path(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        TR.scan_trips(spark, ["/nonexistent/cabmeter/trips.parquet"])


def test_scan_projected_prunes_columns(spark):
    base = tempfile.mkdtemp(prefix="cabmeter-prune-")
    frame(spark).write.parquet(os.path.join(base, "t"))
    df = TR.scan_projected(spark.read.parquet(os.path.join(base, "t")), [S.DISTANCE], [S.VENDOR])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<VendorID:int,trip_distance:double,trip_duration_minutes:double>" in plan
    assert dict(df.dtypes) == {S.DISTANCE: "float", S.VENDOR: "int", S.DURATION: "float"}


def test_empty_input(spark):
    empty = frame(spark, [])
    assert R.cleaning_reconcile(empty).collect()[0].original_rows == 0
    assert P.duration_profile(empty).collect()[0].median is None
    rep = R.rule_impact(empty).collect()
    assert len(rep) == 6 and all(r.pct is None for r in rep)
    assert M.mae_by_hour(empty.select(S.DURATION, F.col(S.DURATION).alias("prediction"),
                                       F.lit(1).alias(S.HOUR))).count() == 24


def test_row_order_does_not_matter(spark):
    df = frame(spark)
    a = sorted(map(repr, R.rule_impact(df).collect()))
    b = sorted(map(repr, R.rule_impact(df.repartition(5).orderBy(F.rand(3))).collect()))
    assert a == b


def test_requests_from_trips_monday_based(spark):
    import datetime as dt
    df = frame(spark, [trip(5.0, 1.0, when=dt.datetime(2023, 3, 6, 9))])   # a Monday
    assert TR.requests_from_trips(df).collect()[0][S.DOW] == 0


def test_scan_trips_missing_column(spark):
    path = tempfile.mkdtemp(prefix="cabmeter-absent-") + "/t"
    spark.createDataFrame([(1, 2.5)], "VendorID int, RatecodeID double").write.parquet(path)
    schema = "VendorID int, RatecodeID int, trip_distance double"
    target = spark.createDataFrame([], schema).schema
    with pytest.raises(ValueError, match="trip_distance"):
        TR.scan_trips(spark, path, target)
    assert TR.scan_trips(spark, path, target, ["trip_distance"]).collect() == [(1, 2, None)]


def test_write_splits_strict(spark):
    from cabmeter.sources.sinks import write_splits

    df = spark.createDataFrame([(1, "train"), (2, None)], "v int, split string")
    path = tempfile.mkdtemp(prefix="cabmeter-strict-") + "/t"
    with pytest.raises(ValueError, match="1 rows"):
        write_splits(df, path)
    assert not os.path.exists(path) and not [n for n in os.listdir(os.path.dirname(path)) if "staged" in n]
    assert write_splits(df, path, strict=False).count() == 1
