import datetime as dt

from pyspark.sql import functions as F

from cabmeter import schema as S
from cabmeter.functions import columns as C
from cabmeter.operators import features as FT
from fixtures import frame, trip, ts


def test_half_even_cast(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (2.7,), (None,), (float("nan"),)], "x double")
    got = [r[0] for r in df.select(C.half_even_int("x")).collect()]
    assert got == [0, 2, 2, 3, None, None]


def test_calendar_sunday_zero_and_weekend(spark):
    df = frame(spark, [trip(5.0, 1.0, when=ts(2023, 3, d, 7)) for d in (4, 5, 6)])
    out = FT.is_weekend(FT.calendar_features(df)).select(S.DOW, S.WEEKEND, S.HOUR).collect()
    assert [tuple(r) for r in out] == [(6, 1, 7), (0, 1, 7), (1, 0, 7)]


def test_model_frame_schema_and_no_timestamps(spark):
    mf = FT.check_schema(FT.model_frame(frame(spark)))
    assert S.PICKUP not in mf.columns and S.DROPOFF not in mf.columns
    assert mf.columns == S.CLEANED_COLUMNS


def test_long_haul_boundary(spark):
    out = FT.is_long_haul(frame(spark, [trip(1.0, 50.0), trip(1.0, 50.01)])).select(S.LONG_HAUL)
    assert [r[0] for r in out.collect()] == [0, 1]


def test_distance_groups_null_and_nan_last(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (19.99,), (20.0,), (None,), (float("nan"),)],
                               "trip_distance double")
    got = [r[0] for r in FT.distance_group(df).select("dist_group").collect()]
    assert got == ["< 1 mi", "1-2 mi", "10-20 mi", "20+ mi", "20+ mi", "20+ mi"]


def test_error_buckets_left_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (49.9,), (50.0,), (250.0,), (float("nan"),)],
                               "trip_distance double")
    got = [tuple(r) for r in FT.error_distance_bucket(df)
           .select("distance_bucket_id", "distance_bucket").collect()]
    assert got == [(0, "0–1"), (1, "1–2"), (7, "20–50"), (8, "50+"), (8, "50+"), (8, "50+")]


def test_time_band(spark):
    df = spark.range(24).select(F.col("id").cast("int").alias(S.HOUR))
    bands = {r[0]: r[1] for r in FT.time_band(df).collect()}
    assert bands[0] == bands[5] == "Night (0–5)"
    assert bands[6] == bands[9] == "Morning rush (6–9)"
    assert bands[10] == "Midday (10–15)" and bands[19] == "Evening rush (16–19)"
    assert bands[23] == "Evening (20–23)"


def test_hour_bounds_are_naive(spark):
    df = spark.createDataFrame([(2024, 3, 10, 2)], "pickup_year int, pickup_month int, pickup_day int, pickup_hour int")
    r = FT.pickup_hour_bounds(df).collect()[0]
    assert r.hour_start == dt.datetime(2024, 3, 10, 2, 0, 0)
    assert r.hour_end == dt.datetime(2024, 3, 10, 2, 59, 59)


def test_trip_duration_from_timestamps(spark):
    df = frame(spark, [trip(12.5, 1.0)])
    assert FT.trip_duration(df, out="d").select("d").collect()[0][0] == 12.5


def test_code_labels_unknown_is_null(spark):
    df = frame(spark, [trip(5.0, 1.0, rate=2, vendor=2), trip(5.0, 1.0, rate=7, vendor=3)])
    got = [tuple(r) for r in FT.code_labels(df).select("ratecode_label", "vendor_label").collect()]
    assert ("2 - JFK Airport", "2 - VeriFone Inc.") in got and (None, None) in got


def test_column_profile_counts_nulls(spark):
    prof = {r.column_name: r for r in FT.column_profile(FT.model_frame(frame(spark))).collect()}
    assert prof["passenger_count"].null_count == 1 and prof["passenger_count"].has_nulls
    assert prof["trip_duration_minutes"].column_type == "DOUBLE"
    assert prof["pickup_year"].column_type == "INTEGER"
