"""Results must not depend on the session time zone (timestamps are NTZ)."""

import pytest

import __spark_entry__ as E
from conftest import SF001

NAMES = ["trip_duration", "calendar_features", "split_integrity", "pickup_hour_bounds",
         "duration_by_hour"]


@pytest.mark.parametrize("name", NAMES)
def test_same_result_in_other_zone(spark, name):
    q = E.queries()[name]
    utc = sorted(map(repr, q(spark, SF001).collect()))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = sorted(map(repr, q(spark, SF001).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other


def test_trip_derivation_zone_free(spark):
    from cabmeter.sources.trips import fixture_trips

    utc = sorted(map(repr, fixture_trips(spark, SF001).collect()))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = sorted(map(repr, fixture_trips(spark, SF001).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other
