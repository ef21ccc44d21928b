"""Hand-made trip rows (FIXTURES.md §3): thresholds, NULL, NaN, weekdays."""

import datetime as dt
import math

from cabmeter import schema as S


def ts(y, m, d, h=0, mi=0, s=0):
    return dt.datetime(y, m, d, h, mi, s)


def trip(dur, dist, pax=1.0, when=None, vendor=1, rate=1, pu=1, do=2):
    when = when or ts(2023, 3, 1, 10)
    drop = None if dur is None or (isinstance(dur, float) and math.isnan(dur)) \
        else when + dt.timedelta(seconds=math.floor(dur * 60))
    return (vendor, when, drop, pax, dist, rate, pu, do, dur)


def edge_trips():
    return [
        trip(0.99, 1.0), trip(1.0, 1.0), trip(1.5, 0.1), trip(1.5, 0.09), trip(2.0, 0.5),
        trip(120.0, 1.0), trip(120.5, 1.99), trip(120.5, 2.0), trip(130.0, 60.0),
        trip(10.0, 50.0), trip(10.0, 50.01), trip(5.0, 1.0, pax=6.0), trip(5.0, 1.0, pax=7.0),
        trip(5.0, 1.0, pax=0.0), trip(5.0, 1.0, pax=0.5), trip(5.0, 1.0, pax=1.5),
        trip(5.0, 1.0, pax=2.5), trip(5.0, 1.0, pax=None), trip(5.0, None),
        trip(float("nan"), 1.0), trip(5.0, float("nan")),
        trip(5.0, 3.0, when=ts(2023, 3, 4, 0)),   # Saturday, hour 0
        trip(5.0, 3.0, when=ts(2023, 3, 5, 23)),  # Sunday, hour 23
        trip(2.0, 0.0),
    ]


def frame(spark, rows=None):
    return spark.createDataFrame(rows if rows is not None else edge_trips(), S.RAW_SCHEMA)
