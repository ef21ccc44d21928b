from pyspark.sql import functions as F

from cabmeter.operators import features as FT
from cabmeter.operators import outliers as O
from cabmeter.operators import profile as P
from cabmeter.operators import rules as R
from cabmeter.operators import splits as SP
from cabmeter.operators import topk as K
from fixtures import frame, trip, ts


def test_duplicates_null_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "a"), (2, "a"), (3, "b")],
                               "k int, v string")
    r = P.duplicate_count(df).collect()[0]
    assert (r.duplicate_rows, r.duplicate_groups, r.total_rows) == (3, 2, 6)
    top = P.duplicate_groups(df, n=1).collect()[0]
    assert top.cnt == 3 and top.v is None
    assert P.dedup_rows(df).count() == 3


def test_duplicates_empty_is_zero(spark):
    df = spark.createDataFrame([], "k int, v string")
    assert P.duplicate_count(df).collect()[0].duplicate_rows == 0


def test_histogram_inclusive_bounds(spark):
    df = frame(spark, [trip(0.0, 1.0), trip(119.99, 1.0), trip(120.0, 1.0), trip(120.01, 1.0)])
    got = {r.bucket: r.trips for r in P.duration_histogram(df).collect()}
    assert got == {0: 1, 119: 1, 120: 1}


def test_passengers_filter_before_cast(spark):
    df = frame(spark, [trip(5.0, 1.0, pax=p) for p in (0.5, 1.5, 2.5, 6.0, 6.4, 7.0)])
    got = {r.pax: r.trips for r in P.duration_by_passengers(df).collect()}
    assert got == {2: 2, 6: 1}          # 0.5 and 6.4 fall outside 1-6 before rounding


def test_month_extremes_ties_earliest(spark):
    rows = [trip(10.0, 1.0, when=ts(2023, m, 2)) for m in (1, 2, 3)]
    r = P.month_extremes(frame(spark, rows)).collect()[0]
    assert r.min_period == "2023-01" and r.max_period == "2023-01"


def _cleaned(spark):
    rows = [trip(10.0 + m, 1.0 + m / 10, when=ts(y, m, 3, 8)) for y in (2023, 2024) for m in range(1, 13)]
    return FT.model_frame(R.clean_trips(frame(spark, rows)))


def test_split_disjoint_complete_and_integrity(spark):
    sp = SP.temporal_split(_cleaned(spark))
    counts = {r.split: r["count"] for r in sp.groupBy("split").count().collect()}
    assert counts == {"train": 12, "validation": 6, "test": 6}
    checks = {r.check_id: r.ok for r in SP.split_integrity(sp).collect()}
    assert checks == {1: True, 2: True, 3: True}
    rep = {r.split: r for r in SP.split_report(sp).collect()}
    assert rep["validation"].dur_median == 13.5 and rep["train"].duplicates == 0


def test_integrity_fails_on_empty_split(spark):
    sp = SP.temporal_split(_cleaned(spark), train_end=(2025, 1), validation_end=(2025, 2))
    checks = {r.check_id: r.ok for r in SP.split_integrity(sp).collect()}
    assert checks[2] is False and checks[3] is False


def test_integrity_sees_rows_lost_since_the_source(spark):
    source = _cleaned(spark)
    kept = SP.temporal_split(source.where(F.col("pickup_month") != 3))
    checks = {r.check_id: r for r in SP.split_integrity(kept, source=source).collect()}
    assert checks[1].ok is False and checks[2].ok and checks[3].ok
    assert (checks[1].left_value, checks[1].right_value) == ("22", "24")


def test_split_candidates(spark):
    out = {(r.candidate, r.part): r.rows for r in SP.split_candidates(_cleaned(spark)).collect()}
    assert out[("A", "train")] == 12 and out[("B", "validation")] == 3 and out[("C", "test")] == 3


def test_outlier_profile_empty_groups_zero(spark):
    prof = {r.group_id: r for r in O.outlier_profile(frame(spark, [trip(0.5, 0.05)])).collect()}
    assert prof[1].trips == 1 and prof[4].trips == 1 and prof[3].trips == 0
    assert prof[3].dur_median is None


def test_top_n_per_group_exact(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.col("id"))
    got = O.top_n_per_group(df.repartition(7), "g", F.col("id"), 4).orderBy("g", "rank").collect()
    assert [(r.g, r.id, r.rank) for r in got][:4] == [(0, 0, 1), (0, 3, 2), (0, 6, 3), (0, 9, 4)]
    assert len(got) == 12


def test_topk_plan_and_ties(spark):
    df = frame(spark, [trip(5.0, 1.0, when=ts(2023, 3, 1, h)) for h in (3, 3, 4, 4, 5)])
    out = K.busiest_hours(df, n=2)
    assert [r.hour for r in out.collect()] == [3, 4]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_sample_rows_repeatable(spark):
    df = frame(spark)
    a = [repr(tuple(r)) for r in K.sample_rows(df, 5).collect()]
    b = [repr(tuple(r)) for r in K.sample_rows(df.repartition(3), 5).collect()]
    assert a == b and len(a) == 5
