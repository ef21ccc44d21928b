
from cabmeter import schema as S
from cabmeter.operators import rules as R
from fixtures import frame, trip


def test_clean_thresholds(spark):
    df = frame(spark)
    kept = {(r[S.DURATION], r[S.DISTANCE], r[S.PASSENGERS]) for r in R.clean_trips(df).collect()}
    assert (0.99, 1.0, 1.0) not in kept          # duration < 1
    assert (1.0, 1.0, 1.0) in kept               # exactly 1 kept
    assert (1.5, 0.1, 1.0) in kept and (1.5, 0.09, 1.0) not in kept
    assert (120.0, 1.0, 1.0) in kept             # 120 is not > 120
    assert (120.5, 1.99, 1.0) not in kept and (120.5, 2.0, 1.0) in kept
    assert (130.0, 60.0, 1.0) in kept            # long haul kept
    assert (5.0, 1.0, 6.0) in kept and (5.0, 1.0, 7.0) not in kept
    assert all(p is not None for _, _, p in kept)  # NULL passengers dropped


def test_nan_semantics(spark):
    # NaN is greater than every number: NaN >= 1 keeps, NaN > 120 with distance 1 removes.
    df = frame(spark, [trip(float("nan"), 1.0), trip(5.0, float("nan"))])
    assert R.clean_trips(df).count() == 1


def test_reconcile_property(spark):
    rec = R.cleaning_reconcile(frame(spark)).collect()[0]
    assert rec.original_rows == rec.removed_rows + rec.kept_rows + rec.null_gap
    assert rec.null_gap >= 1                      # the NULL rows
    assert rec.kept_rows == R.clean_trips(frame(spark)).count()


def test_rule_impact_one_scan(spark):
    out = {r.rule_id: r.rows_matched for r in R.rule_impact(frame(spark)).collect()}
    assert out[1] == 1 and out[6] == 1
    plan = R.rule_impact(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") <= 2   # the data scan + the 6-row rule list


def test_unusual_and_outlier_reports(spark):
    u = {r.check_id: r for r in R.unusual_values(frame(spark)).collect()}
    assert u[5].rows_matched == 1 and u[5].flagged          # passengers = 0
    assert u[7].rows_matched == 1                           # duration > 1, distance 0
    o = {r.group_id: r.rows_matched for r in R.outlier_summary(frame(spark)).collect()}
    assert len(o) == 6 and o[6] == 1


def test_unusual_values_found_ascending(spark):
    df = frame(spark).where("trip_distance <= 50")     # check 4 matches nothing
    every, found = R.unusual_values(df).collect(), R.unusual_values_found(df).collect()
    assert 0 < len(found) < len(every)
    assert found == sorted((r for r in every if r.rows_matched > 0), key=lambda r: (r.rows_matched, r.check_id))


def test_validate_requests_all_violations(spark):
    rows = [(1.0, 2, 10, 0, 6, 100, 200, 1, 1),
            (-1.0, 9, 24, 7, 13, 0, 266, 7, 3),
            (60.0, 1, 0, 6, 1, 1, 265, None, None)]
    req = spark.createDataFrame(rows, "trip_distance double, passenger_count int, pickup_hour int, "
                                      "pickup_day_of_week int, pickup_month int, PULocationID int, "
                                      "DOLocationID int, RatecodeID int, VendorID int")
    out = R.validate_requests(req).collect()
    assert out[0].is_valid and out[0].violations == []
    assert not out[1].is_valid and len(out[1].violations) == 9
    assert out[2].is_valid and out[2].RatecodeID == 1 and out[2].is_long_haul == 1
    # Monday-based Sunday (6) -> table convention 0, weekend in both conventions.
    assert out[2].dow_sunday0 == 0 and out[2].is_weekend == 1
    assert out[0].dow_sunday0 == 1 and out[0].is_weekend == 0


def test_documented_rules(spark):
    df = frame(spark, [trip(5.0, 1.0), trip(200.0, 1.0), trip(5.0, 250.0), trip(5.0, 250.0, rate=2),
                       trip(5.0, 1.0, pax=0.0)])
    assert R.documented_rules(df).count() == 2
