import numpy as np
import pytest
from pyspark.sql import functions as F

from cabmeter import schema as S
from cabmeter.operators import model as M
from cabmeter.sources import sinks


def _frame(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    d = rng.uniform(0.1, 20, n)
    pax = rng.integers(1, 7, n)
    hr = rng.integers(0, 24, n)
    dow = rng.integers(0, 7, n)
    mo = rng.integers(1, 13, n)
    y = 3 + 2.5 * d + 0.3 * pax + 4 * ((hr >= 8) & (hr <= 18)) + 5 * np.sin(d) + rng.normal(0, 1, n)
    rows = [(float(a), int(b), int(c), int(e), int(f), float(g), 0, 0, 100, 200, 1, 1)
            for a, b, c, e, f, g in zip(d, pax, hr, dow, mo, y)]
    return spark.createDataFrame(rows, "trip_distance double, passenger_count int, pickup_hour int, "
                                       "pickup_day_of_week int, pickup_month int, trip_duration_minutes double, "
                                       "is_weekend int, is_long_haul int, PULocationID int, DOLocationID int, "
                                       "RatecodeID int, VendorID int"), (d, pax, hr, dow, mo, y)


def test_ols_equals_numpy(spark):
    df, (d, pax, hr, dow, mo, y) = _frame(spark)
    model = M.fit_ols(df)
    X = np.column_stack([d, pax, hr, dow, mo, np.ones_like(d)])
    beta = np.linalg.lstsq(X, y, rcond=None)[0]
    coef = {r.term: r.coefficient for r in M.ols_coefficients(model).collect()}
    for name, b in zip(S.OLS_FEATURES + ["intercept"], beta):
        assert coef[name] == pytest.approx(b, rel=1e-7, abs=1e-9)


def test_metrics_definition(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0), (6.0, 4.0)],
                               "trip_duration_minutes double, prediction double")
    r = M.regression_metrics(df).collect()[0]
    y, p = np.array([1, 2, 3, 6.0]), np.array([2, 2, 2, 4.0])
    assert r.MAE == pytest.approx(np.mean(np.abs(y - p)))
    assert r.RMSE == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert r.R2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


def test_boosted_beats_ols_and_round_trips(spark, tmp_path):
    df, _ = _frame(spark, n=2000)
    train, test = df.randomSplit([0.8, 0.2], seed=5)
    gbt = M.fit_boosted(train, numeric=[S.DISTANCE, S.PASSENGERS, S.HOUR],
                        categorical=[S.DOW, S.MONTH], max_iter=15)
    ols = M.fit_ols(train)
    mae_g = M.regression_metrics(gbt.transform(test)).collect()[0].MAE
    mae_o = M.regression_metrics(ols.transform(test)).collect()[0].MAE
    assert mae_g < mae_o
    loaded = sinks.model_round_trip(gbt, str(tmp_path / "gbt"))
    a = [r.prediction for r in gbt.transform(test).orderBy(S.DISTANCE).collect()]
    b = [r.prediction for r in loaded.transform(test).orderBy(S.DISTANCE).collect()]
    assert a == b


def test_batch_score_clamps_at_zero(spark):
    df, _ = _frame(spark, n=500)
    model = M.fit_ols(df)
    req = df.select(*S.OLS_FEATURES).withColumn(S.DISTANCE, F.lit(-1000.0)) \
            .withColumn("is_valid", F.lit(True))
    preds = [r.prediction for r in M.batch_score(model, req, features=S.OLS_FEATURES).collect()]
    assert preds and min(preds) == 0.0


def test_missing_features_keep_their_rows(spark):
    df, _ = _frame(spark, n=300)
    holes = df.withColumn(S.DISTANCE, F.when(F.col(S.PASSENGERS) == 1, float("nan"))
                          .when(F.col(S.PASSENGERS) != 2, F.col(S.DISTANCE)))
    n, gone = holes.count(), holes.where(F.col(S.PASSENGERS) <= 2).count()
    counts = M.missing_values(holes, S.OLS_FEATURES).first()
    assert (counts.rows, counts.unusable, counts[S.DISTANCE], counts[S.HOUR]) == (n, gone, gone, 0)
    scored = M.batch_score(M.fit_ols(holes), holes, features=S.OLS_FEATURES)
    assert scored.count() == n and scored.where("prediction is null").count() == gone


def test_wide_categorical_is_an_error(spark):
    df, _ = _frame(spark, n=600)
    wide = df.withColumn("code", F.monotonically_increasing_id() % 40)
    with pytest.raises(ValueError, match="code"):
        M.fit_boosted(wide, numeric=[S.DISTANCE], categorical=["code"], max_iter=2, max_bins=32)
    model = M.fit_boosted(wide, numeric=[S.DISTANCE], categorical=["code"], max_iter=2)
    assert len(model.stages[1].categoryMaps[0]) == 40


def test_error_reports_fill_empty(spark):
    df = spark.createDataFrame([(10.0, 8.0, 1.5, 7)], "trip_duration_minutes double, prediction double, "
                                                      "trip_distance double, pickup_hour int")
    by_h = M.mae_by_hour(df).collect()
    assert len(by_h) == 24 and sum(r.trips for r in by_h) == 1
    by_d = {r.bucket_id: r for r in M.mae_by_distance(df).collect()}
    assert len(by_d) == 9 and by_d[1].mae == 2.0 and by_d[0].mae is None and by_d[0].trips == 0


def test_feature_cardinality_flags(spark):
    df, _ = _frame(spark, n=300)
    out = {r.feature: r for r in M.feature_cardinality(
        df.withColumn("pickup_year", F.lit(2023)), categorical=[S.MONTH, "pickup_year"]).collect()}
    assert out["pickup_year"].constant_in_train and not out[S.MONTH].constant_in_train


def test_r2_constant_label(spark):
    perfect = spark.createDataFrame([(3.0, 3.0), (3.0, 3.0)], "trip_duration_minutes double, prediction double")
    off = spark.createDataFrame([(3.0, 2.0), (3.0, 3.0)], "trip_duration_minutes double, prediction double")
    assert M.regression_metrics(perfect).collect()[0].R2 == 1.0
    assert M.regression_metrics(off).collect()[0].R2 == 0.0


def test_split_requests_and_zone_switch(spark):
    from cabmeter.operators import rules as R
    df, _ = _frame(spark, n=400)
    v = R.validate_requests(df.select(*S.OLS_FEATURES, S.PU_ZONE, S.DO_ZONE, S.RATECODE, S.VENDOR)
                            .withColumn(S.PASSENGERS, F.when(F.col(S.PASSENGERS) > 5, 9)
                                        .otherwise(F.col(S.PASSENGERS))))
    ok, bad = R.split_requests(v)
    assert ok.count() + bad.count() == 400 and bad.count() > 0
    model = M.fit_boosted(df, numeric=[S.DISTANCE, S.PU_ZONE, S.DO_ZONE], categorical=[S.MONTH],
                          max_iter=3, zones_categorical=True)
    assert model.transform(df).count() == 400


@pytest.mark.parametrize("name, categorical", [("fit_boosted_11", S.BOOSTED_CATEGORICAL_11), ("fit_boosted_12", S.BOOSTED_CATEGORICAL_12)])
def test_registered_boosting_trains_all_rounds(monkeypatch, name, categorical):
    import inspect

    from cabmeter.plans import registry

    fit, seen = inspect.signature(M.fit_boosted), {}

    def stop(*args, **kw):
        call = fit.bind(*args, **kw)
        call.apply_defaults()
        seen.update(call.arguments)
        raise InterruptedError

    monkeypatch.setattr(registry, "part", lambda *_: None)
    monkeypatch.setattr(registry.M, "fit_boosted", stop)
    with pytest.raises(InterruptedError):
        registry.QUERIES[name](None, "")
    assert seen["max_iter"] == S.BOOST_ITERATIONS == 300 and list(seen["categorical"]) == list(categorical)
