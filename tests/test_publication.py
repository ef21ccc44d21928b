"""Saved models, published splits, rule overlap, capped distance, and a scoring
stream that is started again."""

import os
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabmeter import schema as S
from cabmeter.operators import model as M
from cabmeter.operators import rules as R
from cabmeter.plans import registry as Q
from cabmeter.sources import sinks
from cabmeter.sources import trips as TR
from cabmeter.streaming import trips_stream as ST
from conftest import SF001


def test_saved_model_keeps_its_feature_order(spark, tmp_path):
    train = Q.part(spark, SF001, "train")
    model = M.fit_boosted_11(train, max_iter=3)
    path = str(tmp_path / "boosted")
    sinks.save_model(model, path, S.BOOSTED_FEATURES_11, spark)
    loaded, features = sinks.load_model(spark, path, S.BOOSTED_FEATURES_11)
    assert features == S.BOOSTED_FEATURES_11
    with pytest.raises(ValueError, match="fitted on"):
        sinks.load_model(spark, path, S.BOOSTED_FEATURES_11[::-1])
    req = M.request_features(R.validate_requests(TR.requests_from_trips(Q.trips(spark, SF001))))
    one = M.batch_score(model, req, features=features).withColumnRenamed("prediction", "fitted")
    two = M.batch_score(loaded, one.select(*features, "fitted"), features=features)
    row = two.agg(F.count("*").alias("n"), F.max(F.abs(F.col("prediction") - F.col("fitted"))).alias("d"), F.min("prediction").alias("low")).first()
    assert row.n == req.where("is_valid").count() and row.d == 0.0 and row.low >= 0


def test_request_features(spark):
    rows = spark.createDataFrame([(0, 10.0), (6, 50.0), (3, 50.1)], "dow_sunday0 int, trip_distance double")
    got = M.request_features(rows).select(S.DOW, S.WEEKEND, S.LONG_HAUL).collect()
    assert [tuple(r) for r in got] == [(0, 1, 0), (6, 1, 0), (3, 0, 1)]


def test_splits_are_published_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "out" / "splits")
    good = spark.createDataFrame([(1, "train"), (2, "train"), (3, "test")], "v int, split string")
    assert sinks.write_splits(good, path, expected={"train": 2, "test": 1}).count() == 3
    # A month went missing on the way: what was published before stays.
    with pytest.raises(ValueError, match="train"):
        sinks.write_splits(good.where("v <> 2"), path, expected={"train": 2, "test": 1})
    with pytest.raises(ValueError, match="no split"):
        sinks.write_splits(good.withColumn("split", F.when(F.col("v") < 3, F.col("split"))), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    assert os.listdir(tmp_path / "out") == ["splits"]
    # A failing job leaves nothing either.
    broken = good.withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_splits(broken, str(tmp_path / "out" / "broken"))
    assert os.listdir(tmp_path / "out") == ["splits"]


def test_rule_overlap_by_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(None if rng.random() < 0.1 else float(rng.choice([0.5, 1.5, 90, 130])), float(rng.choice([0.05, 1, 60])),
             None if rng.random() < 0.1 else float(rng.choice([1, 7]))) for _ in range(300)]
    df = spark.createDataFrame(rows, f"{S.DURATION} double, {S.DISTANCE} double, {S.PASSENGERS} double")
    rules = R.default_rules()
    flags = df.select(*[F.coalesce(r.condition(), F.lit(False)).alias(f"r{r.rule_id}") for r in rules]).collect()
    got = R.rule_overlap(df).collect()
    assert len(got) == 21
    for r in got:
        a, b = f"r{r.rule_a}", f"r{r.rule_b}"
        both = [f for f in flags if f[a] and f[b]]
        assert r.both == len(both)
        assert r.no_other == sum(sum(f) == len({a, b}) for f in both)
    assert R.rule_overlap(df.limit(0)).where("both > 0").count() == 0


def test_distance_cap(spark):
    df = spark.range(5001).select((F.col("id") / 10).alias(S.DISTANCE)).unionByName(
        spark.createDataFrame([(None,), (float("nan"),)], f"{S.DISTANCE} double"))
    assert R.cap_at_quantile(df.where(~F.isnan(S.DISTANCE)), prob=0.9).agg(F.max(S.DISTANCE)).first()[0] == 450.0


def test_scoring_stream_started_again_doubles_nothing(spark, tmp_path):
    """New files after a stop are scored, old ones not again."""
    model = Q.ols_model(spark, SF001)
    source = tmp_path / "in"
    source.mkdir()
    whole = spark.read.parquet(f"{SF001}/lineitem.parquet")
    whole.limit(700).coalesce(1).write.parquet(str(tmp_path / "one"))
    whole.limit(300).coalesce(1).write.parquet(str(tmp_path / "two"))

    def part(folder, name):
        shutil.copy(next((tmp_path / folder).glob("*.parquet")), source / name)

    def run():
        raw = ST.trips_from_lineitem(ST.lineitem_stream(spark, str(source), "lineitem*.parquet"))
        scored = ST.score_stream(model, ST.validate_stream(raw)).select(*S.OLS_FEATURES, "prediction")
        return ST.run_available(scored, str(tmp_path / "out"), str(tmp_path / "checkpoint"))

    def valid(n):
        return R.validate_requests(TR.requests_from_trips(TR.trips_from_lineitem(whole.limit(n)))).where("is_valid").count()

    part("one", "lineitem-1.parquet")
    assert run().count() == valid(700)
    assert run().count() == valid(700)
    part("two", "lineitem-2.parquet")
    out = run()
    assert out.count() == valid(700) + valid(300)
    assert out.where("prediction < 0").count() == 0


def test_no_row_sees_its_own_target(spark):
    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(0, 4)) or None, int(k), float(rng.integers(1, 50))) for k in range(200)]

    def encoded(rows):
        df = spark.createDataFrame(rows, "zone int, k int, y double")
        return {r.k: (r.zone, r.fold, r.zone_encoded) for r in M.target_encode(df, "zone", "y", folds=4, weight=3, fold_columns=["k"]).collect()}

    got = encoded(rows)
    for zone, k, _ in rows:
        fold = got[k][1]
        others = [(z, y) for z, j, y in rows if got[j][1] != fold]
        mean = np.mean([y for _, y in others])
        own = [y for z, y in others if z == zone]
        assert got[k][2] == pytest.approx((sum(own) + 3 * mean) / (len(own) + 3))
    changed = encoded([(z, k, 1e6 if k == 7 else y) for z, k, y in rows])
    assert changed[7] == pytest.approx(got[7]) and changed != got


def test_intervals_cover_what_they_promise(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(float(d), int(h), float(5 + d + e * (1 + d / 5)), float(5 + d)) for d, h, e in
                                zip(rng.gamma(2, 4, 8000), rng.integers(0, 3, 8000), rng.normal(0, 1, 8000))],
                               f"{S.DISTANCE} double, {S.HOUR} int, {S.DURATION} double, prediction double").withColumn("half", F.rand(3) < 0.5)
    rows = M.prediction_intervals(df.where("half"), df.where("not half"), 0.9)
    cover = M.interval_coverage(rows).collect()
    assert sum(r.covered for r in cover) / sum(r.rows for r in cover) == pytest.approx(0.9, abs=0.02)
    assert rows.where("lower < 0 or upper < lower").count() == 0
    # A bucket without calibration rows takes the overall width.
    far = spark.createDataFrame([(500.0, 1, 3.0, 2.0)], f"{S.DISTANCE} double, {S.HOUR} int, {S.DURATION} double, prediction double")
    assert M.prediction_intervals(df.where("half"), far, 0.9).first().upper > 2
