import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from cabmeter import schema as S
from cabmeter.operators import boosting as B
from cabmeter.operators import model as M

NUMERIC, CATEGORICAL = ["distance", "zone", "flag", "still"], ["code", "day"]


def _rows(spark, n, seed=3):
    rng = np.random.default_rng(seed)
    distance, zone, code, day = rng.gamma(2.0, 4.0, n), rng.integers(0, 300, n), rng.choice([1, 2, 99], n), rng.integers(0, 7, n)
    y = 3 + 2.5 * distance + 0.01 * zone + 4.0 * (code == 2) + 3 * np.sin(day) * (distance > 5) + rng.normal(0, 1, n)
    rows = [(float(a), int(b), int(f), 5, int(c), int(d), float(e)) for a, b, c, d, e, f in zip(distance, zone, code, day, y, rng.integers(0, 2, n))]
    return spark.createDataFrame(rows, "distance double, zone int, flag int, still int, code int, day int, y double")


def _nodes(model, path, spark):
    model.write().overwrite().save(path)
    return [(r.treeID, r.nodeData) for r in spark.read.parquet(f"{path}/data").orderBy("treeID", "nodeData.id").collect()]


# All rows give the thresholds in the first case, a sample of them in the
# others; the last two keep the rows in Spark's cache, in several blocks.
@pytest.mark.parametrize("rows, bins, held", [(3000, 255, True), (12000, 32, True), (3000, 255, False), (12000, 32, False)])
def test_trees_are_those_of_spark(spark, monkeypatch, tmp_path, rows, bins, held):
    if not held:
        for name, value in (("HELD", 0), ("BLOCK", 500), ("CHUNK", 2000), ("EVERY", 3), ("DIRECT", 2)):
            monkeypatch.setattr(B, name, value)
    df = _rows(spark, rows).repartition(3, "zone").persist()
    ours = M.fit_boosted(df, NUMERIC, CATEGORICAL, "y", max_iter=8, max_bins=bins)
    columns = [F.col(c).cast("double") for c in [*NUMERIC, *CATEGORICAL, "y"]]
    prepared = PipelineModel(ours.stages[:-1]).transform(df.select(*columns).persist())
    theirs = GBTRegressor(featuresCol="features", labelCol="y", maxIter=8, maxDepth=S.BOOST_DEPTH, minInstancesPerNode=S.BOOST_MIN_LEAF,
                          stepSize=S.BOOST_RATE, maxBins=bins, seed=S.BOOST_SEED).fit(prepared)
    a, b = (_nodes(m, str(tmp_path / n), spark) for m, n in ((ours.stages[-1], "ours"), (theirs, "theirs")))
    assert len(a) == len(b) > 100
    for (tree, x), (other, y) in zip(a, b):
        assert (tree, x.id, x.rawCount, x.leftChild, x.rightChild, x.split) == (other, y.id, y.rawCount, y.leftChild, y.rightChild, y.split)
        got, want = ([n.prediction, n.impurity, n.gain, *n.impurityStats] for n in (x, y))
        assert got == pytest.approx(want, rel=1e-7, abs=1e-7)
    assert ours.stages[-1].treeWeights == theirs.treeWeights
    assert [r.prediction for r in ours.stages[-1].transform(prepared).limit(500).collect()] == pytest.approx(
        [r.prediction for r in theirs.transform(prepared).limit(500).collect()], rel=1e-9)


@pytest.mark.parametrize("held", [True, False])
def test_rounds_do_not_go_through_sparks_row_objects(spark, monkeypatch, held):
    """A fit of ``GBTRegressor`` keeps and walks an object a row."""
    if not held:
        monkeypatch.setattr(B, "HELD", 0)

    def refuse(*_):
        raise AssertionError("rows were given to GBTRegressor")

    monkeypatch.setattr(GBTRegressor, "_fit", refuse)
    model = M.fit_boosted(_rows(spark, 1500), NUMERIC, CATEGORICAL, "y", max_iter=4)
    assert model.stages[-1].getNumTrees == 4


def test_small_tables_need_few_jobs(spark):
    """Jobs follow the preparation, not the rounds, where the rows fit one block."""
    sc, jobs = spark.sparkContext, []
    for rounds in (2, 40):
        sc.setJobGroup(f"boosting-{rounds}", "")
        M.fit_boosted(_rows(spark, 800), NUMERIC, CATEGORICAL, "y", max_iter=rounds)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"boosting-{rounds}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs[1] <= jobs[0] + 4


def test_deep_trees_and_constant_features(spark):
    df = _rows(spark, 900)
    deep = M.fit_boosted(df, NUMERIC, CATEGORICAL, "y", max_iter=2, max_depth=B.DEPTH + 1)
    assert deep.stages[-1].getNumTrees == 2 and deep.stages[-1].getOrDefault("maxDepth") == B.DEPTH + 1
    flat = M.fit_boosted(df, ["still"], [], "y", max_iter=3)
    mean = df.agg(F.avg("y")).first()[0]
    assert flat.transform(df).agg(F.max(F.abs(F.col("prediction") - mean))).first()[0] < 1e-9


@pytest.mark.parametrize("column", ["distance", "y"])
def test_missing_values_are_an_error(spark, column):
    df = _rows(spark, 300).withColumn(column, F.when(F.col("day") != 3, F.col(column)))
    with pytest.raises(Exception, match="(?i)missing|NaN"):
        M.fit_boosted(df, NUMERIC, CATEGORICAL, "y", max_iter=2)


def test_thresholds_follow_counts():
    values = np.repeat([0.0, 1.0, 2.0, 3.0, 10.0], [10, 10, 10, 10, 60])
    assert list(B.candidate_thresholds(values, 1.0, 100, 10)) == [0.5, 1.5, 2.5, 6.5]
    assert list(B.candidate_thresholds(values, 1.0, 100, 1)) == [6.5]
    assert len(B.candidate_thresholds(np.zeros(5), 1.0, 5, 10)) == 0


def test_held_out_rows_are_dealt(spark):
    """Trips are stored by time, so a part was scored in the few tasks of its files."""
    from cabmeter.plans import registry as Q

    rows = Q.dealt(spark, "/root/testdata/sf0.001", "validation")
    assert rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert rows.count() == Q.part(spark, "/root/testdata/sf0.001", "validation").count()
