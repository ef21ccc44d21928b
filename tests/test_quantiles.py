import numpy as np
import pytest
from hypothesis import given, settings
from pyspark.sql import functions as F
from hypothesis import strategies as st

from cabmeter.functions.quantiles import multi_quantiles, quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]


def _np(values, p):
    return float(np.percentile(np.asarray(values, dtype=float), p * 100, method="linear"))


def test_global_matches_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.round(rng.exponential(10, 5000), 2).tolist()
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "v double")
    got = quantiles(df, "v", PROBS).collect()[0]
    for i, p in enumerate(PROBS):
        assert got[i] == pytest.approx(_np(vals, p), rel=1e-12, abs=1e-12)


def test_grouped_with_hot_group_and_null_key(spark):
    rng = np.random.default_rng(3)
    rows = [("hot", float(x)) for x in rng.integers(0, 50, 3000)]        # a third+ of rows, repeats
    rows += [("cold", float(x)) for x in rng.normal(0, 1, 500)]
    rows += [(None, float(x)) for x in rng.normal(5, 1, 300)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in quantiles(df, "v", [0.1, 0.5, 0.9], ["a", "b", "c"], by=["g"]).collect()}
    for key in ("hot", "cold", None):
        vals = [v for g, v in rows if g == key]
        assert got[key].a == pytest.approx(_np(vals, 0.1))
        assert got[key].b == pytest.approx(_np(vals, 0.5))
        assert got[key].c == pytest.approx(_np(vals, 0.9))


def test_multi_quantiles_one_pass(spark):
    rows = [(float(i), float(i * i)) for i in range(101)]
    df = spark.createDataFrame(rows, "x double, y double")
    r = multi_quantiles(df, [("x", 0.5, "mx"), ("y", 0.5, "my"), ("x", 0.25, "qx")]).collect()[0]
    assert (r.mx, r.my, r.qx) == (50.0, 2500.0, 25.0)


def test_empty_input_gives_null(spark):
    df = spark.createDataFrame([], "v double")
    assert quantiles(df, "v", [0.5]).collect()[0][0] is None


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=200), st.sampled_from([0.05, 0.5, 0.93]))
def test_property_exact(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = quantiles(df, "v", [p], steps=3).collect()[0][0]
    assert got == pytest.approx(_np(values, p))


def test_approx_method_close(spark):
    rng = np.random.default_rng(11)
    vals = rng.normal(50, 10, 20000).tolist()
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = quantiles(df, "v", [0.25, 0.5, 0.75], method="approx").collect()[0]
    for i, p in enumerate([0.25, 0.5, 0.75]):
        assert abs(got[i] - _np(vals, p)) < 0.05


def test_exact_equals_builtin_percentile(spark):
    rng = np.random.default_rng(6)
    rows = [("a" if i % 3 else "b", float(x)) for i, x in enumerate(rng.gamma(2.0, 3.0, 4000).round(3))] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = sorted(quantiles(df, "v", [0.1, 0.5, 0.9], by=["g"]).collect())
    expected = sorted(df.groupBy("g").agg(*[F.percentile("v", p) for p in (0.1, 0.5, 0.9)]).collect())
    assert [r[0] for r in got] == [r[0] for r in expected]
    assert np.allclose([r[1:] for r in got], [r[1:] for r in expected], rtol=0, atol=1e-9)


@pytest.mark.parametrize("buckets", [None, 4, 64])
def test_hot_value_and_wanted_buckets_only(spark, buckets):
    # One value holds 40 % of the rows of the hot group and of all rows:
    # wanted ranks fall inside it and on both sides of its bucket edges.
    rng = np.random.default_rng(17)
    hot = [7.25] * 4000 + rng.normal(7, 3, 3000).round(4).tolist()
    cold = rng.uniform(-5, 30, 3000).round(3).tolist()
    rows = [("h", v) for v in hot] + [("c", v) for v in cold]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.02, 0.3, 0.5, 0.61, 0.99, 1.0]
    got = {r.g: r for r in quantiles(df, "v", probs, by=["g"], steps=buckets).collect()}
    for key, vals in (("h", hot), ("c", cold)):
        for i, p in enumerate(probs):
            assert got[key][i + 1] == pytest.approx(_np(vals, p), rel=1e-12, abs=1e-12)
    whole = quantiles(df, "v", probs, steps=buckets).collect()[0]
    for i, p in enumerate(probs):
        assert whole[i] == pytest.approx(_np(hot + cold, p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("ranked_rows", [1, 40])
def test_buckets_are_cut_until_they_are_small(spark, ranked_rows):
    # One step for each doubling, and hardly any rows for a task: several cuts.
    rng = np.random.default_rng(23)
    vals = np.concatenate([np.full(1500, 3.5), 4 + rng.random(3000) / 1e6, rng.normal(0, 1e-9, 900), rng.normal(-5, 90, 600),
                           [np.inf, -np.inf, 5e-324, 1.7e308]]).tolist()
    rows = [("a" if k % 3 else None, v) for k, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(12)
    probs = [0.01, 0.25, 0.5, 0.77, 0.9]
    got = {r.g: r for r in quantiles(df, "v", probs, by=["g"], steps=1, ranked_rows=ranked_rows).collect()}
    for key in ("a", None):
        own = [v for g, v in rows if g == key]
        for i, p in enumerate(probs):
            assert got[key][i + 1] == pytest.approx(_np(own, p), rel=1e-12, abs=1e-300)


def test_overlapping_groups_of_atoms(spark):
    rng = np.random.default_rng(31)
    rows = [(int(a), float(x), float(y)) for a, x, y in zip(rng.integers(0, 5, 3000), rng.normal(3, 9, 3000).round(2), rng.random(3000))]
    df = spark.createDataFrame(rows + [(None, 1.0, 2.0)], "atom int, x double, y double").withColumn("z", F.col("y") * 2)
    members = [(1, "odd"), (3, "odd"), (0, "low"), (1, "low"), (None, "low"), (9, "none")]
    groups = spark.createDataFrame(members, "atom int, name string")
    extra = [("n", "count", None), ("lo", "min", "x"), ("my", "avg", "y"), ("z", "max", "z"), ("s", "sum", "z")]
    got = {r.name: r for r in multi_quantiles(df, [("x", 0.5, "mx"), ("y", 0.9, "qy")], by=["atom"], extra=extra, groups=groups).collect()}
    assert set(got) == {"odd", "low"}
    for name, r in got.items():
        own = [t for t in [*rows, (None, 1.0, 2.0)] if (t[0], name) in members]
        xs, ys = [t[1] for t in own], [t[2] for t in own]
        assert (r.n, r.lo, r.z) == (len(own), min(xs), 2 * max(ys))
        assert (r.mx, r.qy, r.my, r.s) == pytest.approx((_np(xs, 0.5), _np(ys, 0.9), sum(ys) / len(ys), 2 * sum(ys)))


def test_only_wanted_pairs_are_ranked(spark):
    """With 265 groups, rows of a bucket that another group wants stay out."""
    df = spark.range(60_000).select((F.col("id") % 265).alias("g"), F.rand(5).alias("u")).select("g", (F.col("u") * 90 + F.col("g")).alias("v"))
    from cabmeter.functions import quantiles as Q

    seen = []
    original = Q._pick
    try:
        Q._pick = lambda ranked, *rest: seen.append(ranked) or original(ranked, *rest)
        quantiles(df, "v", [0.5], by=["g"]).collect()
    finally:
        Q._pick = original
    ranked = seen[0].agg(F.sum("_c")).first()[0]
    assert ranked < 60_000 * 0.1


def test_extra_aggregates_match_plain_group_by(spark):
    # NULL values count for count(*) and other columns' means, never for
    # ranks; an all-NULL group keeps its row with NULL quantiles.
    rng = np.random.default_rng(29)
    rows = [("a", float(v), float(w)) for v, w in zip(rng.normal(10, 2, 900), rng.uniform(0, 5, 900))]
    rows += [("a", None, 1.0), ("b", None, 2.0), ("b", None, None), (None, 4.0, 3.0)]
    df = spark.createDataFrame(rows, "g string, v double, w double")
    extra = [("rows", "count", None), ("nv", "count", "v"), ("mv", "avg", "v"),
             ("mw", "avg", "w"), ("lo", "min", "v"), ("hi", "max", "w")]
    got = {r.g: r for r in quantiles(df, "v", [0.5], ["med"], by=["g"], extra=extra).collect()}
    want = {r.g: r for r in df.groupBy("g").agg(
        F.count(F.lit(1)).alias("rows"), F.count("v").alias("nv"), F.avg("v").alias("mv"),
        F.avg("w").alias("mw"), F.min("v").alias("lo"), F.max("w").alias("hi")).collect()}
    assert set(got) == set(want)
    for g, w in want.items():
        for c in ("rows", "nv", "lo", "hi"):
            assert got[g][c] == w[c]
        for c in ("mv", "mw"):
            assert (got[g][c] is None and w[c] is None) or got[g][c] == pytest.approx(w[c], rel=1e-12)
    assert got["b"].med is None
    assert got["a"].med == pytest.approx(_np([r[1] for r in rows if r[0] == "a" and r[1] is not None], 0.5))
    empty = quantiles(df.limit(0), "v", [0.5], ["med"], extra=extra).collect()
    assert len(empty) == 1 and empty[0].rows == 0 and empty[0].med is None


def test_multi_quantiles_extra_per_metric(spark):
    rows = [("a" if i % 4 else "b", float(i), None if i % 7 == 0 else float(i * i)) for i in range(120)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    extra = [("n", "count", None), ("xmin", "min", "x"), ("ymin", "min", "y"),
             ("xmean", "avg", "x"), ("ymax", "max", "y")]
    got = {r.g: r for r in multi_quantiles(df, [("x", 0.5, "mx"), ("y", 0.5, "my")], by=["g"],
                                           extra=extra).collect()}
    for r in df.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("xmin"),
                                 F.min("y").alias("ymin"), F.avg("x").alias("xmean"),
                                 F.max("y").alias("ymax")).collect():
        g = got[r.g]
        assert (g.n, g.xmin, g.ymin, g.ymax) == (r.n, r.xmin, r.ymin, r.ymax)
        assert g.xmean == pytest.approx(r.xmean, rel=1e-12)
        ys = [y for k, _, y in rows if k == r.g and y is not None]
        assert g.my == pytest.approx(_np(ys, 0.5))
