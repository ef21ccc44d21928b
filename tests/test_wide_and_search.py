"""Duplicates by prints, distinct counts by bitmaps, temporal search."""

import random

import numpy as np
import pytest

from cabmeter import schema as S
from cabmeter.operators import model as M
from cabmeter.operators import profile as P

WIDE = "a int, b string, c double, split string"


def _wide(spark):
    rng = random.Random(2)
    rows = [(rng.choice([1, 2, None]), rng.choice(["x", None, ""]), rng.choice([0.0, -0.0, float("nan"), None, 1.5]), rng.choice(["u", "v"]))
            for _ in range(80)]
    rows += [(None, "only", 9.0, "w"), (1, None, 7.0, "u"), (None, "1", 7.0, "u")]
    return spark.createDataFrame(rows, WIDE)


@pytest.mark.parametrize("by", [(), ("split",)])
def test_duplicates_by_prints_are_those_by_columns(spark, by):
    df = _wide(spark)
    got = {tuple(r) for r in P.duplicate_count_wide(df, ["a", "b", "c"], by).collect()}
    assert got == {tuple(r) for r in P.duplicate_count(df, ["a", "b", "c"], by).collect()} and got


def test_duplicates_by_prints_of_nothing(spark):
    df = spark.createDataFrame([], WIDE)
    assert [tuple(r) for r in P.duplicate_count_wide(df).collect()] == [(0, 0, 0, None)]


def test_equal_prints_of_other_rows_stay_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(P, "row_print", lambda cols: [F.lit(1).cast("long").alias("_p1"), F.lit(2).cast("long").alias("_p2")])
    df = _wide(spark)
    assert P.duplicate_count_wide(df).collect() == P.duplicate_count(df).collect()


def test_prints_shuffle_no_columns(spark):
    """Before the prints are known, no column of the row is in a shuffle."""
    df = _wide(spark)
    plan = P.repeated_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan


def test_distinct_counts(spark):
    rows = [(i % 7, float(i % 5), i / 3, None, 4, "x" if i % 2 else None, -i, i * 1000, float("nan") if i == 3 else 1.0, i % 2 == 0) for i in range(200)]
    schema = "a int, b double, c double, d int, e long, f string, g long, h long, i double, j boolean"
    df = spark.createDataFrame(rows, schema)
    got = M.distinct_counts(df, list(df.columns))
    from pyspark.sql import functions as F

    assert got == df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in df.columns]).first().asDict()
    empty = M.distinct_counts(df.limit(0), list(df.columns))
    assert set(empty.values()) == {0}


def test_rolling_folds():
    folds = M.rolling_folds([5, 1, 2, 3, 9], least=2, ahead=2)
    assert folds == [([1, 2], [3, 5]), ([1, 2, 3], [5, 9])]
    assert all(max(a) < min(b) for a, b in folds)
    assert M.rolling_folds([1, 2], 2) == []


def test_temporal_search_is_that_of_rows(spark):
    rng = np.random.default_rng(4)
    n = 600
    feats = list(S.OLS_FEATURES)
    x = rng.normal(size=(n, len(feats))) * [3.0, 1.0, 5.0, 0.5, 0.5][: len(feats)] + 20
    month = rng.integers(0, 9, n)
    y = x @ np.arange(1, len(feats) + 1) + rng.normal(size=n) + month * 0.3
    names = feats + [S.DURATION] + [c for c in (S.YEAR, S.MONTH) if c not in feats]
    extra = {S.YEAR: 2000.0 + month // 12, S.MONTH: month % 12 + 1.0}
    columns = {**{f: x[:, i] for i, f in enumerate(feats)}, S.DURATION: y}
    for c, v in extra.items():
        columns[c] = v
    data = np.column_stack([columns[c] for c in names])
    df = spark.createDataFrame([tuple(map(float, r)) for r in data] + [tuple([None] + [1.0] * (len(names) - 1))], ", ".join(f"`{c}` double" for c in names))
    design = np.column_stack([columns[f] for f in feats])
    got = M.temporal_search(df, penalties=(0.0, 0.1), least=4).collect()
    # the row with a missing feature is in no month's sums
    assert len(got) == 2 * 5
    for r in got:
        at = np.asarray(2000 * 12 + month)
        train, check = (at >= r.train_from) & (at <= r.train_to), (at >= r.check_from) & (at <= r.check_to)
        assert r.train_to < r.check_from and (r.train_rows, r.check_rows) == (train.sum(), check.sum())
        mu, sd = design[train].mean(0), design[train].std(0)
        live = sd > 1e-9
        z = np.where(live, (design[train] - mu) / np.where(live, sd, 1), 0)
        a = z.T @ z / len(z) + (r.penalty + 1e-300) * np.eye(z.shape[1])
        w = np.linalg.lstsq(a, z.T @ (y[train] - y[train].mean()) / len(z), rcond=1e-10)[0]
        p = np.where(live, (design[check] - mu) / np.where(live, sd, 1), 0) @ w + y[train].mean()
        assert r.rmse == pytest.approx(np.sqrt(np.mean((p - y[check]) ** 2)), rel=1e-6)
    assert len({r.penalty for r in got if r.chosen}) == 1
    least = min(got, key=lambda r: (r.mean_rmse, r.penalty))
    assert least.chosen


def test_temporal_search_of_few_months(spark):
    names = list(dict.fromkeys([*S.OLS_FEATURES, S.DURATION, S.YEAR, S.MONTH]))
    df = spark.createDataFrame([], ", ".join(f"`{c}` double" for c in names))
    assert M.temporal_search(df).collect() == []
