"""Modelling and evaluation on tables (§2.8).

Fitting uses Spark ML: least squares with the normal-equation solver (one
distributed pass builds the small Gram matrix), boosted trees with
``GBTRegressor``.  Scored output is one DataFrame - label, prediction and
the columns the error reports group by - never position-aligned arrays.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..functions.quantiles import attach, quantiles
from ..session import checkpoint_dir
from . import boosting


def fit_ols(train: DataFrame, features: Sequence[str] = S.OLS_FEATURES,
            target: str = S.DURATION) -> PipelineModel:
    """Ordinary least squares with intercept, no regularisation.

    Rows with a missing feature or target are left out of the fit
    (``missing_values`` counts them); scoring keeps every row, with a NaN
    prediction where a feature is missing."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features",
                                handleInvalid="keep")
    lr = LinearRegression(featuresCol="features", labelCol=target, predictionCol="prediction",
                          solver="normal", regParam=0.0, elasticNetParam=0.0,
                          standardization=False, fitIntercept=True)
    data = train.select(*[F.col(c).cast("double") for c in features],
                        F.col(target).cast("double"))
    return Pipeline(stages=[assembler, lr]).fit(data.na.drop())


def missing_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: all rows, rows with a NULL or NaN in any of the columns, and
    the number of such rows for each column."""
    gone = [F.coalesce(F.isnan(F.col(c).cast("double")), F.lit(False)) | F.col(c).isNull()
            for c in columns]
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(F.array_contains(F.array(*gone), True)).alias("unusable"),
                  *[F.count_if(g).alias(c) for g, c in zip(gone, columns)])


def ols_coefficients(model: PipelineModel, features: Sequence[str] = S.OLS_FEATURES) -> DataFrame:
    """(term, coefficient): one row per feature plus the intercept."""
    from pyspark.sql import SparkSession

    lr = model.stages[-1]
    rows = [(f, float(c)) for f, c in zip(features, lr.coefficients.toArray())]
    rows.append(("intercept", float(lr.intercept)))
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "term STRING, coefficient DOUBLE")


def fit_boosted(train: DataFrame, numeric: Sequence[str] = S.BOOSTED_NUMERIC,
                categorical: Sequence[str] = S.BOOSTED_CATEGORICAL_11,
                target: str = S.DURATION, max_iter: int = S.BOOST_ITERATIONS,
                max_depth: int = S.BOOST_DEPTH, min_leaf: int = S.BOOST_MIN_LEAF,
                step: float = S.BOOST_RATE, max_bins: int = S.BOOST_BINS,
                seed: int = S.BOOST_SEED, persist: bool = True,
                zones_categorical: bool = False) -> PipelineModel:
    """Boosted regression trees; the listed categorical columns are marked
    categorical (``VectorIndexer`` on their own vector), the rest numeric.
    A categorical column with more than ``max_bins`` values is an error.

    ``boosting`` grows the trees of ``GBTRegressor`` over packed rows; trees
    deeper than it can (``boosting.DEPTH``) are left to Spark's own code.

    ``zones_categorical`` moves the pickup/dropoff zones to the categorical
    side (Spark has no 255-category ceiling; ``maxBins`` is raised to cover
    the 265 zones).  Off by default, as in the reference."""
    if zones_categorical:
        zones = [S.PU_ZONE, S.DO_ZONE]
        numeric = [c for c in numeric if c not in zones]
        categorical = list(categorical) + [z for z in zones if z not in categorical]
        max_bins = max(max_bins, S.ZONE_RANGE[1] + 1)
    data = train.select(*[F.col(c).cast("double") for c in list(numeric) + list(categorical)],
                        F.col(target).cast("double"))
    checkpoint_dir(train.sparkSession)  # boosting cuts its lineage there every ten rounds
    if persist:
        data = data.persist()     # read for the categories, the thresholds and the bins
    try:
        stages = []
        cat_vec = []
        if categorical:
            counts = distinct_counts(data, categorical)
            wide = {c: counts[c] for c in categorical if counts[c] > max_bins}
            if wide:
                raise ValueError(f"categorical columns with more than {max_bins} values: {wide}")
            stages.append(VectorAssembler(inputCols=list(categorical), outputCol="_cat_raw",
                                          handleInvalid="keep"))
            stages.append(VectorIndexer(inputCol="_cat_raw", outputCol="_cat",
                                        maxCategories=max(2, *counts.values()), handleInvalid="keep"))
            cat_vec = ["_cat"]
        stages.append(VectorAssembler(inputCols=list(numeric) + cat_vec, outputCol="features",
                                      handleInvalid="keep"))
        gbt = GBTRegressor(featuresCol="features", labelCol=target,
                           predictionCol="prediction", maxIter=max_iter,
                           maxDepth=max_depth, minInstancesPerNode=min_leaf,
                           stepSize=step, maxBins=max_bins, seed=seed,
                           lossType="squared")
        if max_depth > boosting.DEPTH:
            return Pipeline(stages=[*stages, gbt]).fit(data)
        prepared = Pipeline(stages=stages).fit(data)
        maps = prepared.stages[1].categoryMaps if categorical else {}
        layout, rows = boosting.packed(data, data.columns[:-1], [{}] * len(numeric) + [dict(maps[i]) for i in range(len(categorical))],
                                       target, max_bins, seed)
    finally:
        if persist:
            data.unpersist()
    return PipelineModel([*prepared.stages, boosting.fit_packed(gbt, train.sparkSession, layout, rows)])


def fit_boosted_12(train: DataFrame, **kw) -> PipelineModel:
    return fit_boosted(train, S.BOOSTED_NUMERIC, S.BOOSTED_CATEGORICAL_12, **kw)


def fit_boosted_11(train: DataFrame, **kw) -> PipelineModel:
    return fit_boosted(train, S.BOOSTED_NUMERIC, S.BOOSTED_CATEGORICAL_11, **kw)


BITMAP_VALUES = 1 << 15  # values of one of Spark's bitmaps


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Exact COUNT(DISTINCT) of many columns without a copy of the rows for
    each.

    One scan gives each column's bounds, whether its values are all whole
    numbers, and a distinct sketch.  Whole numbers that span less than 32,768
    are then counted in a bitmap of 4 KB, which merges like a sum; a column
    with one value needs none.  Only the columns that are left (wide or
    fractional) are counted by their values, one aggregate each."""
    kinds = dict(df.select(*columns).dtypes)
    numeric = [c for c in columns if kinds[c] in ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean") or kinds[c].startswith("decimal")]
    value = {c: F.col(f"`{c}`").cast("double") for c in numeric}
    whole = {c: F.coalesce(F.bool_and((F.floor(v) == v) & (F.abs(v) < float(1 << 52))), F.lit(True)) for c, v in value.items()}
    bounds = df.agg(F.count(F.lit(1)).alias("rows"), *[e.alias(f"{k}{i}") for i, c in enumerate(numeric)
                                                       for k, e in (("lo", F.min(value[c])), ("hi", F.max(value[c])), ("w", whole[c]))]).first()
    out, mapped = {}, {}
    for i, c in enumerate(numeric):
        lo, hi = bounds[f"lo{i}"], bounds[f"hi{i}"]
        if lo is None:
            out[c] = 0
        elif lo == hi:
            out[c] = 1
        elif bounds[f"w{i}"] and hi - lo < BITMAP_VALUES:
            mapped[c] = lo
    if mapped:
        row = df.agg(*[F.bitmap_count(F.bitmap_construct_agg((value[c] - F.lit(lo)).cast("long"))).alias(f"d{i}")
                       for i, (c, lo) in enumerate(mapped.items())]).first()
        out.update(zip(mapped, row))
    for c in columns:
        if c not in out:
            out[c] = df.agg(F.count_distinct(F.col(f"`{c}`"))).first()[0]
    return {c: int(out[c]) for c in columns}


def feature_cardinality(train: DataFrame, numeric: Sequence[str] = S.BOOSTED_NUMERIC,
                        categorical: Sequence[str] = S.BOOSTED_CATEGORICAL_12,
                        max_bins: int = S.BOOST_BINS, approximate: bool = False) -> DataFrame:
    """Distinct values per feature, flagged when constant in training or
    when a categorical has more values than ``max_bins``.  Exact by
    ``distinct_counts``, or with ``approximate`` by one pass of sketches."""
    feats = list(numeric) + list(categorical)
    if approximate:
        counts = train.agg(*[F.approx_count_distinct(F.col(c)).alias(c) for c in feats]).first().asDict()
    else:
        counts = distinct_counts(train, feats)
    rows = [(i + 1, c, "categorical" if c in categorical else "numeric", counts[c]) for i, c in enumerate(feats)]
    long = train.sparkSession.createDataFrame(rows, "position INT, feature STRING, kind STRING, distinct_values BIGINT")
    return long.select(
        "position", "feature", "kind", "distinct_values",
        (F.col("distinct_values") <= 1).alias("constant_in_train"),
        ((F.col("kind") == "categorical") & (F.col("distinct_values") > max_bins))
        .alias("too_many_categories"))


def target_stats(df: DataFrame, target: str = S.DURATION, method: str = "exact") -> DataFrame:
    base = df.agg(F.count(target).alias("n"), F.avg(target).alias("mean"))
    med = quantiles(df, target, [0.5], ["median"], method=method)
    return attach(base, med, [])


def regression_metrics(scored: DataFrame, label: str = S.DURATION,
                       prediction: str = "prediction") -> DataFrame:
    """MAE, RMSE and R^2 = 1 - SSE/SST in one aggregate.

    A constant label (SST = 0) gives R^2 = 1.0 for a perfect fit and 0.0
    otherwise; an empty input gives NULL."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    err = y - p
    a = scored.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("MAE"),
                   F.sqrt(F.avg(err * err)).alias("RMSE"), F.sum(err * err).alias("_sse"),
                   F.var_pop(y).alias("_var"))
    sst = F.col("n") * F.col("_var")
    r2 = (F.when(F.col("n") == 0, F.lit(None).cast("double"))
          .when(sst == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - F.col("_sse") / sst))
    return a.select("n", "MAE", "RMSE", r2.alias("R2"))


def metrics_long(metrics: DataFrame) -> DataFrame:
    return metrics.selectExpr("stack(3, 'MAE', MAE, 'RMSE', RMSE, 'R2', R2) AS (metric, value)")


def metric_comparison(metrics: DataFrame, reference: Mapping[str, float]) -> DataFrame:
    """metric, reference value, new value, delta, percent change."""
    spark = metrics.sparkSession
    ref = spark.createDataFrame(list(reference.items()), "metric STRING, reference DOUBLE")
    out = metrics_long(metrics).join(F.broadcast(ref), "metric")
    delta = F.col("value") - F.col("reference")
    return out.select("metric", "reference", "value", delta.alias("delta"),
                      F.try_divide(delta * 100.0, F.abs(F.col("reference"))).alias("pct_change"))


def compare_parts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Metrics of one model on two parts of the data: metric, reference (the
    first part), value (the second), delta and percent change."""
    left = metrics_long(before).withColumnRenamed("value", "reference")
    out = metrics_long(after).join(left, "metric")
    delta = F.col("value") - F.col("reference")
    return out.select("metric", "reference", "value", delta.alias("delta"),
                      F.try_divide(delta * 100.0, F.abs(F.col("reference"))).alias("pct_change"))


def request_features(validated: DataFrame) -> DataFrame:
    """Validated requests with the columns that models were trained on: the
    weekday with Sunday = 0, the weekend and the long-haul flag."""
    dow = F.col("dow_sunday0")
    return validated.withColumns({
        S.DOW: dow, S.WEEKEND: dow.isin(0, 6).cast("int"),
        S.LONG_HAUL: (F.col(S.DISTANCE) > S.LONG_HAUL_MILES).cast("int")})


def batch_score(model: PipelineModel, requests: DataFrame, valid_col: str = "is_valid",
                features: Sequence[str] | None = None) -> DataFrame:
    """Score validated requests: one row per valid request, the prediction
    clamped at 0, NULL where the model gives none because a feature is
    missing.  Requests must carry the model's feature columns."""
    rows = requests.where(F.col(valid_col)) if valid_col in requests.columns else requests
    if features:
        rows = rows.withColumns({c: F.col(c).cast("double") for c in features})
    scored = model.transform(rows)
    p = F.col("prediction")
    return scored.withColumn("prediction", F.when(p.isNotNull() & ~F.isnan(p),
                                                  F.greatest(p, F.lit(0.0))))


def overall_mae(scored: DataFrame, label: str = S.DURATION,
                prediction: str = "prediction") -> DataFrame:
    err = F.abs(F.col(label).cast("double") - F.col(prediction).cast("double"))
    return scored.agg(F.avg(err).alias("mae"), F.count(F.lit(1)).alias("rows"))


def mae_by_distance(scored: DataFrame, label: str = S.DURATION, prediction: str = "prediction",
                    distance: str = S.DISTANCE) -> DataFrame:
    """MAE and count for every distance bucket; empty buckets: NULL / 0."""
    spark = scored.sparkSession
    err = F.abs(F.col(label).cast("double") - F.col(prediction).cast("double"))
    agg = scored.groupBy(C.error_bucket_index(distance).alias("bucket_id")) \
                .agg(F.avg(err).alias("mae"), F.count(F.lit(1)).alias("trips"))
    buckets = spark.createDataFrame(list(enumerate(S.ERROR_BUCKET_LABELS)),
                                    "bucket_id INT, bucket STRING")
    out = agg.join(F.broadcast(buckets), "bucket_id", "right")
    return out.select("bucket_id", "bucket", "mae",
                      F.coalesce(F.col("trips"), F.lit(0)).cast("long").alias("trips"))


def mae_by_hour(scored: DataFrame, label: str = S.DURATION, prediction: str = "prediction",
                hour: str = S.HOUR) -> DataFrame:
    """MAE, count and time band for all 24 hours; empty hours: NULL / 0."""
    spark = scored.sparkSession
    err = F.abs(F.col(label).cast("double") - F.col(prediction).cast("double"))
    agg = scored.groupBy(F.col(hour).cast("int").alias("hour")) \
                .agg(F.avg(err).alias("mae"), F.count(F.lit(1)).alias("trips"))
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    out = agg.join(F.broadcast(hours), "hour", "right")
    return out.select("hour", C.time_band("hour").alias("band"), "mae",
                      F.coalesce(F.col("trips"), F.lit(0)).cast("long").alias("trips"))


def fold_of(columns: Sequence[str], folds: int) -> Column:
    """A fold by the md5 of the columns' values; equal rows share one."""
    key = F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % folds).cast("int")


FOLD_COLUMNS = (S.YEAR, S.MONTH, S.DAY, S.HOUR, S.PU_ZONE, S.DO_ZONE)


def target_encode(df: DataFrame, column: str = S.PU_ZONE, target: str = S.DURATION, folds: int = 5, weight: float = 20.0,
                  fold_columns: Sequence[str] = FOLD_COLUMNS, out: str | None = None) -> DataFrame:
    """``df`` with ``fold`` and ``out`` (``<column>_encoded``): the mean target
    of the column's value over all *other* folds, drawn towards their overall
    mean as by ``weight`` further rows.

    Sums leave a fold out by subtraction, so the data are aggregated once, to
    values x folds rows.  No row's own target, nor that of an equal row, is in
    its encoding.  A value seen in one fold only gets the mean of the others;
    rows with a NULL target count for nothing and are encoded; NULL is a value."""
    rows = df.withColumn("fold", fold_of(fold_columns, folds))
    y = F.col(target).cast("double")
    cells = rows.groupBy(F.col(column).alias("_value"), F.col("fold").alias("_fold")).agg(F.coalesce(F.sum(y), F.lit(0.0)).alias("_s"), F.count(y).alias("_n"))
    # Both windows are over this small table: a value has at most ``folds`` rows, and the overall sums are one row a fold.
    value = Window.partitionBy("_value")
    fold = cells.groupBy(F.col("_fold").alias("_ff")).agg(F.sum("_s").alias("_fs"), F.sum("_n").alias("_fn"))
    total = cells.agg(F.sum("_s").alias("_ts"), F.sum("_n").alias("_tn"))
    fold = attach(fold, total, []).select("_ff", F.try_divide(F.col("_ts") - F.col("_fs"), F.col("_tn") - F.col("_fn")).alias("_mean"))
    cells = (cells.withColumns({"_os": F.sum("_s").over(value) - F.col("_s"), "_on": F.sum("_n").over(value) - F.col("_n")})
             .join(fold, F.col("_fold") == F.col("_ff")))
    encoded = (F.col("_os") + weight * F.col("_mean")) / (F.col("_on") + weight)
    cells = cells.select("_value", "_fold", encoded.alias(out or f"{column}_encoded"))
    return rows.join(cells, F.col(column).eqNullSafe(F.col("_value")) & (F.col("fold") == F.col("_fold")), "left").drop("_value", "_fold")


def prediction_intervals(calibration: DataFrame, scored: DataFrame, level: float = 0.9, label: str = S.DURATION,
                         prediction: str = "prediction", distance: str = S.DISTANCE, hour: str = S.HOUR) -> DataFrame:
    """``scored`` with ``lower`` and ``upper``: the prediction plus and minus
    the ``level`` quantile of the absolute residuals that ``calibration`` has
    in the same distance bucket and hour (split conformal, interpolated).

    Buckets and hours without calibration rows take the quantile of all of
    them; ``lower`` is not below 0."""
    bucket = C.error_bucket_index(distance)
    residuals = calibration.select(bucket.alias("_bucket"), F.col(hour).alias("_hour"),
                                   F.abs(F.col(label).cast("double") - F.col(prediction)).alias("_r"))
    widths = quantiles(residuals, "_r", [level], ["_w"], by=["_bucket", "_hour"]).select(
        F.col("_bucket").alias("_wb"), F.col("_hour").alias("_wh"), "_w")
    overall = quantiles(residuals, "_r", [level], ["_all"])
    rows = scored.withColumn("_bucket", bucket)
    rows = rows.join(widths, F.col("_bucket").eqNullSafe(F.col("_wb")) & F.col(hour).eqNullSafe(F.col("_wh")), "left")
    width = F.coalesce("_w", overall.scalar())
    p = F.col(prediction)
    return rows.withColumns({"lower": F.greatest(p - width, F.lit(0.0)), "upper": p + width}).drop("_bucket", "_wb", "_wh", "_w")


def interval_coverage(rows: DataFrame, label: str = S.DURATION, distance: str = S.DISTANCE) -> DataFrame:
    """Per distance bucket: rows, rows whose label lies in the interval, their
    share, and the mean width."""
    y = F.col(label).cast("double")
    out = rows.groupBy(C.error_bucket_index(distance).alias("bucket_id")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(y.between(F.col("lower"), F.col("upper"))).alias("covered"),
        F.avg(F.col("upper") - F.col("lower")).alias("mean_width"))
    return out.select("bucket_id", "rows", "covered", C.pct(F.col("covered"), F.col("rows")).alias("coverage"), "mean_width")


def rolling_folds(months: Sequence[int], least: int, ahead: int = 1, step: int = 1) -> list[tuple[list[int], list[int]]]:
    """Rolling-origin folds over distinct months (any ascending numbers): all
    months before an origin train, the ``ahead`` months from it on validate.
    The first origin has ``least`` months before it."""
    months = sorted(months)
    return [(months[:k], months[k: k + ahead]) for k in range(least, len(months) - ahead + 1, step)]


def _moments(df: DataFrame, features: Sequence[str], target: str) -> dict:
    """For each month (year * 12 + month - 1): rows, and sums of all products
    of two of (1, features, target), as one matrix.  One aggregate, whose
    result has a row a month."""
    import numpy as np

    cols = [F.lit(1.0)] + [F.col(c).cast("double") for c in features] + [F.col(target).cast("double")]
    kept = df.select((F.col(S.YEAR) * 12 + F.col(S.MONTH) - 1).cast("long").alias("_month"), *[c.alias(f"c{i}") for i, c in enumerate(cols)])
    kept = kept.na.drop()
    k = len(cols)
    places = [(i, j) for i in range(k) for j in range(i, k)]
    sums = kept.groupBy("_month").agg(*[F.sum(F.col(f"c{i}") * F.col(f"c{j}")).alias(f"s{i}_{j}") for i, j in places])
    out = {}
    for row in sums.collect():  # a row for each month of the calendar
        matrix = np.zeros((k, k))
        for i, j in places:
            matrix[i, j] = matrix[j, i] = row[f"s{i}_{j}"]
        out[int(row["_month"])] = matrix
    return out


def _ridge(moments, penalty: float):
    """Intercept and weights of ridge regression on scaled features, from the
    moments: the penalty is per row and on weights of unit-variance features;
    a constant feature has weight 0."""
    import numpy as np

    n, mean = moments[0, 0], moments[0, 1:] / moments[0, 0]
    cov = moments[1:, 1:] / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(cov)[:-1], 0.0))
    live = scale > 1e-9 * np.maximum(np.abs(mean[:-1]), 1.0)
    weights = np.zeros(len(scale))
    if live.any():
        s = scale[live]
        a = cov[:-1, :-1][np.ix_(live, live)] / np.outer(s, s)
        b = cov[:-1, -1][live] / s
        weights[live] = np.linalg.lstsq(a + penalty * np.eye(len(s)), b, rcond=1e-10)[0] / s
    return np.concatenate(([mean[-1] - weights @ mean[:-1]], weights))


def temporal_search(df: DataFrame, penalties: Sequence[float] = (0.0, 0.001, 0.01, 0.1, 1.0),
                    features: Sequence[str] = S.OLS_FEATURES, target: str = S.DURATION,
                    least: int = 6, ahead: int = 1, step: int = 1) -> DataFrame:
    """A search for the penalty of ridge regression by rolling-origin folds:
    one row a fold and penalty with the RMSE on the fold's validation months,
    and ``mean_rmse`` and ``chosen`` (the least mean, ties: the first penalty).

    Training months of a fold all lie before its validation months.  Sums of
    products by month are enough for every fit and every squared error, so the
    whole search is one scan, whatever the number of folds and penalties; the
    driver holds one small matrix a month.  Rows with a missing value are left
    out.  Fewer than ``least + ahead`` months give no rows."""
    import numpy as np

    by_month = _moments(df, features, target)
    rows = []
    for fold, (train, check) in enumerate(rolling_folds(list(by_month), least, ahead, step)):
        fitted = sum(by_month[m] for m in train)
        held = sum(by_month[m] for m in check)
        for place, penalty in enumerate(penalties):
            error = np.append(_ridge(fitted, penalty), -1.0)
            rmse = float(np.sqrt(max(error @ held @ error, 0.0) / held[0, 0]))
            rows.append((fold, train[0], train[-1], check[0], check[-1], int(fitted[0, 0]), int(held[0, 0]), place, float(penalty), rmse))
    schema = ("fold INT, train_from BIGINT, train_to BIGINT, check_from BIGINT, check_to BIGINT, train_rows BIGINT, check_rows BIGINT, "
              "place INT, penalty DOUBLE, rmse DOUBLE")
    table = df.sparkSession.createDataFrame(rows, schema)
    mean = table.groupBy("place").agg(F.avg("rmse").alias("mean_rmse"))
    best = mean.agg(F.min_by("place", F.struct("mean_rmse", "place"))).scalar()
    return (table.join(F.broadcast(mean), "place").withColumn("chosen", F.col("place") == best)
            .select(*[c.split()[0] for c in schema.split(", ") if not c.startswith("place")], "mean_rmse", "chosen"))
