"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Inputs are the driver's tables (trips are derived from ``lineitem`` by
``sources.trips``), so each query's work grows with them.  DOUBLE columns
are rounded to 6 decimals for the cross-engine comparison; nothing else is
changed.  Fixture parameters (the years of the test data) are below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..operators import features as FT
from ..operators import model as M
from ..operators import outliers as O
from ..operators import profile as P
from ..operators import rules as R
from ..operators import splits as SP
from ..operators import topk as K
from ..session import scratch_path
from ..sources import sinks
from ..sources import trips as TR

# Fixture parameters: the test data runs 1992-1998 (+ shipping days), so the
# split cut-offs and candidate years move accordingly (FIXTURES.md).
TRAIN_END = (2000, 1)
VALIDATION_END = (2001, 1)
FIRST_YEAR, SECOND_YEAR = 2000, 2001
ZONE_MIN_TRIPS = 100

Query = Callable[[SparkSession, str], DataFrame]


def round6(c):
    """Half away from zero at 6 decimals, spelled with IEEE operations only
    (sign, abs, multiply, add, floor, divide), so both engines agree bit for
    bit; the oracle SQL uses the same spelling."""
    scaled = F.floor(F.abs(c) * F.lit(1000000.0) + F.lit(0.5)).cast("double")
    return F.signum(c) * scaled / F.lit(1000000.0)


def rounded(df: DataFrame) -> DataFrame:
    cols = [round6(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields]
    return df.select(*cols)


# ---------------------------------------------------------------------------
# Shared inputs.
# ---------------------------------------------------------------------------
def trips(spark, sf):
    return TR.materialized_trips(spark, sf)


def cleaned(spark, sf):
    return FT.model_frame(R.clean_trips(trips(spark, sf)))


def split_frame(spark, sf):
    return SP.temporal_split(cleaned(spark, sf), TRAIN_END, VALIDATION_END, start=None, end=None)


def part(spark, sf, name):
    return split_frame(spark, sf).where(F.col("split") == name).drop("split")


def ols_model(spark, sf):
    return M.fit_ols(part(spark, sf, "train"))


_BOOSTED: dict[tuple, tuple] = {}


def boosted_model(spark, sf):
    """The 11-feature boosted model, fitted once a session for each input and
    saved: the fitted pipeline and where it was saved."""
    key = (spark, sf.rstrip("/"))
    if key not in _BOOSTED:
        model = M.fit_boosted_11(part(spark, sf, "train"))
        path = scratch_path(spark, "boosted_11")
        sinks.save_model(model, path, S.BOOSTED_FEATURES_11, spark)
        _BOOSTED[key] = model, path
    return _BOOSTED[key]


def dealt(spark, sf, name):
    """What a boosted model needs of one part, dealt evenly: trips are stored
    by time, so a part is in a few files, whose tasks would be too few to score it."""
    rows = part(spark, sf, name).select(*S.BOOSTED_FEATURES_12, S.DURATION)
    return rows.repartition(spark.sparkContext.defaultParallelism)


def ols_scored(spark, sf, name):
    return ols_model(spark, sf).transform(part(spark, sf, name))


# ---------------------------------------------------------------------------
# Query definitions.
# ---------------------------------------------------------------------------
def q_scan_trips(spark, sf):
    t = trips(spark, sf)
    base = scratch_path(spark, "scan_trips")
    early = f"{base}/early.parquet"
    late = f"{base}/late.parquet"
    yr = F.year(S.PICKUP)
    sinks.write_parquet(t.where(yr < 1996), early)
    sinks.write_parquet(t.where((yr >= 1996) | yr.isNull()), late)
    return TR.scan_trips(spark, [early, late])


def q_scan_projected(spark, sf):
    return TR.scan_projected(cleaned(spark, sf), S.BOOSTED_NUMERIC, S.BOOSTED_CATEGORICAL_11)


def q_write_cleaned(spark, sf):
    return sinks.write_cleaned(cleaned(spark, sf), scratch_path(spark, "cleaned"))


def q_rule_impact_on_write(spark, sf):
    _, counts = sinks.clean_and_write(trips(spark, sf), scratch_path(spark, "cleaned_obs"))
    rules = R.default_rules()
    rows = [(r.rule_id, r.name, r.action, int(counts[f"rule_{r.rule_id}"]),
             int(counts["original_rows"])) for r in rules]
    df = spark.createDataFrame(rows, "rule_id INT, rule STRING, action STRING, "
                                     "rows_matched BIGINT, total BIGINT")
    return df.select("rule_id", "rule", "action", "rows_matched",
                     F.try_divide(F.col("rows_matched").cast("double") * F.lit(100.0),
                                  F.col("total").cast("double")).alias("pct"))


def q_write_splits(spark, sf):
    back = sinks.write_splits(split_frame(spark, sf), scratch_path(spark, "splits"))
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


def q_split_integrity(spark, sf):
    back = sinks.write_splits(split_frame(spark, sf), scratch_path(spark, "splits_checked"))
    return SP.split_integrity(back, source=cleaned(spark, sf))


def q_write_scored(spark, sf):
    return sinks.write_scored(ols_scored(spark, sf, "test"), scratch_path(spark, "scored"))


def q_model_round_trip(spark, sf):
    model = ols_model(spark, sf)
    loaded = sinks.model_round_trip(model, scratch_path(spark, "ols_model"))
    test = part(spark, sf, "test")
    a = model.transform(test).withColumnRenamed("prediction", "p_saved").drop("features")
    b = loaded.transform(a).withColumnRenamed("prediction", "p_loaded")
    return b.agg(F.count(F.lit(1)).alias("rows"),
                 F.max(F.abs(F.col("p_saved") - F.col("p_loaded"))).alias("max_abs_diff"))


def q_trip_duration(spark, sf):
    return FT.trip_duration(trips(spark, sf), out="duration_from_timestamps") \
        .select(S.PICKUP, S.DROPOFF, "duration_from_timestamps")


def q_calendar_features(spark, sf):
    return FT.calendar_features(trips(spark, sf)).select(
        S.PICKUP, S.YEAR, S.MONTH, S.DAY, S.DOW, S.HOUR)


def q_is_weekend(spark, sf):
    t = FT.calendar_features(trips(spark, sf))
    return FT.is_weekend(t).select(S.PICKUP, S.DOW, S.WEEKEND)


def q_is_long_haul(spark, sf):
    return FT.is_long_haul(trips(spark, sf)).select(S.DISTANCE, S.LONG_HAUL)


def q_cast_codes(spark, sf):
    return FT.cast_codes(trips(spark, sf)).select(
        S.PASSENGERS, S.RATECODE, S.VENDOR, S.PU_ZONE, S.DO_ZONE)


def q_model_frame(spark, sf):
    return FT.check_schema(cleaned(spark, sf))


def q_column_profile(spark, sf):
    return FT.column_profile(cleaned(spark, sf))


def q_time_labels(spark, sf):
    return FT.time_labels(cleaned(spark, sf)).select(
        S.YEAR, S.MONTH, S.DOW, "period", "month_name", "weekday_name")


def q_code_labels(spark, sf):
    return FT.code_labels(trips(spark, sf)).select(
        S.RATECODE, S.VENDOR, "ratecode_label", "vendor_label")


def q_distance_group(spark, sf):
    return FT.distance_group(trips(spark, sf)).select(S.DISTANCE, "dist_group")


def q_error_distance_bucket(spark, sf):
    return FT.error_distance_bucket(trips(spark, sf)).select(
        S.DISTANCE, "distance_bucket_id", "distance_bucket")


def q_time_band(spark, sf):
    return FT.time_band(cleaned(spark, sf)).select(S.HOUR, "time_band")


def q_pickup_hour_bounds(spark, sf):
    return FT.pickup_hour_bounds(cleaned(spark, sf)).select(
        S.YEAR, S.MONTH, S.DAY, S.HOUR, "hour_start", "hour_end")


def q_clean_trips(spark, sf):
    return R.clean_trips(trips(spark, sf))


def q_validate_requests(spark, sf):
    v = R.validate_requests(TR.requests_from_trips(trips(spark, sf)))
    return v.select(*[c for c in v.columns if c != "violations"],
                    F.array_join("violations", "; ").alias("violation_text"))


def q_duration_by_hour_events(spark, sf):
    return P.duration_by_hour(TR.event_trips(spark, sf), ts="ts", value="value")


def q_batch_score(spark, sf):
    model = ols_model(spark, sf)
    req = R.validate_requests(TR.requests_from_trips(trips(spark, sf)))
    req = req.withColumn(S.DOW, F.col("dow_sunday0"))    # the model's convention
    scored = M.batch_score(model, req, features=S.OLS_FEATURES)
    return scored.select(*S.OLS_FEATURES, S.PU_ZONE, S.DO_ZONE, S.RATECODE, S.VENDOR,
                         "prediction")


def q_boosted_score(spark, sf):
    """Facts of a scoring run with the saved boosted model: requests scored,
    the largest difference that saving made, predictions below 0 or missing."""
    fitted, path = boosted_model(spark, sf)
    loaded, features = sinks.load_model(spark, path, S.BOOSTED_FEATURES_11)
    req = M.request_features(R.validate_requests(TR.requests_from_trips(trips(spark, sf))))
    one = M.batch_score(fitted, req, features=features).withColumnRenamed("prediction", "fitted")
    both = M.batch_score(loaded, one.select(*features, "fitted"), features=features)
    p = F.col("prediction")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.max(F.abs(p - F.col("fitted"))).alias("max_abs_diff"),
                    F.count_if(p < 0).alias("negative"), F.count_if(p.isNull()).alias("missing"))


def q_fit_boosted_11(spark, sf):
    return M.regression_metrics(boosted_model(spark, sf)[0].transform(dealt(spark, sf, "validation")))


def q_boosted_comparison(spark, sf):
    model = boosted_model(spark, sf)[0]
    return M.compare_parts(*(M.regression_metrics(model.transform(dealt(spark, sf, n))) for n in ("validation", "test")))


def q_distance_cap(spark, sf):
    kept = R.cap_at_quantile(trips(spark, sf))
    return kept.agg(F.count(F.lit(1)).alias("rows"), F.max(S.DISTANCE).alias("max_distance"), F.avg(S.DURATION).alias("avg_dur"))


def q_target_encoding(spark, sf):
    rows = M.target_encode(part(spark, sf, "train"))
    enc = f"{S.PU_ZONE}_encoded"
    return rows.groupBy(S.PU_ZONE, "fold").agg(F.count(F.lit(1)).alias("rows"), F.min(enc).alias("encoded"), F.max(enc).alias("encoded_max"))


def q_interval_coverage(spark, sf):
    model = ols_model(spark, sf)
    calibration, test = (model.transform(part(spark, sf, n)) for n in ("validation", "test"))
    return M.interval_coverage(M.prediction_intervals(calibration, test))


def q_stream_batch_score(spark, sf):
    from ..streaming import trips_stream as ST

    base = scratch_path(spark, "stream_scored")
    scored = ST.score_stream(ols_model(spark, sf), ST.validate_stream(ST.trips_stream(spark, sf)))
    scored = scored.select(*S.OLS_FEATURES, S.PU_ZONE, S.DO_ZONE, S.RATECODE, S.VENDOR, "prediction")
    return ST.run_available(scored, f"{base}/out", f"{base}/checkpoint")


def q_split_candidates(spark, sf):
    return SP.split_candidates(cleaned(spark, sf), FIRST_YEAR, SECOND_YEAR)


def q_fit_boosted(categorical):
    def run(spark, sf):
        model = M.fit_boosted(part(spark, sf, "train"), S.BOOSTED_NUMERIC, categorical)
        return M.regression_metrics(model.transform(dealt(spark, sf, "validation")))
    return run


def q_stream_clean_trips(spark, sf):
    from ..streaming import trips_stream as ST

    base = scratch_path(spark, "stream_clean")
    cleaned_stream = ST.clean_stream(ST.trips_stream(spark, sf))
    return ST.run_available(cleaned_stream, f"{base}/out", f"{base}/checkpoint") \
        .select(*S.CLEANED_COLUMNS)


def q_stream_validate_requests(spark, sf):
    from ..streaming import trips_stream as ST

    base = scratch_path(spark, "stream_requests")
    return ST.run_available(ST.validate_stream(ST.trips_stream(spark, sf)),
                            f"{base}/out", f"{base}/checkpoint")


def _q(fn, source):
    return lambda spark, sf: fn(source(spark, sf))


QUERIES: dict[str, Query] = {
    # 2.1 scans, sources, sinks
    "scan_trips": q_scan_trips,
    "scan_projected": q_scan_projected,
    "write_cleaned": q_write_cleaned,
    "write_splits": q_write_splits,
    "rule_impact_on_write": q_rule_impact_on_write,
    "write_scored": q_write_scored,
    "model_round_trip": q_model_round_trip,
    # 2.2 projections and features
    "trip_duration": q_trip_duration,
    "calendar_features": q_calendar_features,
    "is_weekend": q_is_weekend,
    "is_long_haul": q_is_long_haul,
    "cast_codes": q_cast_codes,
    "model_frame": q_model_frame,
    "column_profile": q_column_profile,
    "time_labels": q_time_labels,
    "code_labels": q_code_labels,
    "distance_group": q_distance_group,
    "error_distance_bucket": q_error_distance_bucket,
    "time_band": q_time_band,
    "pickup_hour_bounds": q_pickup_hour_bounds,
    # 2.3 filters and rules
    "clean_trips": q_clean_trips,
    "rule_impact": _q(R.rule_impact, trips),
    "removal_union": _q(R.removal_union, trips),
    "cleaning_reconcile": _q(R.cleaning_reconcile, trips),
    "rule_overlap": _q(R.rule_overlap, trips),
    "distance_cap": q_distance_cap,
    "documented_rules": _q(R.documented_rules, trips),
    "unusual_values": _q(R.unusual_values, trips),
    "unusual_values_found": _q(R.unusual_values_found, trips),
    "outlier_summary": _q(R.outlier_summary, trips),
    "validate_requests": q_validate_requests,
    # 2.4 aggregations
    "trips_by_year": _q(P.trips_by_year, trips),
    "datetime_range": _q(P.datetime_range, trips),
    "null_counts": _q(P.null_counts, trips),
    "null_total": _q(P.null_total, trips),
    "duration_profile": _q(P.duration_profile, trips),
    "distance_profile": _q(P.distance_profile, trips),
    "distinct_zones": _q(P.distinct_zones, trips),
    "value_counts": _q(P.value_counts, trips),
    "long_haul_distribution": _q(P.long_haul_distribution, cleaned),
    "duplicate_count": lambda spark, sf: P.duplicate_count(TR.dup_trips(spark, sf)),
    "duplicate_groups": lambda spark, sf: P.duplicate_groups(TR.dup_trips(spark, sf)),
    "duplicate_count_wide": lambda spark, sf: P.duplicate_count_wide(trips(spark, sf)),
    "duplicate_count_wide_by_year": lambda spark, sf: P.duplicate_count_wide(TR.dup_trips(spark, sf), by=["ship_year"]),
    "duplicate_reconcile": lambda spark, sf: P.duplicate_reconcile(
        SP.temporal_split(TR.dup_trips(spark, sf), (1995, 1), (1997, 1), None, None,
                          year="ship_year", month="ship_month")),
    "dedup_rows": lambda spark, sf: P.dedup_rows(TR.dup_trips(spark, sf)),
    "duration_by_hour": _q(P.duration_by_hour, trips),
    "duration_by_hour_events": q_duration_by_hour_events,
    "duration_by_dow": _q(P.duration_by_dow, trips),
    "duration_by_month": _q(P.duration_by_month, trips),
    "month_extremes": _q(P.month_extremes, trips),
    "distance_duration_corr": _q(P.distance_duration_corr, trips),
    "duration_by_distance_group": _q(P.duration_by_distance_group, trips),
    "zone_duration": lambda spark, sf: P.zone_duration(trips(spark, sf), ZONE_MIN_TRIPS),
    "duration_by_passengers": _q(P.duration_by_passengers, trips),
    "duration_by_vendor": _q(P.duration_by_vendor, trips),
    "duration_histogram": _q(P.duration_histogram, trips),
    "monthly_stats": _q(P.monthly_stats, cleaned),
    "period_consistency": _q(P.period_consistency, cleaned),
    # 2.5 top-k and sampling
    "busiest_hours": _q(K.busiest_hours, trips),
    "zone_extremes": lambda spark, sf: K.zone_extremes(trips(spark, sf), 10, ZONE_MIN_TRIPS),
    "busiest_quietest_month": _q(K.busiest_quietest_month, cleaned),
    "sample_rows": _q(K.sample_rows, trips),
    # 2.6 outlier drill-down
    "outlier_profile": _q(O.outlier_profile, trips),
    "outlier_passengers": _q(O.outlier_passengers, trips),
    "outlier_top_zones": _q(O.outlier_top_zones, trips),
    "outlier_years": _q(O.outlier_years, trips),
    "outlier_vendors": _q(O.outlier_vendors, trips),
    "outlier_samples": _q(O.outlier_samples, trips),
    # 2.7 temporal splits
    "temporal_split": split_frame,
    "split_report": _q(SP.split_report, split_frame),
    "split_integrity": q_split_integrity,
    "split_candidates": q_split_candidates,
    # 2.8 modelling and evaluation
    "fit_ols": lambda spark, sf: M.regression_metrics(ols_scored(spark, sf, "validation")),
    "ols_coefficients": lambda spark, sf: M.ols_coefficients(ols_model(spark, sf)),
    "fit_boosted_12": q_fit_boosted(S.BOOSTED_CATEGORICAL_12),
    "fit_boosted_11": q_fit_boosted_11,
    "boosted_score": q_boosted_score,
    "boosted_comparison": q_boosted_comparison,
    "model_comparison": lambda spark, sf: M.compare_parts(
        M.regression_metrics(ols_scored(spark, sf, "validation")), M.regression_metrics(ols_scored(spark, sf, "test"))),
    "feature_cardinality": lambda spark, sf: M.feature_cardinality(part(spark, sf, "train")),
    "target_stats": lambda spark, sf: M.target_stats(part(spark, sf, "validation")),
    "regression_metrics": lambda spark, sf: M.regression_metrics(ols_scored(spark, sf, "test")),
    "metric_comparison": lambda spark, sf: M.metric_comparison(
        M.regression_metrics(ols_scored(spark, sf, "validation")),
        S.REFERENCE_METRICS["least_squares_validation"]),
    "temporal_search": lambda spark, sf: M.temporal_search(part(spark, sf, "train"), least=24, step=3),
    "target_encoding": q_target_encoding,
    "interval_coverage": q_interval_coverage,
    "batch_score": q_batch_score,
    "overall_mae": lambda spark, sf: M.overall_mae(ols_scored(spark, sf, "test")),
    "mae_by_distance": lambda spark, sf: M.mae_by_distance(ols_scored(spark, sf, "test")),
    "mae_by_hour": lambda spark, sf: M.mae_by_hour(ols_scored(spark, sf, "test")),
    # streaming: the row-local operators on a file stream of lineitem
    "stream_clean_trips": q_stream_clean_trips,
    "stream_validate_requests": q_stream_validate_requests,
    "stream_batch_score": q_stream_batch_score,
}


def queries() -> dict[str, Query]:
    def wrap(fn):
        return lambda spark, sf: rounded(fn(spark, sf))
    return {name: wrap(fn) for name, fn in QUERIES.items()}
