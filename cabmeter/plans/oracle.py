"""DuckDB oracle SQL for the registered queries.

Each statement recomputes the query from the raw driver tables (views
``lineitem``, ``events`` ...).  DOUBLE outputs are rounded to 6 decimals,
like the Spark side.  Queries without an entry here (model training with
trees, sinks whose output is a file) get the driver's rows-only check.
"""

from __future__ import annotations

from .registry import (FIRST_YEAR, SECOND_YEAR, TRAIN_END, VALIDATION_END,
                       ZONE_MIN_TRIPS)

# ---------------------------------------------------------------------------
# Common table expressions.
# ---------------------------------------------------------------------------
TRIPS = """
_li AS (
  SELECT *, CAST((l_orderkey * 7 + l_linenumber) % 24 AS INTEGER) AS _h,
         (l_extendedprice / 1000.0::DOUBLE) * (l_extendedprice / 1000.0::DOUBLE) / 200.0::DOUBLE AS _d
  FROM lineitem),
_t0 AS (
  SELECT CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS INTEGER) AS VendorID,
         CAST(l_shipdate AS TIMESTAMP) + to_hours(_h) + to_minutes(CAST(l_partkey % 60 AS INTEGER)) AS tpep_pickup_datetime,
         CASE WHEN l_partkey % 97 = 0 THEN 150.0::DOUBLE + l_tax * 100.0::DOUBLE
              WHEN l_partkey % 89 = 0 THEN l_tax * 25.0::DOUBLE
              ELSE 2.5::DOUBLE + 2.2::DOUBLE * _d
                   + (CASE WHEN _h >= 8 AND _h <= 18 THEN 4.0::DOUBLE ELSE 0.0::DOUBLE END)
                   + l_tax * 100.0::DOUBLE END AS trip_duration_minutes,
         CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS passenger_count,
         _d AS trip_distance,
         CAST(CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 2 ELSE 99 END AS INTEGER) AS RatecodeID,
         CAST(l_suppkey % 265 + 1 AS INTEGER) AS PULocationID,
         CAST(l_partkey % 265 + 1 AS INTEGER) AS DOLocationID
  FROM _li),
trips AS (
  SELECT VendorID, tpep_pickup_datetime,
         tpep_pickup_datetime + to_seconds(CAST(floor(trip_duration_minutes * 60) AS BIGINT)) AS tpep_dropoff_datetime,
         passenger_count, trip_distance, RatecodeID, PULocationID, DOLocationID, trip_duration_minutes
  FROM _t0)"""

KEEP = """trip_duration_minutes >= 1 AND trip_distance >= 0.1
      AND NOT (trip_duration_minutes > 120 AND trip_distance < 2) AND passenger_count <= 6"""

REMOVE = """trip_duration_minutes < 1 OR trip_distance < 0.1
      OR (trip_duration_minutes > 120 AND trip_distance < 2) OR passenger_count > 6"""


def _model_frame(src: str) -> str:
    p = "tpep_pickup_datetime"
    return f"""SELECT trip_duration_minutes,
         CAST(year({p}) AS INTEGER) AS pickup_year,
         CAST(month({p}) AS INTEGER) AS pickup_month,
         CAST(day({p}) AS INTEGER) AS pickup_day,
         CAST(dayofweek({p}) AS INTEGER) AS pickup_day_of_week,
         CAST(hour({p}) AS INTEGER) AS pickup_hour,
         CAST(CASE WHEN dayofweek({p}) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
         trip_distance,
         CAST(CASE WHEN trip_distance > 50 THEN 1 ELSE 0 END AS INTEGER) AS is_long_haul,
         CAST(passenger_count AS INTEGER) AS passenger_count,
         CAST(RatecodeID AS INTEGER) AS RatecodeID,
         CAST(VendorID AS INTEGER) AS VendorID,
         CAST(PULocationID AS INTEGER) AS PULocationID,
         CAST(DOLocationID AS INTEGER) AS DOLocationID
  FROM {src}"""


def _ym(t):
    return t[0] * 100 + t[1]


CLEANED = TRIPS + f""",
cleaned AS (
  {_model_frame("trips WHERE " + KEEP)}),
splitted AS (
  SELECT *, CASE WHEN pickup_year * 100 + pickup_month < {_ym(TRAIN_END)} THEN 'train'
                 WHEN pickup_year * 100 + pickup_month < {_ym(VALIDATION_END)} THEN 'validation'
                 ELSE 'test' END AS split
  FROM cleaned)"""

DUP = """
dup AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, CAST(month(l_shipdate) AS INTEGER) AS ship_month,
         l_linenumber, l_returnflag, l_linestatus, l_suppkey % 25 AS supp_mod, l_quantity
  FROM lineitem)"""


def pct(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) * 100.0 / NULLIF(CAST({b} AS DOUBLE), 0))"


def q(ctes: str, body: str, doubles: list[str] | None = None) -> str:
    inner = f"WITH {ctes}\n{body}"
    if not doubles:
        return inner
    repl = ", ".join(f"(sign({c}) * floor(abs({c}) * 1000000.0::DOUBLE + 0.5::DOUBLE)"
                     f" / 1000000.0::DOUBLE) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{inner}\n) AS _q"


def _pc(col: str, p: float) -> str:
    return f"PERCENTILE_CONT({p}) WITHIN GROUP (ORDER BY {col})"


RAW_COLS = ("VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, "
            "trip_distance, RatecodeID, PULocationID, DOLocationID, trip_duration_minutes")
RAW_DOUBLES = ["passenger_count", "trip_distance", "trip_duration_minutes"]
CLEAN_DOUBLES = ["trip_duration_minutes", "trip_distance"]
CLEANED_COLS = ("trip_duration_minutes, pickup_year, pickup_month, pickup_day, pickup_day_of_week, "
                "pickup_hour, is_weekend, trip_distance, is_long_haul, passenger_count, RatecodeID, "
                "VendorID, PULocationID, DOLocationID")

# ---------------------------------------------------------------------------
# Outlier groups (tag + explode) shared by §2.6.
# ---------------------------------------------------------------------------
OUTLIER_GROUPS_SQL = """
groups(group_id, label) AS (VALUES (1, 'Duration < 1 min'), (2, 'Duration 1-2 min'),
  (3, 'Duration > 120 min'), (4, 'Distance < 0.1 mi'), (5, 'Distance > 50 mi'),
  (6, 'Passenger count > 6')),
tagged AS (
  SELECT t.*, g.group_id FROM trips t JOIN groups g ON
    (g.group_id = 1 AND t.trip_duration_minutes < 1) OR
    (g.group_id = 2 AND t.trip_duration_minutes >= 1 AND t.trip_duration_minutes < 2) OR
    (g.group_id = 3 AND t.trip_duration_minutes > 120) OR
    (g.group_id = 4 AND t.trip_distance < 0.1) OR
    (g.group_id = 5 AND t.trip_distance > 50) OR
    (g.group_id = 6 AND t.passenger_count > 6))"""


def _dist(key_expr: str, name: str) -> str:
    return q(TRIPS + "," + OUTLIER_GROUPS_SQL, f"""
SELECT group_id, {key_expr} AS {name}, COUNT(*) AS cnt,
       {pct('COUNT(*)', 'SUM(COUNT(*)) OVER (PARTITION BY group_id)')} AS pct
FROM tagged GROUP BY group_id, {key_expr}""", ["pct"])


# ---------------------------------------------------------------------------
# Least squares by sequential orthogonalisation (Gram-Schmidt) in SQL.
# ---------------------------------------------------------------------------
OLS_FEATURES = ["trip_distance", "passenger_count", "pickup_hour", "pickup_day_of_week",
                "pickup_month"]


def ols_ctes(src: str = "train_rows") -> str:
    f = OLS_FEATURES
    k = len(f)
    parts = []
    cent = ", ".join(f"CAST({x} AS DOUBLE) - AVG(CAST({x} AS DOUBLE)) OVER () AS c{i}"
                     for i, x in enumerate(f))
    parts.append(f"g0 AS (SELECT *, trip_duration_minutes - AVG(trip_duration_minutes) OVER () AS cy, "
                 f"{cent} FROM {src})")
    prev = "g0"
    for i in range(k):
        if i == 0:
            parts.append(f"e0 AS (SELECT *, c0 AS e_0 FROM {prev})")
            prev = "e0"
            continue
        rs = ", ".join(f"SUM(c{i} * e_{j}) OVER () / SUM(e_{j} * e_{j}) OVER () AS r_{j}_{i}"
                       for j in range(i))
        parts.append(f"r{i} AS (SELECT *, {rs} FROM {prev})")
        proj = " - ".join([f"c{i}"] + [f"r_{j}_{i} * e_{j}" for j in range(i)])
        parts.append(f"e{i} AS (SELECT *, {proj} AS e_{i} FROM r{i})")
        prev = f"e{i}"
    gam = ", ".join(f"SUM(cy * e_{i}) OVER () / SUM(e_{i} * e_{i}) OVER () AS gam_{i}"
                    for i in range(k))
    parts.append(f"gm AS (SELECT *, {gam} FROM {prev})")
    rcols = ", ".join(f"ANY_VALUE(r_{j}_{i}) AS r_{j}_{i}" for i in range(k) for j in range(i))
    gcols = ", ".join(f"ANY_VALUE(gam_{i}) AS gam_{i}" for i in range(k))
    means = ", ".join(f"AVG(CAST({x} AS DOUBLE)) AS m_{i}" for i, x in enumerate(f))
    parts.append(f"one AS (SELECT {rcols}, {gcols}, {means}, AVG(trip_duration_minutes) AS m_y FROM gm)")
    # back substitution: b_i = gam_i - sum_{j>i} r_i_j * b_j
    prev = "one"
    for i in reversed(range(k)):
        expr = " - ".join([f"gam_{i}"] + [f"r_{i}_{j} * b_{j}" for j in range(i + 1, k)])
        parts.append(f"b{i} AS (SELECT *, {expr} AS b_{i} FROM {prev})")
        prev = f"b{i}"
    icpt = " - ".join(["m_y"] + [f"b_{i} * m_{i}" for i in range(k)])
    parts.append(f"coef AS (SELECT *, {icpt} AS b_icpt FROM {prev})")
    return ",\n".join(parts)


def ols_prediction(alias: str = "s") -> str:
    terms = " + ".join(f"CAST({alias}.{x} AS DOUBLE) * coef.b_{i}" for i, x in enumerate(OLS_FEATURES))
    return f"(({terms}) + coef.b_icpt)"


def ols_base(scored_part: str) -> str:
    return CLEANED + f""",
train_rows AS (SELECT * FROM splitted WHERE split = 'train'),
{ols_ctes()},
scored AS (
  SELECT s.*, {ols_prediction('s')} AS prediction
  FROM splitted s, coef WHERE s.split = '{scored_part}')"""


METRICS_BODY = """
SELECT COUNT(*) AS n, AVG(ABS(trip_duration_minutes - prediction)) AS MAE,
       SQRT(AVG((trip_duration_minutes - prediction) * (trip_duration_minutes - prediction))) AS RMSE,
       CASE WHEN COUNT(*) = 0 THEN NULL
            WHEN COUNT(*) * VAR_POP(trip_duration_minutes) = 0 THEN
                 CASE WHEN SUM((trip_duration_minutes - prediction) * (trip_duration_minutes - prediction)) = 0
                      THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
            ELSE 1.0 - SUM((trip_duration_minutes - prediction) * (trip_duration_minutes - prediction))
                 / (COUNT(*) * VAR_POP(trip_duration_minutes)) END AS R2
FROM scored"""

ERROR_BUCKETS = """
buckets(bucket_id, bucket) AS (VALUES (0, '0–1'), (1, '1–2'), (2, '2–3'), (3, '3–5'),
  (4, '5–8'), (5, '8–12'), (6, '12–20'), (7, '20–50'), (8, '50+'))"""

BUCKET_EXPR = """CASE WHEN trip_distance < 1.0 THEN 0 WHEN trip_distance < 2.0 THEN 1
  WHEN trip_distance < 3.0 THEN 2 WHEN trip_distance < 5.0 THEN 3 WHEN trip_distance < 8.0 THEN 4
  WHEN trip_distance < 12.0 THEN 5 WHEN trip_distance < 20.0 THEN 6 WHEN trip_distance < 50.0 THEN 7
  ELSE 8 END"""

BAND_EXPR = """CASE WHEN {h} >= 0 AND {h} <= 5 THEN 'Night (0–5)'
  WHEN {h} >= 6 AND {h} <= 9 THEN 'Morning rush (6–9)'
  WHEN {h} >= 10 AND {h} <= 15 THEN 'Midday (10–15)'
  WHEN {h} >= 16 AND {h} <= 19 THEN 'Evening rush (16–19)'
  WHEN {h} >= 20 AND {h} <= 23 THEN 'Evening (20–23)' END"""

DIST_GROUP = """CASE WHEN trip_distance < 1 THEN '< 1 mi' WHEN trip_distance < 2 THEN '1-2 mi'
  WHEN trip_distance < 3 THEN '2-3 mi' WHEN trip_distance < 5 THEN '3-5 mi'
  WHEN trip_distance < 10 THEN '5-10 mi' WHEN trip_distance < 20 THEN '10-20 mi' ELSE '20+ mi' END"""

REQUESTS = """
requests AS (
  SELECT trip_distance, CAST(passenger_count AS INTEGER) AS passenger_count,
         CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
         CAST((dayofweek(tpep_pickup_datetime) + 6) % 7 AS INTEGER) AS pickup_day_of_week,
         CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
         PULocationID, DOLocationID, COALESCE(RatecodeID, 1) AS RatecodeID,
         COALESCE(VendorID, 1) AS VendorID
  FROM trips),
validated AS (
  SELECT *, concat_ws('; ',
      CASE WHEN trip_distance IS NULL OR trip_distance < 0 THEN 'trip_distance must be >= 0' END,
      CASE WHEN passenger_count IS NULL OR NOT (passenger_count BETWEEN 1 AND 6) THEN 'passenger_count must be 1-6' END,
      CASE WHEN pickup_hour IS NULL OR NOT (pickup_hour BETWEEN 0 AND 23) THEN 'pickup_hour must be 0-23' END,
      CASE WHEN pickup_day_of_week IS NULL OR NOT (pickup_day_of_week BETWEEN 0 AND 6) THEN 'pickup_day_of_week must be 0-6' END,
      CASE WHEN pickup_month IS NULL OR NOT (pickup_month BETWEEN 1 AND 12) THEN 'pickup_month must be 1-12' END,
      CASE WHEN PULocationID IS NULL OR NOT (PULocationID BETWEEN 1 AND 265) THEN 'PULocationID must be 1-265' END,
      CASE WHEN DOLocationID IS NULL OR NOT (DOLocationID BETWEEN 1 AND 265) THEN 'DOLocationID must be 1-265' END,
      CASE WHEN RatecodeID IS NULL OR RatecodeID NOT IN (1, 2, 3, 4, 5, 6, 99) THEN 'RatecodeID must be one of 1, 2, 3, 4, 5, 6, 99' END,
      CASE WHEN VendorID IS NULL OR VendorID NOT IN (1, 2) THEN 'VendorID must be 1 or 2' END
    ) AS violation_text
  FROM requests)"""


def _profile(col: str) -> str:
    return q(TRIPS, f"""
SELECT COUNT({col}) AS n, MIN({col}) AS min, {_pc(col, 0.01)} AS p01, {_pc(col, 0.25)} AS p25,
       {_pc(col, 0.5)} AS median, {_pc(col, 0.75)} AS p75, {_pc(col, 0.95)} AS p95,
       {_pc(col, 0.99)} AS p99, AVG({col}) AS mean, MAX({col}) AS max
FROM trips""", ["min", "p01", "p25", "median", "p75", "p95", "p99", "mean", "max"])


def _mean_by(key: str, name: str, src: str = "trips", value: str = "trip_duration_minutes",
             ctes: str = TRIPS) -> str:
    return q(ctes, f"""
SELECT {key} AS {name}, AVG({value}) AS avg_dur, COUNT(*) AS trips
FROM {src} GROUP BY {key}""", ["avg_dur"])


P = "tpep_pickup_datetime"

ORACLE: dict[str, str] = {
    # 2.1
    "scan_trips": q(TRIPS, f"SELECT {RAW_COLS} FROM trips", RAW_DOUBLES),
    "scan_projected": q(CLEANED, """
SELECT CAST(trip_distance AS FLOAT) AS trip_distance, CAST(passenger_count AS FLOAT) AS passenger_count,
       CAST(pickup_hour AS FLOAT) AS pickup_hour, CAST(is_weekend AS FLOAT) AS is_weekend,
       CAST(is_long_haul AS FLOAT) AS is_long_haul, CAST(PULocationID AS FLOAT) AS PULocationID,
       CAST(DOLocationID AS FLOAT) AS DOLocationID, pickup_day_of_week, pickup_month, RatecodeID,
       VendorID, CAST(trip_duration_minutes AS FLOAT) AS trip_duration_minutes
FROM cleaned"""),
    "write_cleaned": q(CLEANED, f"SELECT {CLEANED_COLS} FROM cleaned", CLEAN_DOUBLES),
    "write_splits": q(CLEANED, "SELECT split, COUNT(*) AS rows FROM splitted GROUP BY split"),
    # 2.2
    "trip_duration": q(TRIPS, f"""
SELECT {P}, tpep_dropoff_datetime,
       date_diff('second', {P}, tpep_dropoff_datetime) / 60.0::DOUBLE AS duration_from_timestamps
FROM trips""", ["duration_from_timestamps"]),
    "calendar_features": q(TRIPS, f"""
SELECT {P}, CAST(year({P}) AS INTEGER) AS pickup_year, CAST(month({P}) AS INTEGER) AS pickup_month,
       CAST(day({P}) AS INTEGER) AS pickup_day, CAST(dayofweek({P}) AS INTEGER) AS pickup_day_of_week,
       CAST(hour({P}) AS INTEGER) AS pickup_hour
FROM trips"""),
    "is_weekend": q(TRIPS, f"""
SELECT {P}, CAST(dayofweek({P}) AS INTEGER) AS pickup_day_of_week,
       CAST(CASE WHEN dayofweek({P}) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend
FROM trips"""),
    "is_long_haul": q(TRIPS, """
SELECT trip_distance, CAST(CASE WHEN trip_distance > 50 THEN 1 ELSE 0 END AS INTEGER) AS is_long_haul
FROM trips""", ["trip_distance"]),
    "cast_codes": q(TRIPS, """
SELECT CAST(passenger_count AS INTEGER) AS passenger_count, RatecodeID, VendorID, PULocationID,
       DOLocationID FROM trips"""),
    "model_frame": q(CLEANED, f"SELECT {CLEANED_COLS} FROM cleaned", CLEAN_DOUBLES),
    "column_profile": q(CLEANED, """
SELECT * FROM (VALUES
  (1, 'trip_duration_minutes', 'DOUBLE', 'TARGET'), (2, 'pickup_year', 'INTEGER', 'feature (time)'),
  (3, 'pickup_month', 'INTEGER', 'feature (time)'), (4, 'pickup_day', 'INTEGER', 'feature (time)'),
  (5, 'pickup_day_of_week', 'INTEGER', 'feature (time)'), (6, 'pickup_hour', 'INTEGER', 'feature (time)'),
  (7, 'is_weekend', 'INTEGER', 'feature (time)'), (8, 'trip_distance', 'DOUBLE', 'feature'),
  (9, 'is_long_haul', 'INTEGER', 'feature (flag)'), (10, 'passenger_count', 'INTEGER', 'feature'),
  (11, 'RatecodeID', 'INTEGER', 'feature'), (12, 'VendorID', 'INTEGER', 'feature'),
  (13, 'PULocationID', 'INTEGER', 'feature'), (14, 'DOLocationID', 'INTEGER', 'feature')
) AS l(position, column_name, column_type, role)
JOIN (UNPIVOT (SELECT
    COUNT(*) FILTER (WHERE trip_duration_minutes IS NULL) AS "1",
    COUNT(*) FILTER (WHERE pickup_year IS NULL) AS "2",
    COUNT(*) FILTER (WHERE pickup_month IS NULL) AS "3",
    COUNT(*) FILTER (WHERE pickup_day IS NULL) AS "4",
    COUNT(*) FILTER (WHERE pickup_day_of_week IS NULL) AS "5",
    COUNT(*) FILTER (WHERE pickup_hour IS NULL) AS "6",
    COUNT(*) FILTER (WHERE is_weekend IS NULL) AS "7",
    COUNT(*) FILTER (WHERE trip_distance IS NULL) AS "8",
    COUNT(*) FILTER (WHERE is_long_haul IS NULL) AS "9",
    COUNT(*) FILTER (WHERE passenger_count IS NULL) AS "10",
    COUNT(*) FILTER (WHERE RatecodeID IS NULL) AS "11",
    COUNT(*) FILTER (WHERE VendorID IS NULL) AS "12",
    COUNT(*) FILTER (WHERE PULocationID IS NULL) AS "13",
    COUNT(*) FILTER (WHERE DOLocationID IS NULL) AS "14"
  FROM cleaned) ON COLUMNS(*) INTO NAME pos VALUE null_count) AS n
ON CAST(n.pos AS INTEGER) = l.position""").replace(
        "SELECT * FROM (VALUES",
        "SELECT l.position, l.column_name, l.column_type, n.null_count, l.role, "
        "n.null_count > 0 AS has_nulls FROM (VALUES"),
    "time_labels": q(CLEANED, """
SELECT pickup_year, pickup_month, pickup_day_of_week,
       printf('%d-%02d', pickup_year, pickup_month) AS period,
       (['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'])[pickup_month] AS month_name,
       (['Sun','Mon','Tue','Wed','Thu','Fri','Sat'])[pickup_day_of_week + 1] AS weekday_name
FROM cleaned"""),
    "code_labels": q(TRIPS, """
SELECT t.RatecodeID, t.VendorID, r.label AS ratecode_label, v.label AS vendor_label
FROM trips t
LEFT JOIN (VALUES (1, '1 - Standard Rate'), (2, '2 - JFK Airport'), (3, '3 - Newark Airport'),
  (4, '4 - Nassau / Westchester'), (5, '5 - Negotiated Fare'), (6, '6 - Group Ride'),
  (99, '99 - Unknown')) AS r(code, label) ON t.RatecodeID = r.code
LEFT JOIN (VALUES (1, '1 - Creative Mobile Technologies'), (2, '2 - VeriFone Inc.')) AS v(code, label)
  ON t.VendorID = v.code"""),
    "distance_group": q(TRIPS, f"SELECT trip_distance, {DIST_GROUP} AS dist_group FROM trips",
                        ["trip_distance"]),
    "error_distance_bucket": q(TRIPS + "," + ERROR_BUCKETS, f"""
SELECT trip_distance, CAST({BUCKET_EXPR} AS INTEGER) AS distance_bucket_id, b.bucket AS distance_bucket
FROM trips JOIN buckets b ON b.bucket_id = {BUCKET_EXPR}""", ["trip_distance"]),
    "time_band": q(CLEANED, f"SELECT pickup_hour, {BAND_EXPR.format(h='pickup_hour')} AS time_band FROM cleaned"),
    "pickup_hour_bounds": q(CLEANED, """
SELECT pickup_year, pickup_month, pickup_day, pickup_hour,
       make_timestamp(pickup_year, pickup_month, pickup_day, pickup_hour, 0, 0) AS hour_start,
       make_timestamp(pickup_year, pickup_month, pickup_day, pickup_hour, 59, 59) AS hour_end
FROM cleaned"""),
    # 2.3
    "clean_trips": q(TRIPS, f"SELECT {RAW_COLS} FROM trips WHERE {KEEP}", RAW_DOUBLES),
    "rule_impact": q(TRIPS, f"""
SELECT rule_id, rule, action, rows_matched, {pct('rows_matched', 'total')} AS pct FROM (
  SELECT 1 AS rule_id, 'duration < 1 min' AS rule, 'remove' AS action,
         COUNT(*) FILTER (WHERE trip_duration_minutes < 1) AS rows_matched, COUNT(*) AS total FROM trips
  UNION ALL SELECT 2, 'distance < 0.1 mi', 'remove', COUNT(*) FILTER (WHERE trip_distance < 0.1), COUNT(*) FROM trips
  UNION ALL SELECT 3, 'duration > 120 min AND distance < 2 mi', 'remove',
         COUNT(*) FILTER (WHERE trip_duration_minutes > 120 AND trip_distance < 2), COUNT(*) FROM trips
  UNION ALL SELECT 4, 'distance > 50 mi', 'keep', COUNT(*) FILTER (WHERE trip_distance > 50), COUNT(*) FROM trips
  UNION ALL SELECT 5, 'duration 1-2 min with distance >= 0.1 mi', 'keep',
         COUNT(*) FILTER (WHERE trip_duration_minutes >= 1 AND trip_duration_minutes < 2 AND trip_distance >= 0.1),
         COUNT(*) FROM trips
  UNION ALL SELECT 6, 'passenger_count > 6', 'remove', COUNT(*) FILTER (WHERE passenger_count > 6), COUNT(*) FROM trips
)""", ["pct"]),
    "removal_union": q(TRIPS, f"""
SELECT original_rows, removed_rows, original_rows - removed_rows AS final_rows,
       {pct('removed_rows', 'original_rows')} AS removed_pct,
       {pct('original_rows - removed_rows', 'original_rows')} AS retained_pct
FROM (SELECT COUNT(*) AS original_rows, COUNT(*) FILTER (WHERE {REMOVE}) AS removed_rows FROM trips)""",
                       ["removed_pct", "retained_pct"]),
    "cleaning_reconcile": q(TRIPS, f"""
SELECT original_rows, removed_rows, original_rows - removed_rows AS predicted_kept, kept_rows,
       original_rows - removed_rows - kept_rows AS null_gap
FROM (SELECT COUNT(*) AS original_rows, COUNT(*) FILTER (WHERE {REMOVE}) AS removed_rows,
             COUNT(*) FILTER (WHERE {KEEP}) AS kept_rows FROM trips)"""),
    "documented_rules": q(TRIPS, f"""
SELECT {RAW_COLS} FROM trips
WHERE trip_duration_minutes > 0 AND trip_duration_minutes <= 180.0 AND trip_distance > 0
  AND NOT (RatecodeID = 1 AND trip_distance > 200.0) AND passenger_count BETWEEN 1 AND 6
  AND RatecodeID IN (1, 2, 3, 4, 5, 6, 99) AND VendorID IN (1, 2)""", RAW_DOUBLES),
    "unusual_values": q(TRIPS, f"""
SELECT check_id, label, rows_matched, {pct('rows_matched', 'total')} AS pct, rows_matched > 0 AS flagged
FROM (
  SELECT 1 AS check_id, 'Duration < 1 min (likely invalid)' AS label,
         COUNT(*) FILTER (WHERE trip_duration_minutes < 1) AS rows_matched, COUNT(*) AS total FROM trips
  UNION ALL SELECT 2, 'Duration > 120 min (very long)', COUNT(*) FILTER (WHERE trip_duration_minutes > 120), COUNT(*) FROM trips
  UNION ALL SELECT 3, 'Distance < 0.1 mi (near-zero)', COUNT(*) FILTER (WHERE trip_distance < 0.1), COUNT(*) FROM trips
  UNION ALL SELECT 4, 'Distance > 50 mi (very long haul)', COUNT(*) FILTER (WHERE trip_distance > 50), COUNT(*) FROM trips
  UNION ALL SELECT 5, 'Passenger count = 0', COUNT(*) FILTER (WHERE passenger_count = 0), COUNT(*) FROM trips
  UNION ALL SELECT 6, 'Passenger count > 6', COUNT(*) FILTER (WHERE passenger_count > 6), COUNT(*) FROM trips
  UNION ALL SELECT 7, 'Duration > 0 but Distance = 0',
         COUNT(*) FILTER (WHERE trip_duration_minutes > 1 AND trip_distance = 0), COUNT(*) FROM trips
)""", ["pct"]),
    "outlier_summary": q(TRIPS + "," + OUTLIER_GROUPS_SQL, f"""
SELECT g.group_id, g.label, COALESCE(c.cnt, 0) AS rows_matched,
       {pct('COALESCE(c.cnt, 0)', '(SELECT COUNT(*) FROM trips)')} AS pct,
       v.verdict
FROM groups g
LEFT JOIN (SELECT group_id, COUNT(*) AS cnt FROM tagged GROUP BY group_id) c ON c.group_id = g.group_id
JOIN (VALUES (1, 'A - Remove'), (2, 'C - Decide'), (3, 'B/A - Conditional'), (4, 'A - Remove'),
             (5, 'B - Keep+Flag'), (6, 'A - Remove')) AS v(group_id, verdict) ON v.group_id = g.group_id""",
                         ["pct"]),
    "validate_requests": q(TRIPS + "," + REQUESTS, """
SELECT trip_distance, passenger_count, pickup_hour, pickup_day_of_week, pickup_month, PULocationID,
       DOLocationID, RatecodeID, VendorID, violation_text = '' AS is_valid,
       CAST(CASE WHEN pickup_day_of_week IN (5, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
       CAST(CASE WHEN trip_distance > 50 THEN 1 ELSE 0 END AS INTEGER) AS is_long_haul,
       CAST((pickup_day_of_week + 1) % 7 AS INTEGER) AS dow_sunday0, violation_text
FROM validated""", ["trip_distance"]),
    # 2.4
    "trips_by_year": q(TRIPS, f"SELECT CAST(year({P}) AS INTEGER) AS year, COUNT(*) AS trips FROM trips GROUP BY 1"),
    "datetime_range": q(TRIPS, f"""
SELECT MIN({P}) AS min_pickup, MAX({P}) AS max_pickup, MIN(tpep_dropoff_datetime) AS min_dropoff,
       MAX(tpep_dropoff_datetime) AS max_dropoff FROM trips"""),
    "null_counts": q(TRIPS, f"""
SELECT position, column_name, null_count, {pct('null_count', 'total')} AS null_pct FROM (
  SELECT 1 AS position, 'VendorID' AS column_name, COUNT(*) FILTER (WHERE VendorID IS NULL) AS null_count, COUNT(*) AS total FROM trips
  UNION ALL SELECT 2, 'tpep_pickup_datetime', COUNT(*) FILTER (WHERE {P} IS NULL), COUNT(*) FROM trips
  UNION ALL SELECT 3, 'tpep_dropoff_datetime', COUNT(*) FILTER (WHERE tpep_dropoff_datetime IS NULL), COUNT(*) FROM trips
  UNION ALL SELECT 4, 'passenger_count', COUNT(*) FILTER (WHERE passenger_count IS NULL), COUNT(*) FROM trips
  UNION ALL SELECT 5, 'trip_distance', COUNT(*) FILTER (WHERE trip_distance IS NULL), COUNT(*) FROM trips
  UNION ALL SELECT 6, 'RatecodeID', COUNT(*) FILTER (WHERE RatecodeID IS NULL), COUNT(*) FROM trips
  UNION ALL SELECT 7, 'PULocationID', COUNT(*) FILTER (WHERE PULocationID IS NULL), COUNT(*) FROM trips
  UNION ALL SELECT 8, 'DOLocationID', COUNT(*) FILTER (WHERE DOLocationID IS NULL), COUNT(*) FROM trips
  UNION ALL SELECT 9, 'trip_duration_minutes', COUNT(*) FILTER (WHERE trip_duration_minutes IS NULL), COUNT(*) FROM trips
)""", ["null_pct"]),
    "null_total": q(TRIPS, f"""
SELECT COUNT(*) FILTER (WHERE VendorID IS NULL) + COUNT(*) FILTER (WHERE {P} IS NULL)
     + COUNT(*) FILTER (WHERE tpep_dropoff_datetime IS NULL) + COUNT(*) FILTER (WHERE passenger_count IS NULL)
     + COUNT(*) FILTER (WHERE trip_distance IS NULL) + COUNT(*) FILTER (WHERE RatecodeID IS NULL)
     + COUNT(*) FILTER (WHERE PULocationID IS NULL) + COUNT(*) FILTER (WHERE DOLocationID IS NULL)
     + COUNT(*) FILTER (WHERE trip_duration_minutes IS NULL) AS null_total
FROM trips"""),
    "duration_profile": _profile("trip_duration_minutes"),
    "distance_profile": _profile("trip_distance"),
    "distinct_zones": q(TRIPS, """
SELECT COUNT(DISTINCT PULocationID) AS pickup_zones, COUNT(DISTINCT DOLocationID) AS dropoff_zones FROM trips"""),
    "value_counts": q(TRIPS, f"""
SELECT VendorID AS value, COUNT(*) AS trips, {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct,
       COUNT(*) OVER () AS n_distinct
FROM trips GROUP BY VendorID""", ["pct"]),
    "long_haul_distribution": q(CLEANED, f"""
SELECT is_long_haul, CASE WHEN is_long_haul = 1 THEN 'long haul' ELSE 'standard' END AS label,
       COUNT(*) AS trips, {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct
FROM cleaned GROUP BY is_long_haul""", ["pct"]),
    "duplicate_count": q(DUP, f"""
SELECT CAST(COALESCE(SUM(CASE WHEN cnt > 1 THEN cnt - 1 END), 0) AS BIGINT) AS duplicate_rows,
       COUNT(*) FILTER (WHERE cnt > 1) AS duplicate_groups, CAST(SUM(cnt) AS BIGINT) AS total_rows,
       {pct('COALESCE(SUM(CASE WHEN cnt > 1 THEN cnt - 1 END), 0)', 'SUM(cnt)')} AS duplicate_pct
FROM (SELECT COUNT(*) AS cnt FROM dup GROUP BY ALL_COLUMNS)""".replace(
        "GROUP BY ALL_COLUMNS",
        "GROUP BY ship_year, ship_month, l_linenumber, l_returnflag, l_linestatus, supp_mod, l_quantity"),
        ["duplicate_pct"]),
    "duplicate_groups": q(DUP, """
SELECT ship_year, ship_month, l_linenumber, l_returnflag, l_linestatus, supp_mod, l_quantity, COUNT(*) AS cnt
FROM dup GROUP BY ship_year, ship_month, l_linenumber, l_returnflag, l_linestatus, supp_mod, l_quantity
HAVING COUNT(*) > 1
ORDER BY cnt DESC, ship_year NULLS FIRST, ship_month NULLS FIRST, l_linenumber NULLS FIRST,
         l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, supp_mod NULLS FIRST, l_quantity NULLS FIRST
LIMIT 5""", ["l_quantity"]),
    "duplicate_reconcile": q(DUP + """,
dsplit AS (SELECT *, CASE WHEN ship_year * 100 + ship_month < 199501 THEN 'train'
                          WHEN ship_year * 100 + ship_month < 199701 THEN 'validation'
                          ELSE 'test' END AS split FROM dup)""", """
SELECT s.source_duplicates, p.split_duplicates, s.source_duplicates = p.split_duplicates AS equal
FROM (SELECT CAST(COALESCE(SUM(CASE WHEN cnt > 1 THEN cnt - 1 END), 0) AS BIGINT) AS source_duplicates
      FROM (SELECT COUNT(*) AS cnt FROM dup GROUP BY ship_year, ship_month, l_linenumber, l_returnflag,
            l_linestatus, supp_mod, l_quantity)) s,
     (SELECT CAST(COALESCE(SUM(CASE WHEN cnt > 1 THEN cnt - 1 END), 0) AS BIGINT) AS split_duplicates
      FROM (SELECT COUNT(*) AS cnt FROM dsplit GROUP BY split, ship_year, ship_month, l_linenumber,
            l_returnflag, l_linestatus, supp_mod, l_quantity)) p"""),
    "dedup_rows": q(DUP, "SELECT DISTINCT * FROM dup", ["l_quantity"]),
    "duration_by_hour": _mean_by(f"CAST(hour({P}) AS INTEGER)", "hour"),
    "duration_by_hour_events": q("""
ev AS (SELECT CAST(ts AS TIMESTAMP) AS ts, value FROM events)""", """
SELECT CAST(hour(ts) AS INTEGER) AS hour, AVG(value) AS avg_dur, COUNT(*) AS trips FROM ev GROUP BY 1""",
        ["avg_dur"]),
    "duration_by_dow": q(TRIPS, f"""
SELECT dow, (['Sun','Mon','Tue','Wed','Thu','Fri','Sat'])[dow + 1] AS day, avg_dur, trips FROM (
  SELECT CAST(dayofweek({P}) AS INTEGER) AS dow, AVG(trip_duration_minutes) AS avg_dur, COUNT(*) AS trips
  FROM trips GROUP BY 1)""", ["avg_dur"]),
    "duration_by_month": q(TRIPS, f"""
SELECT year, month, printf('%d-%02d', year, month) AS period, avg_dur, trips FROM (
  SELECT CAST(year({P}) AS INTEGER) AS year, CAST(month({P}) AS INTEGER) AS month,
         AVG(trip_duration_minutes) AS avg_dur, COUNT(*) AS trips FROM trips GROUP BY 1, 2)""", ["avg_dur"]),
    "month_extremes": q(TRIPS, f"""
SELECT MIN(avg_dur) AS min_avg_dur, arg_min(period, (avg_dur, year, month)) AS min_period,
       MAX(avg_dur) AS max_avg_dur, arg_max(period, (avg_dur, -year, -month)) AS max_period
FROM (SELECT year, month, printf('%d-%02d', year, month) AS period, avg_dur FROM (
  SELECT CAST(year({P}) AS INTEGER) AS year, CAST(month({P}) AS INTEGER) AS month,
         AVG(trip_duration_minutes) AS avg_dur FROM trips GROUP BY 1, 2))""", ["min_avg_dur", "max_avg_dur"]),
    "distance_duration_corr": q(TRIPS, "SELECT CORR(trip_distance, trip_duration_minutes) AS pearson_r FROM trips",
                                ["pearson_r"]),
    "duration_by_distance_group": q(TRIPS, f"""
SELECT {DIST_GROUP} AS dist_group, AVG(trip_duration_minutes) AS avg_dur, COUNT(*) AS trips,
       MIN(trip_distance) AS min_distance
FROM trips GROUP BY 1""", ["avg_dur", "min_distance"]),
    "zone_duration": q(TRIPS, f"""
SELECT PULocationID AS zone, AVG(trip_duration_minutes) AS avg_dur, COUNT(*) AS trips
FROM trips GROUP BY PULocationID HAVING COUNT(*) >= {ZONE_MIN_TRIPS}""", ["avg_dur"]),
    "duration_by_passengers": q(TRIPS, """
SELECT CAST(passenger_count AS INTEGER) AS pax, AVG(trip_duration_minutes) AS avg_dur, COUNT(*) AS trips
FROM trips WHERE passenger_count BETWEEN 1 AND 6 GROUP BY 1""", ["avg_dur"]),
    "duration_by_vendor": q(TRIPS, f"""
SELECT VendorID, AVG(trip_duration_minutes) AS avg_dur, {_pc('trip_duration_minutes', 0.5)} AS median_dur,
       COUNT(*) AS trips FROM trips GROUP BY VendorID""", ["avg_dur", "median_dur"]),
    "duration_histogram": q(TRIPS, """
SELECT bucket, COUNT(*) AS trips, bucket <= 30 AS in_zoom FROM (
  SELECT CAST(FLOOR(trip_duration_minutes) AS INTEGER) AS bucket FROM trips
  WHERE trip_duration_minutes BETWEEN 0 AND 120) GROUP BY bucket"""),
    "monthly_stats": q(CLEANED, f"""
SELECT pickup_year AS yr, pickup_month AS mo, COUNT(*) AS trips, AVG(trip_duration_minutes) AS avg_dur,
       {_pc('trip_duration_minutes', 0.5)} AS med_dur, {_pc('trip_duration_minutes', 0.95)} AS p95_dur,
       AVG(trip_distance) AS avg_dist
FROM cleaned GROUP BY pickup_year, pickup_month""", ["avg_dur", "med_dur", "p95_dur", "avg_dist"]),
    "period_consistency": q(CLEANED, f"""
SELECT period, COUNT(*) AS trips, AVG(trip_duration_minutes) AS avg_dur,
       {_pc('trip_duration_minutes', 0.25)} AS p25, {_pc('trip_duration_minutes', 0.5)} AS p50,
       {_pc('trip_duration_minutes', 0.75)} AS p75, {_pc('trip_duration_minutes', 0.95)} AS p95,
       AVG(trip_distance) AS avg_dist
FROM (SELECT *, CAST(pickup_year AS VARCHAR) || ' ' || CASE WHEN pickup_month <= 6 THEN 'H1' ELSE 'H2' END
             AS period FROM cleaned) GROUP BY period""", ["avg_dur", "p25", "p50", "p75", "p95", "avg_dist"]),
    # 2.5
    "busiest_hours": q(TRIPS, f"""
SELECT CAST(hour({P}) AS INTEGER) AS hour, AVG(trip_duration_minutes) AS avg_dur, COUNT(*) AS trips
FROM trips GROUP BY 1 ORDER BY trips DESC, hour LIMIT 5""", ["avg_dur"]),
    "zone_extremes": q(TRIPS + f""",
z AS (SELECT PULocationID AS zone, AVG(trip_duration_minutes) AS avg_dur, COUNT(*) AS trips
      FROM trips GROUP BY PULocationID HAVING COUNT(*) >= {ZONE_MIN_TRIPS})""", """
SELECT * FROM (SELECT 'longest' AS side, zone, avg_dur, trips FROM z ORDER BY avg_dur DESC, zone LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'shortest' AS side, zone, avg_dur, trips FROM z ORDER BY avg_dur ASC, zone LIMIT 10)""",
                       ["avg_dur"]),
    "busiest_quietest_month": q(CLEANED, """
SELECT arg_max(period, (trips, -pickup_year, -pickup_month)) AS busiest_period, MAX(trips) AS busiest_trips,
       arg_min(period, (trips, pickup_year, pickup_month)) AS quietest_period, MIN(trips) AS quietest_trips,
       MIN(avg_dur) AS min_avg_dur, MAX(avg_dur) AS max_avg_dur
FROM (SELECT pickup_year, pickup_month, printf('%d-%02d', pickup_year, pickup_month) AS period,
             COUNT(*) AS trips, AVG(trip_duration_minutes) AS avg_dur FROM cleaned GROUP BY 1, 2)""",
                                ["min_avg_dur", "max_avg_dur"]),
    "sample_rows": q(TRIPS, f"""
SELECT {RAW_COLS} FROM trips
ORDER BY md5('42|' || concat_ws('|', COALESCE(CAST({P} AS VARCHAR), ''),
             COALESCE(CAST(tpep_dropoff_datetime AS VARCHAR), ''), COALESCE(CAST(PULocationID AS VARCHAR), ''),
             COALESCE(CAST(DOLocationID AS VARCHAR), ''), COALESCE(CAST(VendorID AS VARCHAR), ''))),
         VendorID NULLS FIRST, {P} NULLS FIRST, tpep_dropoff_datetime NULLS FIRST, passenger_count NULLS FIRST,
         trip_distance NULLS FIRST, RatecodeID NULLS FIRST, PULocationID NULLS FIRST,
         DOLocationID NULLS FIRST, trip_duration_minutes NULLS FIRST
LIMIT 10""", RAW_DOUBLES),
    # 2.6
    "outlier_profile": q(TRIPS + "," + OUTLIER_GROUPS_SQL, f"""
SELECT g.group_id, g.label, COALESCE(s.trips, 0) AS trips,
       {pct('COALESCE(s.trips, 0)', '(SELECT COUNT(*) FROM trips)')} AS pct,
       s.dur_min, s.dur_median, s.dur_mean, s.dur_max, s.dist_min, s.dist_median, s.dist_mean, s.dist_max
FROM groups g LEFT JOIN (
  SELECT group_id, COUNT(*) AS trips, MIN(trip_duration_minutes) AS dur_min,
         {_pc('trip_duration_minutes', 0.5)} AS dur_median, AVG(trip_duration_minutes) AS dur_mean,
         MAX(trip_duration_minutes) AS dur_max, MIN(trip_distance) AS dist_min,
         {_pc('trip_distance', 0.5)} AS dist_median, AVG(trip_distance) AS dist_mean,
         MAX(trip_distance) AS dist_max
  FROM tagged GROUP BY group_id) s ON s.group_id = g.group_id""",
                         ["pct", "dur_min", "dur_median", "dur_mean", "dur_max", "dist_min", "dist_median",
                          "dist_mean", "dist_max"]),
    "outlier_passengers": _dist("CAST(passenger_count AS INTEGER)", "pax"),
    "outlier_years": _dist(f"CAST(year({P}) AS INTEGER)", "year"),
    "outlier_vendors": _dist("VendorID", "VendorID"),
    "outlier_top_zones": q(TRIPS + "," + OUTLIER_GROUPS_SQL + """,
sides AS (
  SELECT group_id, 'pickup' AS side, PULocationID AS zone FROM tagged
  UNION ALL SELECT group_id, 'dropoff', DOLocationID FROM tagged),
counts AS (SELECT group_id, side, zone, COUNT(*) AS cnt FROM sides GROUP BY ALL)""", f"""
SELECT * FROM (
  SELECT group_id, side, zone, cnt,
         CAST(ROW_NUMBER() OVER (PARTITION BY group_id, side ORDER BY cnt DESC, zone ASC NULLS LAST) AS INTEGER) AS rank,
         {pct('cnt', 'SUM(cnt) OVER (PARTITION BY group_id, side)')} AS pct
  FROM counts) WHERE rank <= 10""", ["pct"]),
    "outlier_samples": q(TRIPS + "," + OUTLIER_GROUPS_SQL, f"""
SELECT group_id, rank, {RAW_COLS} FROM (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY group_id ORDER BY md5('42|' || concat_ws('|',
             COALESCE(CAST({P} AS VARCHAR), ''), COALESCE(CAST(tpep_dropoff_datetime AS VARCHAR), ''),
             COALESCE(CAST(PULocationID AS VARCHAR), ''), COALESCE(CAST(DOLocationID AS VARCHAR), ''),
             COALESCE(CAST(VendorID AS VARCHAR), ''))) ) AS INTEGER) AS rank
  FROM tagged) WHERE rank <= 10""", RAW_DOUBLES),
    # 2.7
    "temporal_split": q(CLEANED, f"SELECT {CLEANED_COLS}, split FROM splitted", CLEAN_DOUBLES),
    "split_report": q(CLEANED, f"""
SELECT a.split, a.rows, {pct('a.rows', 'SUM(a.rows) OVER ()')} AS share, a.first_hour, a.last_hour,
       a.dur_min, a.dur_median, a.dur_mean, a.dur_max, a.dist_min, a.dist_median, a.dist_mean, a.dist_max,
       a.nulls, d.duplicates
FROM (
  SELECT split, COUNT(*) AS rows,
         MIN(make_timestamp(pickup_year, pickup_month, pickup_day, pickup_hour, 0, 0)) AS first_hour,
         MAX(make_timestamp(pickup_year, pickup_month, pickup_day, pickup_hour, 59, 59)) AS last_hour,
         MIN(trip_duration_minutes) AS dur_min, {_pc('trip_duration_minutes', 0.5)} AS dur_median,
         AVG(trip_duration_minutes) AS dur_mean, MAX(trip_duration_minutes) AS dur_max,
         MIN(trip_distance) AS dist_min, {_pc('trip_distance', 0.5)} AS dist_median,
         AVG(trip_distance) AS dist_mean, MAX(trip_distance) AS dist_max,
         COUNT(*) FILTER (WHERE trip_duration_minutes IS NULL) + COUNT(*) FILTER (WHERE pickup_year IS NULL)
       + COUNT(*) FILTER (WHERE pickup_month IS NULL) + COUNT(*) FILTER (WHERE pickup_day IS NULL)
       + COUNT(*) FILTER (WHERE pickup_day_of_week IS NULL) + COUNT(*) FILTER (WHERE pickup_hour IS NULL)
       + COUNT(*) FILTER (WHERE is_weekend IS NULL) + COUNT(*) FILTER (WHERE trip_distance IS NULL)
       + COUNT(*) FILTER (WHERE is_long_haul IS NULL) + COUNT(*) FILTER (WHERE passenger_count IS NULL)
       + COUNT(*) FILTER (WHERE RatecodeID IS NULL) + COUNT(*) FILTER (WHERE VendorID IS NULL)
       + COUNT(*) FILTER (WHERE PULocationID IS NULL) + COUNT(*) FILTER (WHERE DOLocationID IS NULL) AS nulls
  FROM splitted GROUP BY split) a
JOIN (SELECT split, CAST(COALESCE(SUM(CASE WHEN cnt > 1 THEN cnt - 1 END), 0) AS BIGINT) AS duplicates
      FROM (SELECT split, COUNT(*) AS cnt FROM splitted GROUP BY split, {CLEANED_COLS}) GROUP BY split) d
ON d.split = a.split""",
                      ["share", "dur_min", "dur_median", "dur_mean", "dur_max", "dist_min", "dist_median",
                       "dist_mean", "dist_max"]),
    "split_integrity": q(CLEANED + """,
hb AS (SELECT split, make_timestamp(pickup_year, pickup_month, pickup_day, pickup_hour, 0, 0) AS hs,
              make_timestamp(pickup_year, pickup_month, pickup_day, pickup_hour, 59, 59) AS he FROM splitted),
a AS (SELECT COUNT(*) AS total, COUNT(split) AS in_splits,
             MAX(he) FILTER (WHERE split = 'train') AS train_max,
             MIN(hs) FILTER (WHERE split = 'validation') AS val_min,
             MAX(he) FILTER (WHERE split = 'validation') AS val_max,
             MIN(hs) FILTER (WHERE split = 'test') AS test_min FROM hb)""", """
SELECT 1 AS check_id, 'split rows sum to total' AS "check", CAST(in_splits AS VARCHAR) AS left_value,
       CAST(total AS VARCHAR) AS right_value, in_splits = total AS ok FROM a
UNION ALL SELECT 2, 'train ends before validation starts', CAST(train_max AS VARCHAR), CAST(val_min AS VARCHAR),
       COALESCE(train_max < val_min, false) FROM a
UNION ALL SELECT 3, 'validation ends before test starts', CAST(val_max AS VARCHAR), CAST(test_min AS VARCHAR),
       COALESCE(val_max < test_min, false) FROM a"""),
    "split_candidates": q(CLEANED + f""",
cand(candidate, part, y1, m_lo, m_hi) AS (VALUES
  ('A', 'train', {FIRST_YEAR}, 1, 12), ('A', 'validation', {SECOND_YEAR}, 1, 6), ('A', 'test', {SECOND_YEAR}, 7, 12),
  ('B', 'train', {FIRST_YEAR}, 1, 9), ('B', 'validation', {FIRST_YEAR}, 10, 12), ('B', 'test', {SECOND_YEAR}, 1, 12),
  ('C', 'train', {FIRST_YEAR}, 1, 12), ('C', 'validation', {SECOND_YEAR}, 1, 9), ('C', 'test', {SECOND_YEAR}, 10, 12)),
ct AS (SELECT c.candidate, c.part, t.trip_duration_minutes, t.trip_distance
       FROM cleaned t JOIN cand c ON t.pickup_year = c.y1 AND t.pickup_month BETWEEN c.m_lo AND c.m_hi)""",
                          f"""
SELECT candidate, part, COUNT(*) AS rows, {pct('COUNT(*)', 'SUM(COUNT(*)) OVER (PARTITION BY candidate)')} AS share,
       AVG(trip_duration_minutes) AS avg_dur, {_pc('trip_duration_minutes', 0.5)} AS med_dur,
       AVG(trip_distance) AS avg_dist
FROM ct GROUP BY candidate, part""", ["share", "avg_dur", "med_dur", "avg_dist"]),
    # 2.8
    "fit_ols": q(ols_base("validation"), METRICS_BODY, ["MAE", "RMSE", "R2"]),
    "regression_metrics": q(ols_base("test"), METRICS_BODY, ["MAE", "RMSE", "R2"]),
    "ols_coefficients": q(ols_base("test"), """
SELECT term, coefficient FROM (
  SELECT 'trip_distance' AS term, b_0 AS coefficient FROM coef
  UNION ALL SELECT 'passenger_count', b_1 FROM coef
  UNION ALL SELECT 'pickup_hour', b_2 FROM coef
  UNION ALL SELECT 'pickup_day_of_week', b_3 FROM coef
  UNION ALL SELECT 'pickup_month', b_4 FROM coef
  UNION ALL SELECT 'intercept', b_icpt FROM coef)""", ["coefficient"]),
    "metric_comparison": q(ols_base("validation") + f""",
m AS ({METRICS_BODY}),
ml AS (SELECT 'MAE' AS metric, MAE AS value FROM m UNION ALL SELECT 'RMSE', RMSE FROM m
       UNION ALL SELECT 'R2', R2 FROM m),
ref(metric, reference) AS (VALUES ('MAE', 5.2725::DOUBLE), ('RMSE', 8.1799::DOUBLE), ('R2', 0.633056::DOUBLE))""",
                           """
SELECT ml.metric, ref.reference, ml.value, ml.value - ref.reference AS delta,
       (ml.value - ref.reference) * 100.0 / NULLIF(ABS(ref.reference), 0) AS pct_change
FROM ml JOIN ref ON ref.metric = ml.metric""", ["reference", "value", "delta", "pct_change"]),
    "feature_cardinality": q(CLEANED, """
SELECT position, feature, kind, distinct_values, distinct_values <= 1 AS constant_in_train,
       kind = 'categorical' AND distinct_values > 255 AS too_many_categories FROM (
  SELECT 1 AS position, 'trip_distance' AS feature, 'numeric' AS kind, COUNT(DISTINCT trip_distance) AS distinct_values FROM splitted WHERE split = 'train'
  UNION ALL SELECT 2, 'passenger_count', 'numeric', COUNT(DISTINCT passenger_count) FROM splitted WHERE split = 'train'
  UNION ALL SELECT 3, 'pickup_hour', 'numeric', COUNT(DISTINCT pickup_hour) FROM splitted WHERE split = 'train'
  UNION ALL SELECT 4, 'is_weekend', 'numeric', COUNT(DISTINCT is_weekend) FROM splitted WHERE split = 'train'
  UNION ALL SELECT 5, 'is_long_haul', 'numeric', COUNT(DISTINCT is_long_haul) FROM splitted WHERE split = 'train'
  UNION ALL SELECT 6, 'PULocationID', 'numeric', COUNT(DISTINCT PULocationID) FROM splitted WHERE split = 'train'
  UNION ALL SELECT 7, 'DOLocationID', 'numeric', COUNT(DISTINCT DOLocationID) FROM splitted WHERE split = 'train'
  UNION ALL SELECT 8, 'pickup_day_of_week', 'categorical', COUNT(DISTINCT pickup_day_of_week) FROM splitted WHERE split = 'train'
  UNION ALL SELECT 9, 'pickup_month', 'categorical', COUNT(DISTINCT pickup_month) FROM splitted WHERE split = 'train'
  UNION ALL SELECT 10, 'pickup_year', 'categorical', COUNT(DISTINCT pickup_year) FROM splitted WHERE split = 'train'
  UNION ALL SELECT 11, 'RatecodeID', 'categorical', COUNT(DISTINCT RatecodeID) FROM splitted WHERE split = 'train'
  UNION ALL SELECT 12, 'VendorID', 'categorical', COUNT(DISTINCT VendorID) FROM splitted WHERE split = 'train')"""),
    "target_stats": q(CLEANED, f"""
SELECT COUNT(trip_duration_minutes) AS n, AVG(trip_duration_minutes) AS mean,
       {_pc('trip_duration_minutes', 0.5)} AS median
FROM splitted WHERE split = 'validation'""", ["mean", "median"]),
    "batch_score": q(TRIPS + "," + REQUESTS + """,
train_src AS (SELECT * FROM trips WHERE """ + KEEP + """),
cleaned AS (""" + _model_frame("train_src") + f"""),
train_rows AS (SELECT * FROM cleaned WHERE pickup_year * 100 + pickup_month < {_ym(TRAIN_END)}),
{ols_ctes()},
ok AS (SELECT trip_distance, passenger_count, pickup_hour,
              CAST((pickup_day_of_week + 1) % 7 AS INTEGER) AS pickup_day_of_week, pickup_month,
              PULocationID, DOLocationID, RatecodeID, VendorID
       FROM validated WHERE violation_text = '')""", f"""
SELECT CAST(s.trip_distance AS DOUBLE) AS trip_distance, CAST(s.passenger_count AS DOUBLE) AS passenger_count,
       CAST(s.pickup_hour AS DOUBLE) AS pickup_hour, CAST(s.pickup_day_of_week AS DOUBLE) AS pickup_day_of_week,
       CAST(s.pickup_month AS DOUBLE) AS pickup_month, s.PULocationID, s.DOLocationID, s.RatecodeID, s.VendorID,
       GREATEST({ols_prediction('s')}, 0.0) AS prediction
FROM ok s, coef""", ["trip_distance", "passenger_count", "pickup_hour", "pickup_day_of_week", "pickup_month",
                    "prediction"]),
    "overall_mae": q(ols_base("test"), """
SELECT AVG(ABS(trip_duration_minutes - prediction)) AS mae, COUNT(*) AS rows FROM scored""", ["mae"]),
    "mae_by_distance": q(ols_base("test") + "," + ERROR_BUCKETS, f"""
SELECT b.bucket_id, b.bucket, a.mae, CAST(COALESCE(a.trips, 0) AS BIGINT) AS trips
FROM buckets b LEFT JOIN (
  SELECT {BUCKET_EXPR} AS bucket_id, AVG(ABS(trip_duration_minutes - prediction)) AS mae, COUNT(*) AS trips
  FROM scored GROUP BY 1) a ON a.bucket_id = b.bucket_id""", ["mae"]),
    "mae_by_hour": q(ols_base("test"), f"""
SELECT h.hour, {BAND_EXPR.format(h='h.hour')} AS band, a.mae, CAST(COALESCE(a.trips, 0) AS BIGINT) AS trips
FROM (SELECT CAST(range AS INTEGER) AS hour FROM range(24)) h LEFT JOIN (
  SELECT pickup_hour AS hour, AVG(ABS(trip_duration_minutes - prediction)) AS mae, COUNT(*) AS trips
  FROM scored GROUP BY 1) a ON a.hour = h.hour""", ["mae"]),
}


_RULES = ["trip_duration_minutes < 1", "trip_distance < 0.1", "trip_duration_minutes > 120 AND trip_distance < 2", "trip_distance > 50",
          "trip_duration_minutes >= 1 AND trip_duration_minutes < 2 AND trip_distance >= 0.1", "passenger_count > 6"]
_FLAGS = ", ".join(f"coalesce({r}, false) AS f{k}" for k, r in enumerate(_RULES, 1))
_MATCHED = " + ".join(f"f{k}::INTEGER" for k in range(1, len(_RULES) + 1))
ORACLE["rule_overlap"] = q(TRIPS + f", flags AS (SELECT {_FLAGS} FROM trips), counted AS (SELECT *, {_MATCHED} AS matched FROM flags)", " UNION ALL ".join(
    f"""SELECT {a} AS rule_a, {b} AS rule_b, COUNT(*) FILTER (f{a} AND f{b}) AS both,
    COUNT(*) FILTER (f{a} AND f{b} AND matched = {1 if a == b else 2}) AS no_other,
    {pct(f'COUNT(*) FILTER (f{a} AND f{b})', f'COUNT(*) FILTER (f{a})')} AS pct_of_a FROM counted"""
    for a in range(1, len(_RULES) + 1) for b in range(a, len(_RULES) + 1)), ["pct_of_a"])
ORACLE["distance_cap"] = q(TRIPS, f"""
SELECT COUNT(*) AS rows, MAX(trip_distance) AS max_distance, AVG(trip_duration_minutes) AS avg_dur FROM trips
WHERE trip_distance <= (SELECT {_pc('trip_distance', 0.999)} FROM trips)""", ["max_distance", "avg_dur"])
_SURPLUS = "COALESCE(SUM(CASE WHEN cnt > 1 THEN cnt - 1 END), 0)"
_DUPLICATES = f"""CAST({_SURPLUS} AS BIGINT) AS duplicate_rows, COUNT(*) FILTER (WHERE cnt > 1) AS duplicate_groups,
       CAST(SUM(cnt) AS BIGINT) AS total_rows, {pct(_SURPLUS, 'SUM(cnt)')} AS duplicate_pct"""
ORACLE["duplicate_count_wide"] = q(TRIPS, f"SELECT {_DUPLICATES} FROM (SELECT *, COUNT(*) AS cnt FROM trips GROUP BY ALL)", ["duplicate_pct"])
ORACLE["duplicate_count_wide_by_year"] = q(DUP, f"""
SELECT ship_year, {_DUPLICATES} FROM (SELECT *, COUNT(*) AS cnt FROM dup GROUP BY ALL) GROUP BY ship_year""", ["duplicate_pct"])
ORACLE["unusual_values_found"] = f"SELECT * FROM ({ORACLE['unusual_values']}) WHERE rows_matched > 0"
ORACLE["write_scored"] = q(ols_base("test"), """
SELECT trip_duration_minutes AS y_true, prediction AS y_pred, trip_distance, pickup_hour FROM scored""", ["y_true", "y_pred", "trip_distance"])
ORACLE["model_round_trip"] = q(CLEANED, """
SELECT COUNT(*) AS rows, CASE WHEN COUNT(*) > 0 THEN 0.0::DOUBLE END AS max_abs_diff FROM splitted WHERE split = 'test'""")
ORACLE["model_comparison"] = q(ols_base("validation").replace("scored AS", "scored_v AS") + f""",
scored_t AS (SELECT s.*, {ols_prediction('s')} AS prediction FROM splitted s, coef WHERE s.split = 'test'),
mv AS ({METRICS_BODY.replace('FROM scored', 'FROM scored_v')}), mt AS ({METRICS_BODY.replace('FROM scored', 'FROM scored_t')}),
pairs AS (SELECT 'MAE' AS metric, mv.MAE AS reference, mt.MAE AS value FROM mv, mt UNION ALL SELECT 'RMSE', mv.RMSE, mt.RMSE FROM mv, mt
          UNION ALL SELECT 'R2', mv.R2, mt.R2 FROM mv, mt)""", """
SELECT metric, reference, value, value - reference AS delta, (value - reference) * 100.0 / NULLIF(ABS(reference), 0) AS pct_change FROM pairs""",
                               ["reference", "value", "delta", "pct_change"])
_KEY = " || '-' || ".join(f"coalesce({c}::VARCHAR, '')" for c in ("pickup_year", "pickup_month", "pickup_day", "pickup_hour", "PULocationID", "DOLocationID"))
ORACLE["target_encoding"] = q(CLEANED + f""",
f AS (SELECT PULocationID, trip_duration_minutes AS y, CAST(('0x' || substr(md5({_KEY}), 1, 8))::BIGINT % 5 AS INTEGER) AS fold
      FROM splitted WHERE split = 'train'),
z AS (SELECT PULocationID, fold, COUNT(*) AS rows FROM f GROUP BY ALL),
e AS (SELECT z.*, (SELECT AVG(y) FROM f WHERE f.fold <> z.fold) AS mean,
      (SELECT coalesce(SUM(y), 0) FROM f WHERE f.fold <> z.fold AND f.PULocationID = z.PULocationID) AS s,
      (SELECT COUNT(y) FROM f WHERE f.fold <> z.fold AND f.PULocationID = z.PULocationID) AS n FROM z)""", """
SELECT PULocationID, fold, rows, (s + 20.0 * mean) / (n + 20.0) AS encoded, (s + 20.0 * mean) / (n + 20.0) AS encoded_max FROM e""",
                              ["encoded", "encoded_max"])
ORACLE["interval_coverage"] = q(ols_base("validation").replace("scored AS", "scored_v AS") + f""",
scored_t AS (SELECT s.*, {ols_prediction('s')} AS prediction FROM splitted s, coef WHERE s.split = 'test'),
rv AS (SELECT {BUCKET_EXPR} AS b, pickup_hour AS h, ABS(trip_duration_minutes - prediction) AS r FROM scored_v),
w AS (SELECT b, h, {_pc('r', 0.9)} AS w FROM rv GROUP BY b, h), wa AS (SELECT {_pc('r', 0.9)} AS wa FROM rv),
t AS (SELECT {BUCKET_EXPR} AS bucket_id, trip_duration_minutes AS y, prediction AS p, coalesce(w, wa) AS w
      FROM scored_t CROSS JOIN wa LEFT JOIN w ON w.b = {BUCKET_EXPR} AND w.h = pickup_hour),
i AS (SELECT bucket_id, y, greatest(p - w, 0.0) AS lo, p + w AS hi FROM t)""", f"""
SELECT bucket_id, COUNT(*) AS rows, COUNT(*) FILTER (y BETWEEN lo AND hi) AS covered,
       {pct('COUNT(*) FILTER (y BETWEEN lo AND hi)', 'COUNT(*)')} AS coverage, AVG(hi - lo) AS mean_width FROM i GROUP BY bucket_id""",
                                ["coverage", "mean_width"])
ORACLE["boosted_score"] = q(TRIPS + "," + REQUESTS, """
SELECT COUNT(*) AS rows, CASE WHEN COUNT(*) > 0 THEN 0.0::DOUBLE END AS max_abs_diff, 0::BIGINT AS negative, 0::BIGINT AS missing
FROM validated WHERE violation_text = ''""")
ORACLE["stream_batch_score"] = ORACLE["batch_score"]
ORACLE["stream_clean_trips"] = ORACLE["write_cleaned"]
ORACLE["rule_impact_on_write"] = ORACLE["rule_impact"]
ORACLE["stream_validate_requests"] = ORACLE["validate_requests"]


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
