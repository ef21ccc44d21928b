"""Schemas, column lists, thresholds and lookup tables.

Every operator takes these as keyword defaults, so a caller can point the
same operator at other column names or other cut-offs.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names of a raw trip table.
# ---------------------------------------------------------------------------
VENDOR = "VendorID"
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
PASSENGERS = "passenger_count"
DISTANCE = "trip_distance"
RATECODE = "RatecodeID"
PU_ZONE = "PULocationID"
DO_ZONE = "DOLocationID"
DURATION = "trip_duration_minutes"

RAW_COLUMNS = [VENDOR, PICKUP, DROPOFF, PASSENGERS, DISTANCE, RATECODE,
               PU_ZONE, DO_ZONE, DURATION]

RAW_SCHEMA = T.StructType([
    T.StructField(VENDOR, T.IntegerType()),
    T.StructField(PICKUP, T.TimestampNTZType()),
    T.StructField(DROPOFF, T.TimestampNTZType()),
    T.StructField(PASSENGERS, T.DoubleType()),
    T.StructField(DISTANCE, T.DoubleType()),
    T.StructField(RATECODE, T.IntegerType()),
    T.StructField(PU_ZONE, T.IntegerType()),
    T.StructField(DO_ZONE, T.IntegerType()),
    T.StructField(DURATION, T.DoubleType()),
])

# ---------------------------------------------------------------------------
# The cleaned, leakage-safe model frame: 14 columns in this order.
# ---------------------------------------------------------------------------
YEAR, MONTH, DAY, DOW, HOUR = ("pickup_year", "pickup_month", "pickup_day",
                               "pickup_day_of_week", "pickup_hour")
WEEKEND = "is_weekend"
LONG_HAUL = "is_long_haul"

CLEANED_SCHEMA = T.StructType([
    T.StructField(DURATION, T.DoubleType()),
    T.StructField(YEAR, T.IntegerType()),
    T.StructField(MONTH, T.IntegerType()),
    T.StructField(DAY, T.IntegerType()),
    T.StructField(DOW, T.IntegerType()),
    T.StructField(HOUR, T.IntegerType()),
    T.StructField(WEEKEND, T.IntegerType()),
    T.StructField(DISTANCE, T.DoubleType()),
    T.StructField(LONG_HAUL, T.IntegerType()),
    T.StructField(PASSENGERS, T.IntegerType()),
    T.StructField(RATECODE, T.IntegerType()),
    T.StructField(VENDOR, T.IntegerType()),
    T.StructField(PU_ZONE, T.IntegerType()),
    T.StructField(DO_ZONE, T.IntegerType()),
])
CLEANED_COLUMNS = [f.name for f in CLEANED_SCHEMA.fields]

# Role of each cleaned column (column_profile).
COLUMN_ROLES = {
    "trip_duration_minutes": "TARGET",
    "pickup_year": "feature (time)",
    "pickup_month": "feature (time)",
    "pickup_day": "feature (time)",
    "pickup_day_of_week": "feature (time)",
    "pickup_hour": "feature (time)",
    "is_weekend": "feature (time)",
    "trip_distance": "feature",
    "is_long_haul": "feature (flag)",
    "passenger_count": "feature",
    "RatecodeID": "feature",
    "VendorID": "feature",
    "PULocationID": "feature",
    "DOLocationID": "feature",
}

# ---------------------------------------------------------------------------
# Thresholds of the cleaning rules and flags (fixed values).
# ---------------------------------------------------------------------------
MIN_DURATION = 1.0          # minutes; shorter trips are removed
MIN_DISTANCE = 0.1          # miles; shorter trips are removed
LONG_DURATION = 120.0       # minutes; with distance < STUCK_DISTANCE removed
STUCK_DISTANCE = 2.0        # miles
LONG_HAUL_MILES = 50.0      # kept and flagged
SHORT_DURATION = 2.0        # 1-2 minute trips are kept
MAX_PASSENGERS = 6          # more are removed

# Weekend days in the table convention (0 = Sunday ... 6 = Saturday).
WEEKEND_DAYS_SUNDAY0 = (0, 6)
# Weekend days in the request convention (0 = Monday ... 6 = Sunday).
WEEKEND_DAYS_MONDAY0 = (5, 6)

# Valid request values (fixed values).
VALID_VENDOR_IDS = (1, 2)
VALID_RATECODE_IDS = (1, 2, 3, 4, 5, 6, 99)
ZONE_RANGE = (1, 265)
PASSENGER_RANGE = (1, 6)
HOUR_RANGE = (0, 23)
MONTH_RANGE = (1, 12)
DOW_RANGE = (0, 6)

# Lookup labels (fixed values).
RATECODE_LABELS = {
    1: "1 - Standard Rate",
    2: "2 - JFK Airport",
    3: "3 - Newark Airport",
    4: "4 - Nassau / Westchester",
    5: "5 - Negotiated Fare",
    6: "6 - Group Ride",
    99: "99 - Unknown",
}
VENDOR_LABELS = {1: "1 - Creative Mobile Technologies", 2: "2 - VeriFone Inc."}
DOW_SHORT_SUNDAY0 = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
MONTH_SHORT = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
               "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
LONG_HAUL_LABELS = {0: "standard", 1: "long haul"}

# Distance groups of the EDA (fixed values; upper bound exclusive, last one open).
DISTANCE_GROUPS = [(1.0, "< 1 mi"), (2.0, "1-2 mi"), (3.0, "2-3 mi"),
                   (5.0, "3-5 mi"), (10.0, "5-10 mi"), (20.0, "10-20 mi"),
                   (None, "20+ mi")]

# Error-analysis distance buckets: inner edges and labels (fixed values).
ERROR_BUCKET_EDGES = [1.0, 2.0, 3.0, 5.0, 8.0, 12.0, 20.0, 50.0]
ERROR_BUCKET_LABELS = ["0–1", "1–2", "2–3", "3–5", "5–8", "8–12", "12–20",
                       "20–50", "50+"]

# Time-of-day bands (fixed values): first hour, last hour, label.
TIME_BANDS = [(0, 5, "Night (0–5)"), (6, 9, "Morning rush (6–9)"),
              (10, 15, "Midday (10–15)"), (16, 19, "Evening rush (16–19)"),
              (20, 23, "Evening (20–23)")]

# Outlier groups of the drill-down (fixed values): id, label, verdict.
OUTLIER_GROUPS = [
    (1, "Duration < 1 min", "A - Remove"),
    (2, "Duration 1-2 min", "C - Decide"),
    (3, "Duration > 120 min", "B/A - Conditional"),
    (4, "Distance < 0.1 mi", "A - Remove"),
    (5, "Distance > 50 mi", "B - Keep+Flag"),
    (6, "Passenger count > 6", "A - Remove"),
]

# Unusual-value checks of the EDA, in report order (fixed values).
UNUSUAL_CHECK_LABELS = [
    "Duration < 1 min (likely invalid)",
    "Duration > 120 min (very long)",
    "Distance < 0.1 mi (near-zero)",
    "Distance > 50 mi (very long haul)",
    "Passenger count = 0",
    "Passenger count > 6",
    "Duration > 0 but Distance = 0",
]

# ---------------------------------------------------------------------------
# Model feature lists (fixed values).
# ---------------------------------------------------------------------------
OLS_FEATURES = [DISTANCE, PASSENGERS, HOUR, DOW, MONTH]
BOOSTED_NUMERIC = [DISTANCE, PASSENGERS, HOUR, WEEKEND, LONG_HAUL, PU_ZONE,
                   DO_ZONE]
BOOSTED_CATEGORICAL_11 = [DOW, MONTH, RATECODE, VENDOR]
BOOSTED_CATEGORICAL_12 = [DOW, MONTH, YEAR, RATECODE, VENDOR]
BOOSTED_FEATURES_11 = BOOSTED_NUMERIC + BOOSTED_CATEGORICAL_11
BOOSTED_FEATURES_12 = BOOSTED_NUMERIC + BOOSTED_CATEGORICAL_12

# Published validation metrics used for comparison reports (fixed values).
REFERENCE_METRICS = {
    "least_squares_validation": {"MAE": 5.2725, "RMSE": 8.1799, "R2": 0.633056},
    "boosted_validation": {"MAE": 3.3063, "RMSE": 5.5786, "R2": 0.829329},
}

# Boosting parameters of the reference models.
BOOST_ITERATIONS = 300
BOOST_MIN_LEAF = 20
BOOST_RATE = 0.1
BOOST_BINS = 255
BOOST_DEPTH = 5          # level-wise depth 5 = at most 32 leaves (31 leaf-wise)
BOOST_SEED = 42
