"""Table schemas, model feature contract and key declarations.

Fixed values that must equal the original application's for identical
results are kept together below and marked as such.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Stored tables (typed like the original relational DDL; VARCHAR -> string,
# FLOAT -> double, SERIAL -> long). Names, order, types and nulls.
# Times are wall clock times without a zone.
# --------------------------------------------------------------------------

PAYMENTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("trans_num", T.StringType(), False),
        T.StructField("cc_num", T.StringType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("amt", T.DecimalType(10, 2)),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("street", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("city_pop", T.IntegerType()),
        T.StructField("job", T.StringType()),
        T.StructField("dob", T.StringType()),
        T.StructField("trans_num_original", T.StringType()),
        T.StructField("merch_lat", T.DoubleType()),
        T.StructField("merch_long", T.DoubleType()),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("transaction_time", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

TRAINING_DATA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("trans_num", T.StringType(), False),
        T.StructField("cc_num", T.StringType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("amt", T.DecimalType(10, 2)),
        T.StructField("gender", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip", T.StringType()),
        T.StructField("city_pop", T.IntegerType()),
        T.StructField("distance_km", T.DoubleType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("is_business_hour", T.IntegerType()),
        T.StructField("is_morning", T.IntegerType()),
        T.StructField("is_afternoon", T.IntegerType()),
        T.StructField("is_evening", T.IntegerType()),
        T.StructField("is_night", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("dayofweek", T.IntegerType()),
        T.StructField("is_we", T.IntegerType()),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("trans_num", T.StringType(), False),
        T.StructField("is_fraud", T.BooleanType(), False),
        T.StructField("fraud_probability", T.DoubleType(), False),
        T.StructField("predicted_at", T.TimestampNTZType()),
    ]
)

FRAUD_ALERTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("trans_num", T.StringType(), False),
        T.StructField("email_sent", T.BooleanType()),
        T.StructField("email_sent_at", T.TimestampNTZType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

STORED_TABLES = {
    "payments": PAYMENTS, "training_data": TRAINING_DATA, "predictions": PREDICTIONS, "fraud_alerts": FRAUD_ALERTS,
}

# Unique keys and foreign keys of the stored tables: (child, parent, column).
UNIQUE_KEYS = {
    "payments": "trans_num",
    "training_data": "trans_num",
    "predictions": "trans_num",
    "fraud_alerts": "trans_num",
}
FOREIGN_KEYS = [
    ("training_data", "payments", "trans_num"),
    ("predictions", "payments", "trans_num"),
    ("fraud_alerts", "payments", "trans_num"),
]
NOT_NULL = {
    "payments": ["trans_num"],
    "training_data": ["trans_num"],
    "predictions": ["trans_num", "is_fraud", "fraud_probability"],
    "fraud_alerts": ["trans_num"],
}

# --------------------------------------------------------------------------
# Fixed values (must equal the original application's).
# --------------------------------------------------------------------------

# Model feature contract, in model order: 17 numeric then 4 categorical.
NUMERIC_FEATURES = [
    "cc_num", "amt", "zip", "city_pop", "distance_km", "age", "hour",
    "is_night", "is_morning", "is_afternoon", "is_evening", "is_business_hour",
    "year", "month", "day", "dayofweek", "is_we",
]
CATEGORICAL_FEATURES = ["merchant", "category", "gender", "state"]
MODEL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES

# Engineered feature names, in the order they are added.
ENGINEERED_FEATURES = [
    "age", "distance_km", "hour", "is_night", "is_morning", "is_afternoon",
    "is_evening", "is_business_hour", "year", "month", "day", "dayofweek", "is_we",
]

# Columns dropped before storing training rows from the feed (12 names).
FEED_DROP_COLUMNS = [
    "lat", "long", "merch_lat", "merch_long", "first", "last", "job", "dob",
    "transaction_time", "city", "street", "time",
]
# Columns dropped from the history CSV before training (14 names).
HISTORY_DROP_COLUMNS = [
    "lat", "long", "merch_lat", "merch_long", "first", "last", "job", "dob",
    "trans_date_trans_time", "city", "street", "time", "unix_time", "trans_num",
]

# Prefix stripped from merchant names.
MERCHANT_PREFIX = "fraud_"

# Earth radius in km used by the haversine distance.
EARTH_RADIUS_KM = 6371.0

# Risk level cut points on the fraud probability (upper bounds, exclusive).
RISK_LEVELS = [(0.3, "LOW"), (0.6, "MEDIUM"), (0.8, "HIGH")]
RISK_TOP_LEVEL = "CRITICAL"

# Alert threshold on the fraud probability (strictly greater).
ALERT_THRESHOLD = 0.5

# Minimum model gates and champion/challenger margins.
MIN_RECALL = 0.90
MIN_PRECISION = 0.75
MIN_F1 = 0.80
MIN_RECALL_GAIN = 0.01
MAX_PRECISION_LOSS = -0.05

# Reasons of the deploy decision.
REASONS = {
    "none": "no production model",
    "failed": "comparison failed",
    "better": "better performance",
    "worse": "not better enough",
}

# Random forest hyper-parameters of the retraining job.
FOREST_PARAMS = {
    "n_estimators": 100,
    "max_depth": 10,
    "min_samples_split": 10,
    "min_samples_leaf": 5,
    "random_state": 42,
}

# Validation bounds of the request schema.
LAT_RANGE = (-90.0, 90.0)
LONG_RANGE = (-180.0, 180.0)
REQUIRED_FIELDS = [
    "cc_num", "merchant", "category", "amt", "gender", "state", "zip",
    "lat", "long", "city_pop", "merch_lat", "merch_long", "dob", "transaction_time",
]

# Display labels of the dashboard tables.
STATUS_FRAUD = "🚨 FRAUD"
STATUS_LEGIT = "✅ LEGIT"
EMAIL_SENT = "✅ Sent"
EMAIL_PENDING = "⏳ Pending"
NOT_AVAILABLE = "N/A"

# Class names of the per-class report.
CLASS_NAMES = {0: "Legitimate", 1: "Fraud"}
