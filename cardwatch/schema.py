"""Column names, types and fixed category lists of the transaction tables."""

from __future__ import annotations

from pyspark.sql import types as T

ID = "transaction_id"
LABEL = "is_fraud"
SPLIT = "split"

# The columns and types of a transaction file, in file order.
_RAW = [
    (ID, T.LongType()),
    ("amount", T.DoubleType()),
    ("transaction_hour", T.IntegerType()),
    ("merchant_category", T.StringType()),
    ("foreign_transaction", T.IntegerType()),
    ("location_mismatch", T.IntegerType()),
    ("device_trust_score", T.IntegerType()),
    ("velocity_last_24h", T.IntegerType()),
    ("cardholder_age", T.IntegerType()),
]

TEST_SCHEMA = T.StructType([T.StructField(n, t) for n, t in _RAW])
TRAIN_SCHEMA = T.StructType([*TEST_SCHEMA.fields, T.StructField(LABEL, T.IntegerType())])

RAW_COLUMNS = [n for n, _ in _RAW]
RAW_FEATURES = [n for n in RAW_COLUMNS if n not in (ID, "merchant_category")]
NUMERIC = ["amount", "transaction_hour", "device_trust_score", "velocity_last_24h", "cardholder_age"]
BINARY = ["foreign_transaction", "location_mismatch"]

ENGINEERED = [
    "is_night_transaction",
    "amount_to_trust_ratio",
    "amount_velocity_ratio",
    "is_high_risk_location",
    "location_anomaly_score",
    "is_high_amount",
    "is_low_trust",
]

# Category lists of the one-hot columns, sorted as the columns are.
MERCHANT_CATEGORIES = ["Clothing", "Electronics", "Food", "Grocery", "Travel"]
TIMES_OF_DAY = ["Afternoon", "Evening", "Morning", "Night"]

# Order in which the times of day are reported.
TIME_OF_DAY_ORDER = ["Night", "Morning", "Afternoon", "Evening"]

RESULTS_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_seq", T.LongType()),
        T.StructField("Model_Name", T.StringType()),
        T.StructField("CV_Accuracy", T.DoubleType()),
        T.StructField("CV_F1_Score", T.DoubleType()),
        T.StructField("CV_PR_AUC", T.DoubleType()),
        T.StructField("CV_Precision", T.DoubleType()),
        T.StructField("CV_Recall", T.DoubleType()),
        T.StructField("Best_Parameters", T.StringType()),
        T.StructField("Model_File_Path", T.StringType()),
        T.StructField("Output_Predictions_Path", T.StringType()),
    ]
)


def one_hot_names(merchants: list[str]) -> list[str]:
    """Names of the encoded columns, in table order."""
    return [f"merchant_category_{m}" for m in sorted(merchants)] + [
        f"time_of_day_category_{t}" for t in TIMES_OF_DAY
    ]


def feature_names(merchants: list[str]) -> list[str]:
    """The model inputs: raw numerics, engineered columns, one-hot columns."""
    return RAW_FEATURES + ENGINEERED + one_hot_names(merchants)
