"""Row layouts shared by every module.

The column names and types below are fixed values: existing files and messages
carry them, including the spelling ``tranaction_id``.
"""

from __future__ import annotations

RAW = (
    "tranaction_id LONG, tx_datetime STRING, customer_id INT, terminal_id INT, "
    "tx_amount DOUBLE, tx_time_seconds LONG, tx_time_days LONG, "
    "tx_fraud INT, tx_fraud_scenario INT"
)
RAW_COLUMNS = [field.split()[0] for field in RAW.split(", ")]

LABEL_COLUMNS = ["tx_fraud", "tx_fraud_scenario"]
REQUIRED_COLUMNS = [c for c in RAW_COLUMNS if c not in LABEL_COLUMNS]

# A message carries the same nine fields, all as text.
RAW_STRING = ", ".join(f"{c} STRING" for c in RAW_COLUMNS)

CLEAN_TYPES = {
    "tranaction_id": "bigint",
    "tx_datetime": "timestamp",
    "customer_id": "int",
    "terminal_id": "int",
    "tx_amount": "double",
    "tx_time_seconds": "bigint",
    "tx_time_days": "bigint",
    "tx_fraud": "int",
    "tx_fraud_scenario": "int",
}

NON_NEGATIVE_COLUMNS = ["tranaction_id", "customer_id", "terminal_id", "tx_time_seconds"]

WINDOW_DAYS = (1, 7, 30)

# The 14 model inputs, in the order saved models expect.
FEATURES = [
    "customer_id",
    "terminal_id",
    "tx_amount",
    "day_of_week",
    "week_of_year",
    "is_weekend",
    "hour",
    "is_day",
    "avg_amount_per_customer_for_1_days",
    "number_of_tx_per_customer_for_1_days",
    "avg_amount_per_customer_for_7_days",
    "number_of_tx_per_customer_for_7_days",
    "avg_amount_per_customer_for_30_days",
    "number_of_tx_per_customer_for_30_days",
]

# Layout of a forecast text file, matched to the file by position.
FORECAST_TEXT = "tx_id LONG, datetime STRING, prediction DOUBLE, probability STRING"

RUNS = (
    "run_id STRING, experiment STRING, status STRING, started_at TIMESTAMP, "
    "metrics MAP<STRING,DOUBLE>, params MAP<STRING,STRING>, artifact_path STRING"
)

# Metric names under which training and comparison results are logged.
AUC_CV = "ROC AUC on cv"
AUC_TEST = "ROC AUC on test"
PRECISION_TRAIN = "Precision on train"
RECALL_TRAIN = "Recall on train"
PRECISION_TEST = "Precision on test"
RECALL_TEST = "Recall on test"
P_VALUE = "P_value"
# Our own: the smallest score that meets the targets on the test dates.
THRESHOLD = "Threshold on test"
