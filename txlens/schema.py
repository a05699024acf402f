"""Schemas and the fixed parameters of the transaction processor."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Columns of a message-log record (the shape of Spark's Kafka source).
ENVELOPE_SCHEMA = StructType(
    [
        StructField("key", BinaryType(), True),
        StructField("value", BinaryType(), True),
        StructField("topic", StringType(), True),
        StructField("partition", IntegerType(), True),
        StructField("offset", LongType(), True),
        StructField("timestamp", TimestampType(), True),
        StructField("timestampType", IntegerType(), True),
    ]
)

# ---------------------------------------------------------------------------
# These must equal the reference's for the same results.
# ---------------------------------------------------------------------------
# Transaction message as it arrives in the log (JSON object with these nine fields).
TRANSACTION_SCHEMA = StructType(
    [
        StructField("transaction_id", StringType(), False),
        StructField("user_id", StringType(), False),
        StructField("amount", DoubleType(), False),
        StructField("currency", StringType(), True),
        StructField("transaction_time", LongType(), False),
        StructField("merchant", StringType(), True),
        StructField("is_international", BooleanType(), True),
        StructField("transaction_type", StringType(), True),
        StructField("payment_method", StringType(), True),
    ]
)

# Output column order of the merchant aggregates and the anomaly records.
MERCHANT_AGG_COLUMNS = [
    "merchant",
    "window_start",
    "window_end",
    "total_transactions",
    "total_amount",
    "average_amount",
    "min_amount",
    "max_amount",
    "unique_users",
    "currencies_used",
]
ANOMALY_COLUMNS = [
    "transaction_id",
    "user_id",
    "amount",
    "merchant",
    "transaction_timestamp",
    "is_international",
    "transaction_count",
    "avg_transaction_amount",
    "anomaly_reasons",
    "detected_at",
]

SOURCE_TOPIC = "log_finance_transactions_v1"
AGGREGATES_TOPIC = "finance_transaction_aggregates_v1"
ANOMALIES_TOPIC = "finance_transaction_anomalies_v1"
TOPIC_PARTITIONS = 12

AMOUNT_THRESHOLD_MULTIPLIER = 3.0  # HIGH_AMOUNT: amount > 3 x the user's window average
TRANSACTION_COUNT_THRESHOLD = 10  # HIGH_FREQUENCY: more than 10 transactions in the window
NO_STATS_AMOUNT_LIMIT = 10000  # HIGH_AMOUNT when the user has no statistics
INTERNATIONAL_AMOUNT_LIMIT = 1000  # HIGH_INTERNATIONAL: international and amount > 1000
MILLIS_THRESHOLD = 1000000000000  # transaction_time above 10^12 is in milliseconds

WATERMARK_DELAY = "10 minutes"
MERCHANT_WINDOW = "5 minutes"
MERCHANT_SLIDE = "1 minute"
USER_WINDOW = "30 minutes"

AGGREGATES_QUERY_NAME = "MerchantAggregates"
ANOMALIES_QUERY_NAME = "AnomalyDetection"

MAX_OFFSETS_PER_TRIGGER = 10000
STATE_SHUFFLE_PARTITIONS = 20

REASON_HIGH_AMOUNT = "HIGH_AMOUNT"
REASON_HIGH_FREQUENCY = "HIGH_FREQUENCY"
REASON_HIGH_INTERNATIONAL = "HIGH_INTERNATIONAL"

CURRENCIES = ["USD", "EUR", "GBP", "JPY"]
MERCHANTS = ["Amazon", "eBay", "Walmart", "Target"]
TRANSACTION_TYPES = ["purchase", "refund", "withdrawal", "deposit"]
PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "bank_transfer"]
GENERATOR_USERS = 1000
GENERATOR_MIN_AMOUNT = 10.0
GENERATOR_MAX_AMOUNT = 1000.0
PRODUCER_TARGET_MSGS_PER_SEC = 300000

# Storage estimate factors of the capacity note: +50% log overhead, 3 replicas, 5x compression.
STORAGE_OVERHEAD = 1.5
STORAGE_REPLICAS = 3
STORAGE_COMPRESSION = 5.0
# ---------------------------------------------------------------------------

TRANSACTION_FIELDS = [f.name for f in TRANSACTION_SCHEMA.fields]

# Parsed, typed transactions as landed in a columnar table (all fields nullable).
LANDED_SCHEMA = StructType(
    [StructField(f.name, f.dataType, True) for f in TRANSACTION_SCHEMA.fields]
    + [
        StructField("kafka_timestamp", TimestampType(), True),
        StructField("transaction_timestamp", TimestampType(), True),
    ]
)

# Name of the optional parse-once landing query (ours, not a fixed value).
LANDING_QUERY_NAME = "LandTransactions"
# Name of the append form of the merchant aggregates (ours too).
CLOSED_WINDOWS_QUERY_NAME = "ClosedMerchantWindows"
