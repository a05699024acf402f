"""Keyed JSON output records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.functions.json import encode_json
from txlens.schema import ANOMALY_COLUMNS, MERCHANT_AGG_COLUMNS


def encode_records(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key string, value JSON string). Null fields are left out of the JSON object, an absent column is an error;
    timestamps are ISO-8601 with zone."""
    absent = [c for c in fields if c not in df.columns]
    if absent:
        raise ValueError(f"the record needs the columns {absent}")
    return df.select(F.col(key).cast("string").alias("key"), encode_json(*fields).alias("value"))


def encode_aggregates(agg: DataFrame) -> DataFrame:
    """Merchant aggregates -> key merchant, JSON value."""
    return encode_records(agg, "merchant", MERCHANT_AGG_COLUMNS)


def encode_anomalies(anom: DataFrame) -> DataFrame:
    """Anomalies -> key transaction_id, JSON value."""
    return encode_records(anom, "transaction_id", ANOMALY_COLUMNS)
