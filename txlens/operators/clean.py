"""Parse, event time, watermark and validity filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.functions.columns import ms_or_seconds_to_timestamp
from txlens.functions.json import parse_json
from txlens.schema import MILLIS_THRESHOLD, TRANSACTION_SCHEMA, WATERMARK_DELAY


def parse_transactions(envelope: DataFrame, schema=TRANSACTION_SCHEMA) -> DataFrame:
    """Envelope -> flat transaction fields + ``kafka_timestamp``.

    The value bytes are decoded as UTF-8 and parsed once by the fixed schema; a
    malformed message becomes a row of nulls (dropped later by the id filter).

    The parse sits in a one-row generator (``inline``): filters on the parsed fields
    cannot be pushed beneath it, so each message is parsed exactly once instead of
    once more per pushed-down predicate.
    """
    row = F.struct(parse_json("value", schema).alias("data"), F.col("timestamp").alias("kafka_timestamp"))
    return envelope.select(F.inline(F.array(row))).select("data.*", "kafka_timestamp")


def with_event_time(
    df: DataFrame,
    epoch_col: str = "transaction_time",
    out: str = "transaction_timestamp",
    threshold: int = MILLIS_THRESHOLD,
) -> DataFrame:
    """Add the event time: epoch above ``threshold`` is ms, else seconds; whole seconds."""
    return df.withColumn(out, ms_or_seconds_to_timestamp(epoch_col, threshold))


def with_watermark(df: DataFrame, col: str = "transaction_timestamp", delay: str = WATERMARK_DELAY) -> DataFrame:
    """Event-time watermark (a no-op on batch tables)."""
    return df.withWatermark(col, delay)


def valid_transactions(df: DataFrame) -> DataFrame:
    """Keep rows with an id and a positive amount (a null amount is dropped too)."""
    return df.filter(F.col("transaction_id").isNotNull() & (F.col("amount") > 0))


def clean_transactions(
    envelope: DataFrame, delay: str = WATERMARK_DELAY, threshold: int = MILLIS_THRESHOLD
) -> DataFrame:
    """parse -> event time -> watermark -> validity: the shared input of both queries."""
    return valid_transactions(with_watermark(with_event_time(parse_transactions(envelope), threshold=threshold), delay=delay))


def land_transactions(
    envelope: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by_date: bool = True,
) -> None:
    """Batch landing: parse the log once and store typed, valid transactions as a
    columnar table. Batch queries then scan only the columns they use, with filters
    pushed into the scan, instead of re-parsing JSON per query.

    With ``partition_by_date`` the table is partitioned by the UTC date of the event
    time (``event_date``), so a time-bounded run reads only its days (partition
    pruning). Each task writes its own rows per date: no shuffle, no single task per
    date.
    """
    tx = valid_transactions(with_event_time(parse_transactions(envelope)))
    w = tx
    if partition_by_date:
        w = tx.withColumn("event_date", event_date("transaction_timestamp"))
    writer = w.write.mode(mode).format(fmt)
    if partition_by_date:
        writer = writer.partitionBy("event_date")
    writer.save(path)


def event_date(ts: str = "transaction_timestamp"):
    """UTC calendar date of a timestamp, independent of the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / F.lit(86400)).cast("int"))


def prepare_transactions(tx: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Already-typed transaction fields (a columnar landing table) -> event time,
    watermark, validity. Same result as :func:`clean_transactions` minus the JSON step."""
    return valid_transactions(with_watermark(with_event_time(tx), delay=delay))
