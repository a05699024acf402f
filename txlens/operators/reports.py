"""Load reports: throughput per worker and overall, record size and storage estimate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.schema import (
    PRODUCER_TARGET_MSGS_PER_SEC,
    STORAGE_COMPRESSION,
    STORAGE_OVERHEAD,
    STORAGE_REPLICAS,
)

STRING_FIELDS = ["transaction_id", "user_id", "currency", "merchant", "transaction_type", "payment_method"]
# The capacity note's sizes: 8 bytes a number, 4 a flag.
FIXED_FIELD_BYTES = {"amount": 8, "transaction_time": 8, "is_international": 4}


def _rate(count: Column, elapsed: Column) -> Column:
    return F.when(elapsed > 0, count.cast("double") / elapsed).otherwise(F.lit(0.0))


def throughput_by_worker(df: DataFrame, worker: str, sec: str, ok: str) -> DataFrame:
    """Per worker: messages, successes (``ok`` true), errors, elapsed seconds between
    its first and last message, messages per second (0 when elapsed is 0)."""
    g = df.groupBy(F.col(worker).alias("worker_id")).agg(
        F.count(F.lit(1)).alias("message_count"),
        F.count(F.when(F.col(ok), 1)).alias("success_count"),
        F.count(F.when(~F.col(ok) | F.col(ok).isNull(), 1)).alias("error_count"),
        (F.max(sec) - F.min(sec)).cast("double").alias("elapsed"),
    )
    return g.withColumn("throughput", _rate(F.col("message_count"), F.col("elapsed")))


def throughput_overall(
    df: DataFrame, worker: str, sec: str, ok: str, target: float = PRODUCER_TARGET_MSGS_PER_SEC
) -> DataFrame:
    """One row: workers, totals, overall elapsed and rate, and whether the target was met."""
    g = df.agg(
        F.count_distinct(worker).alias("workers"),
        F.count(F.lit(1)).alias("total_messages"),
        F.count(F.when(F.col(ok), 1)).alias("total_success"),
        F.count(F.when(~F.col(ok) | F.col(ok).isNull(), 1)).alias("total_errors"),
        (F.max(sec) - F.min(sec)).cast("double").alias("elapsed"),
    )
    rate = _rate(F.col("total_messages"), F.col("elapsed"))
    return g.select(
        "*",
        rate.alias("throughput"),
        F.lit(float(target)).alias("target_throughput"),
        (rate >= F.lit(float(target))).alias("target_reached"),
    )


def record_size_profile(
    tx: DataFrame,
    overhead: float = STORAGE_OVERHEAD,
    replicas: int = STORAGE_REPLICAS,
    compression: float = STORAGE_COMPRESSION,
    include_json: bool = False,
) -> DataFrame:
    """Average UTF-8 bytes per string field, per record (strings + 8 bytes per number,
    4 per flag), total raw bytes and stored bytes = raw x overhead x replicas / compression.
    With ``include_json`` also the average size of the record as a JSON message."""
    sizes = {f: F.octet_length(f) for f in STRING_FIELDS}
    row = sum((F.coalesce(c, F.lit(0)) for c in sizes.values()), F.lit(sum(FIXED_FIELD_BYTES.values())))
    aggs = [F.count(F.lit(1)).alias("records")]
    aggs += [F.avg(c).alias(f"avg_{f}_bytes") for f, c in sizes.items()]
    aggs += [F.avg(row).alias("avg_record_bytes"), F.sum(row).cast("long").alias("raw_bytes")]
    if include_json:
        aggs.append(F.avg(F.octet_length(F.to_json(F.struct(*tx.columns)))).alias("avg_json_bytes"))
    g = tx.agg(*aggs)
    stored = F.col("raw_bytes").cast("double") * F.lit(float(overhead)) * F.lit(replicas) / F.lit(float(compression))
    return g.withColumn("stored_bytes", stored)
