"""Test inputs derived from the supplied tables.

``transactions_from_events`` maps the ``events`` table onto the nine transaction
fields (time compressed 120x so a month becomes six hours, values scaled 20x), so
that every anomaly rule both fires and misses. By the event id, some rows get what
real logs hold and the table does not: absent ids, users, merchants, currencies, flags and
times, amounts of zero, below zero, below a cent, very large or not finite (``SPOILT``).
Pure column expressions: it scans ``events`` once, pruned to the six columns used.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from txlens.functions.columns import ntz_epoch_micros
from txlens.schema import CURRENCIES, PAYMENT_METHODS, TOPIC_PARTITIONS, TRANSACTION_TYPES
from txlens.session import local_path
from txlens.sources.envelope import to_envelope

# Fixed values of the fixture mapping: origin 2024-01-01 UTC in microseconds,
# time compression and amount scale.
FIXTURE_ORIGIN_MICROS = 1704067200000000
FIXTURE_TIME_COMPRESSION = 120
FIXTURE_AMOUNT_SCALE = 20
# What is spoilt, as (field, modulus, remainder of the event id, SQL value).
SPOILT = [
    ("transaction_id", 97, 1, "NULL"),
    ("user_id", 97, 2, "NULL"),
    ("merchant", 97, 3, "NULL"),
    ("currency", 97, 4, "NULL"),
    ("is_international", 97, 5, "NULL"),
    ("transaction_time", 97, 6, "NULL"),
    ("amount", 97, 7, "0.0"),
    ("amount", 97, 8, "-5.25"),
    ("amount", 97, 9, "0.004"),
    ("amount", 97, 10, "NULL"),
    ("amount", 997, 11, "2e17"),
    ("amount", 1999, 12, "'NaN'"),
    ("amount", 1999, 13, "'Infinity'"),
]
# Rows without an id whose message in the log is not JSON at all: every second of them.
MALFORMED = "event_id % 97 = 1 AND event_id % 2 = 1"


def spoilt(field: str, value: str, kind: str) -> str:
    """SQL (Spark's and DuckDB's) of a field with its spoilt values."""
    cases = " ".join(f"WHEN event_id % {m} = {r} THEN CAST({v} AS {kind})" for f, m, r, v in SPOILT if f == field)
    return f"CASE {cases} ELSE {value} END"


def load_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """Read a supplied table; see :func:`ensure_parallelism`."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    return ensure_parallelism(df, path) if spread else df


#: Local tables up to this size are spread over the cores after the scan.
SPREAD_BYTES = 256 * 1024 * 1024


def ensure_parallelism(df: DataFrame, path: str, min_partitions: int | None = None) -> DataFrame:
    """Spread a small local file (e.g. one row group, which Spark cannot split) over the
    cores, so row-wise work does not run in one task. Anything on another file system, or
    beyond ``SPREAD_BYTES``, is returned unchanged: no exchange is added to a large scan.
    """
    local = local_path(path)
    if local is None or not os.path.exists(local):
        return df
    files = [local] if os.path.isfile(local) else [os.path.join(d, n) for d, _, names in os.walk(local) for n in names if n[0] not in "._"]
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if sum(map(os.path.getsize, files)) > SPREAD_BYTES or len(files) >= target:
        return df
    return df.repartition(target)


def _session_is_utc(df: DataFrame) -> bool:
    # no default: Spark validates a default value as a zone id (and "" is not one)
    tz = df.sparkSession.conf.get("spark.sql.session.timeZone")
    return tz in ("UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "UTC+00:00")


def _sql_array(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def transactions_from_events(events: DataFrame, keep_id: bool = False) -> DataFrame:
    """events(event_id, ts, user_id, event_type, value, props) -> transaction fields.

    Half the rows carry ``transaction_time`` in milliseconds (+999 ms), the other
    half in seconds, so both branches of the epoch rule are exercised. ``keep_id`` adds
    ``event_id`` (the log's offset, present in every row).
    """
    ts_type = events.schema["ts"].dataType
    if not isinstance(ts_type, TimestampNTZType):
        micros = F.unix_micros("ts")
    elif _session_is_utc(events):
        # Wall clock read in a UTC session is the UTC instant: the cheap cast is exact.
        micros = F.unix_micros(F.col("ts").cast("timestamp"))
    else:
        micros = ntz_epoch_micros("ts")
    b = FIXTURE_ORIGIN_MICROS
    return (
        events.select(
            "event_id",
            "user_id",
            "event_type",
            "value",
            micros.alias("_us"),
            F.get_json_object("props", "$.k").cast("int").alias("_k"),
        )
        .selectExpr(
            "event_id",
            "cast(event_id as string) as transaction_id",
            "concat('user_', user_id) as user_id",
            f"round(value * {FIXTURE_AMOUNT_SCALE}, 2) as amount",
            f"element_at({_sql_array(CURRENCIES)}, _k % 4 + 1) as currency",
            f"({b} + (_us - {b}) div {FIXTURE_TIME_COMPRESSION}) div 1000000 as _sec",
            "event_type as merchant",
            "_k % 2 = 0 as is_international",
            f"element_at({_sql_array(TRANSACTION_TYPES)}, cast((_k div 4) % 4 + 1 as int)) as transaction_type",
            f"element_at({_sql_array(PAYMENT_METHODS)}, cast((_k div 16) % 4 + 1 as int)) as payment_method",
        )
        .selectExpr(
            spoilt("transaction_id", "transaction_id", "string") + " as transaction_id",
            spoilt("user_id", "user_id", "string") + " as user_id",
            spoilt("amount", "amount", "double") + " as amount",
            spoilt("currency", "currency", "string") + " as currency",
            spoilt("transaction_time", "CASE WHEN event_id % 2 = 0 THEN _sec ELSE _sec * 1000 + 999 END", "bigint") + " as transaction_time",
            spoilt("merchant", "merchant", "string") + " as merchant",
            spoilt("is_international", "is_international", "boolean") + " as is_international",
            "transaction_type",
            "payment_method",
            *(["event_id"] if keep_id else []),
        )
    )


def fixture_transactions(spark: SparkSession, sf_dir: str, keep_id: bool = False) -> DataFrame:
    return transactions_from_events(load_table(spark, sf_dir, "events"), keep_id)


def fixture_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture transactions as log records (offset = event id, partitions in turn), some of them malformed."""
    env = to_envelope(fixture_transactions(spark, sf_dir, keep_id=True).withColumn("offset", F.col("event_id")), offset="offset")
    env = env.withColumn("partition", F.pmod("offset", F.lit(TOPIC_PARTITIONS)).cast("int"))
    broken = F.expr(MALFORMED.replace("event_id", "offset"))
    return env.withColumn("value", F.when(broken, F.lit("{not json").cast("binary")).otherwise(F.col("value")))
