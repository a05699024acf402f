"""Message-log envelopes: the columns of Spark's Kafka source, from Kafka or from files.

No Kafka connector ships with plain PySpark, so the same envelope is also read from
and written to files (parquet by default). Everything downstream sees one shape:
``key, value, topic, partition, offset, timestamp, timestampType``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.functions.json import encode_json
from txlens.schema import (
    ENVELOPE_SCHEMA,
    SOURCE_TOPIC,
    TOPIC_PARTITIONS,
    TRANSACTION_FIELDS,
)
from txlens.session import session_conf

#: Row groups of staged files: a task holds one in memory for each split.
STAGED_BYTES = 16 << 20


def kafka_source_options(
    bootstrap_servers: str,
    topic: str = SOURCE_TOPIC,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    session_timeout_ms: int = 30000,
    request_timeout_ms: int = 40000,
    max_poll_interval_ms: int = 300000,
    streaming: bool = True,
    min_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of the Kafka source: subscribe from the earliest offset, tolerate data
    loss. ``max_offsets_per_trigger`` caps the records of a micro-batch; unset, a batch takes
    what has arrived, so a backlog never grows behind a cap (the job's own value is
    ``MAX_OFFSETS_PER_TRIGGER``).

    ``min_partitions``: Spark splits the offset range of a large topic partition
    over several tasks until there are at least this many, so a partition holding
    a third of the records (a hot key hashes to one partition) is not read by a
    single task."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "kafka.session.timeout.ms": str(session_timeout_ms),
        "kafka.request.timeout.ms": str(request_timeout_ms),
        "kafka.max.poll.interval.ms": str(max_poll_interval_ms),
    }
    if streaming and max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update(extra or {})
    return opts


def file_source_options(
    max_files_per_trigger: int | None = None,
    ignore_missing_files: bool = True,
    max_bytes_per_trigger: int | None = None,
) -> dict[str, str]:
    """File analogue of the Kafka options: admission by files or by bytes (a
    micro-batch takes whole files up to the byte cap, at least one), missing files
    tolerated."""
    opts = {"ignoreMissingFiles": str(ignore_missing_files).lower()}
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if max_bytes_per_trigger:
        opts["maxBytesPerTrigger"] = str(max_bytes_per_trigger)
    return opts


def read_envelope(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    streaming: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Subscribe to a log as an (unbounded) table of envelopes.

    ``fmt="kafka"`` uses Spark's Kafka source with ``options`` (see
    :func:`kafka_source_options`); any file format reads ``path`` with the fixed
    envelope schema (no inference), starting at the earliest file.
    """
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        return reader.format("kafka").options(**(options or {})).load()
    reader = reader.format(fmt).schema(ENVELOPE_SCHEMA).options(**(options or {}))
    return reader.load(path)


def to_envelope(
    tx: DataFrame,
    topic: str = SOURCE_TOPIC,
    partitions: int = TOPIC_PARTITIONS,
    offset: str | None = None,
    timestamp: str | None = None,
) -> DataFrame:
    """Transactions to log records: key = user_id bytes, value = JSON bytes (nulls kept,
    as a JSON serializer of the record would), partition = hash of the key.

    ``offset`` names a column that orders records within a partition (unique, not
    necessarily dense); without it a per-task increasing id is used. ``timestamp``
    names the log-append time; default: the transaction's event time.
    """
    absent = [c for c in TRANSACTION_FIELDS if c not in tx.columns]
    if absent:
        raise ValueError(f"the message needs the columns {absent}")
    key = F.col("user_id").cast("binary")
    ts = F.col(timestamp) if timestamp else _event_time_of(tx)
    off = F.col(offset).cast("long") if offset else F.monotonically_increasing_id()
    return tx.select(
        key.alias("key"),
        encode_json(*TRANSACTION_FIELDS, keep_nulls=True).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int").alias("partition"),
        off.alias("offset"),
        ts.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def _event_time_of(tx: DataFrame):
    from txlens.functions.columns import ms_or_seconds_to_timestamp

    if "transaction_timestamp" in tx.columns:
        return F.col("transaction_timestamp")
    if "transaction_time" in tx.columns:
        return ms_or_seconds_to_timestamp("transaction_time")
    return F.lit(None).cast("timestamp")


def publish_transactions(
    tx: DataFrame,
    path: str | None = None,
    fmt: str = "parquet",
    topic: str = SOURCE_TOPIC,
    partitions: int = TOPIC_PARTITIONS,
    offset: str | None = None,
    mode: str = "append",
    kafka_options: dict[str, str] | None = None,
    compression: str | None = "lz4",
) -> None:
    """Load step: write transactions as keyed JSON records.

    Kafka: ``key``/``value`` go to ``topic`` and Kafka's partitioner spreads them by
    key. Files: each task sorts its rows by (partition, offset) and writes them
    (lz4, like the topic's codec); no shuffle, so the write scales with the input's
    partitioning.
    """
    env = to_envelope(tx, topic=topic, partitions=partitions, offset=offset)
    if fmt == "kafka":
        (
            env.select("key", "value")
            .write.format("kafka")
            .options(**(kafka_options or {}))
            .option("topic", topic)
            .save()
        )
        return
    w = env.sortWithinPartitions("partition", "offset").write.mode(mode).format(fmt)
    if compression and fmt == "parquet":
        w = w.option("compression", compression)
    w.save(path)


def write_envelope_splits(
    env: DataFrame,
    path: str,
    split_col: str,
    n_splits: int,
    files_per_split: int = 2,
    fmt: str = "parquet",
) -> int:
    """Write envelopes as ``n_splits`` successive sets of files (split 0 first), each of
    exactly ``files_per_split`` files, so a file stream with
    ``maxFilesPerTrigger=files_per_split`` sees one split a micro-batch in order. The
    source is computed once, into a staging folder partitioned by split; the appends only
    copy from it. (A file source orders by modification time.) Returns files_per_split.

    A task holds a file open for every split, so that its rows need no sort by split, whose
    memory grows with the task's rows; row groups of the staged files are small instead.
    """
    spark = env.sparkSession
    staged = f"{path.rstrip('/')}-staged"
    with session_conf(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(n_splits + 1)}):  # one more for null
        env.write.partitionBy(split_col).format(fmt).option("parquet.block.size", STAGED_BYTES).save(staged)
    schema = env.schema
    for i in range(n_splits):
        part = spark.read.format(fmt).schema(schema).load(staged).filter(F.col(split_col) == i).drop(split_col)
        part.repartition(files_per_split).write.mode("append").format(fmt).save(path)
    return files_per_split
