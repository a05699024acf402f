"""The two continuous queries over one parsed transaction stream.

1. MerchantAggregates: merchant x 5-minute windows sliding by 1 minute, update mode.
2. AnomalyDetection: transactions joined to their user's 30-minute statistics,
   three rules, reasons array; append mode (chained aggregate -> join).
Both publish keyed JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txlens.functions.columns import interval_seconds
from txlens.operators.aggregates import merchant_window_aggregates, merchant_window_buckets, merchant_window_closed, merge_buckets
from txlens.operators.clean import parse_transactions, valid_transactions, with_event_time, with_watermark
from txlens.operators.anomalies import detect_anomalies, enrich_user_stats
from txlens.operators.encode import encode_aggregates, encode_anomalies
from txlens.schema import (
    AGGREGATES_QUERY_NAME,
    AGGREGATES_TOPIC,
    ANOMALIES_QUERY_NAME,
    CLOSED_WINDOWS_QUERY_NAME,
    LANDED_SCHEMA,
    LANDING_QUERY_NAME,
    ANOMALIES_TOPIC,
    MERCHANT_SLIDE,
    MERCHANT_WINDOW,
    STATE_SHUFFLE_PARTITIONS,
    USER_WINDOW,
    WATERMARK_DELAY,
)
from txlens.streaming.parts import FANOUT, PartsTable
from txlens.streaming.sinks import session_conf, start_stream


def start_landing(
    envelope: DataFrame,
    path: str,
    checkpoint: str,
    name: str = LANDING_QUERY_NAME,
    trigger: dict | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Parse each message once, add event time, keep valid rows, append them to a
    columnar table. Stateless: no shuffle, no state; exactly once through the file
    sink's commit log."""
    tx = valid_transactions(with_event_time(parse_transactions(envelope)))
    return start_stream(tx, name, "append", checkpoint, fmt, path, trigger=trigger)


def read_landed(
    spark: SparkSession,
    path: str,
    delay: str = WATERMARK_DELAY,
    max_files_per_trigger: int | None = None,
    fmt: str = "parquet",
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Subscribe to the landed transactions (only committed files are read), with the
    event-time watermark; the input of both continuous queries."""
    r = spark.readStream.format(fmt).schema(LANDED_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return with_watermark(r.load(path), delay=delay)


def merchant_aggregates_output(
    tx: DataFrame,
    window: str = MERCHANT_WINDOW,
    slide: str = MERCHANT_SLIDE,
    exact_distinct: bool = True,
) -> DataFrame:
    return encode_aggregates(merchant_window_aggregates(tx, window, slide, exact_distinct))


def anomalies_output(
    tx: DataFrame, window: str = USER_WINDOW, salt_buckets: int = 1, hot_users: list[str] | None = None, **rule_params
) -> DataFrame:
    enriched = enrich_user_stats(tx, window, stream_salt_buckets=salt_buckets, stream_hot_users=hot_users)
    return encode_anomalies(detect_anomalies(enriched, **rule_params))


def start_merchant_aggregates(
    tx: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    path: str | None = None,
    options: dict[str, str] | None = None,
    name: str = AGGREGATES_QUERY_NAME,
    trigger: dict | None = None,
    state_partitions: int | None = STATE_SHUFFLE_PARTITIONS,
    encoded: bool = True,
    **kw,
) -> StreamingQuery:
    """Update mode: every micro-batch emits the (merchant, window) groups it changed."""
    if fmt == "kafka":
        options = {"topic": AGGREGATES_TOPIC, **(options or {})}
    out = merchant_aggregates_output(tx, **kw) if encoded else merchant_window_aggregates(tx, **kw)
    return start_stream(out, name, "update", checkpoint, fmt, path, options, trigger, state_partitions)


def start_merchant_aggregates_bucketed(
    tx: DataFrame,
    checkpoint: str,
    parts_path: str,
    buckets: int,
    fmt: str = "kafka",
    path: str | None = None,
    options: dict[str, str] | None = None,
    name: str = AGGREGATES_QUERY_NAME,
    trigger: dict | None = None,
    state_partitions: int | None = STATE_SHUFFLE_PARTITIONS,
    fanout: int = FANOUT,
) -> StreamingQuery:
    """The same query with a merchant's users spread over ``buckets`` state rows.

    Update mode over (merchant, window, bucket): a micro-batch's changed parts are kept
    in a compacted table in ``parts_path``, and the groups it touched are emitted merged from
    the latest part of each of their buckets."""
    if fmt == "kafka":
        options = {"topic": AGGREGATES_TOPIC, **(options or {})}
    write = merged_batch_writer(parts_path, fmt, path, options, fanout=fanout)
    w = merchant_window_buckets(tx, buckets).writeStream.queryName(name).outputMode("update")
    w = w.option("checkpointLocation", checkpoint).foreachBatch(write)
    if trigger:
        w = w.trigger(**trigger)
    conf = {"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {}
    with session_conf(tx.sparkSession, conf):
        return w.start()


BUCKET_KEYS = ["merchant", "window_start", "window_end", "bucket"]
#: Batches between removals of segments that nothing names any more.
VACUUM_EVERY = 50


def merged_batch_writer(
    parts_path: str, fmt: str, path: str | None, options: dict[str, str] | None, delay: str = WATERMARK_DELAY, fanout: int = FANOUT
):
    """foreachBatch function of the bucketed query: the batch's parts go to a :class:`PartsTable`,
    and the groups it touched come out merged from the latest part of each of their buckets. A batch
    that is played again finds its parts committed and replaces its own output files."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = PartsTable(spark, parts_path, BUCKET_KEYS, interval_seconds(delay), fanout)
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
        segment = table.write_segment(rows, 0, batch_id, batch_id)
        table.commit(segment, batch_id)
        if segment is None:
            return
        # the segment itself stays readable until a later vacuum, also where a merge took it in
        touched = spark.read.schema(rows.schema).parquet(segment.path).select("merchant", "window_start").distinct()
        keys = touched.withColumnsRenamed({"merchant": "_m", "window_start": "_w"})
        same = F.col("merchant").eqNullSafe(F.col("_m")) & (F.col("window_start") == F.col("_w"))
        parts = table.read(rows.schema, since=segment.low).join(keys, same, "left_semi")
        out = encode_aggregates(merge_buckets(parts))
        if fmt == "kafka":
            out.write.format("kafka").options(**(options or {})).save()
        else:
            out.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")
        if batch_id and batch_id % VACUUM_EVERY == 0:
            table.vacuum()

    return write


def start_closed_merchant_windows(
    tx: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    path: str | None = None,
    options: dict[str, str] | None = None,
    name: str = CLOSED_WINDOWS_QUERY_NAME,
    trigger: dict | None = None,
    state_partitions: int | None = STATE_SHUFFLE_PARTITIONS,
) -> StreamingQuery:
    """A query of its own: append mode, each merchant window once, when the watermark closes it."""
    if fmt == "kafka":
        options = {"topic": AGGREGATES_TOPIC, **(options or {})}
    out = encode_aggregates(merchant_window_closed(tx))
    return start_stream(out, name, "append", checkpoint, fmt, path, options, trigger, state_partitions)


def start_anomaly_detection(
    tx: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    path: str | None = None,
    options: dict[str, str] | None = None,
    name: str = ANOMALIES_QUERY_NAME,
    trigger: dict | None = None,
    state_partitions: int | None = STATE_SHUFFLE_PARTITIONS,
    encoded: bool = True,
    **kw,
) -> StreamingQuery:
    """Append mode: a transaction is emitted once, when its window's statistics are final."""
    if fmt == "kafka":
        options = {"topic": ANOMALIES_TOPIC, **(options or {})}
    window = kw.pop("window", USER_WINDOW)
    salt, hot = kw.pop("salt_buckets", 1), kw.pop("hot_users", None)
    out = (
        anomalies_output(tx, window, salt, hot, **kw)
        if encoded
        else detect_anomalies(enrich_user_stats(tx, window, stream_salt_buckets=salt, stream_hot_users=hot), **kw)
    )
    return start_stream(out, name, "append", checkpoint, fmt, path, options, trigger, state_partitions)


def await_any_then_stop(spark: SparkSession, queries: list[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until any query ends (or ``timeout`` seconds, or Ctrl+C), then stop all."""
    try:
        if timeout is None:
            spark.streams.awaitAnyTermination()
        else:
            spark.streams.awaitAnyTermination(timeout)
    except KeyboardInterrupt:
        pass
    finally:
        for q in queries:
            q.stop()
