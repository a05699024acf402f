"""Streaming queries run to completion over a file log derived from ``events``.

The fixture transactions are published as JSON envelopes in time-ordered splits
(one micro-batch each, ``maxFilesPerTrigger``), the stream is parsed, watermarked and
validated, and each query runs with ``availableNow`` into its own folder under the
shared checkpoint folder. The returned DataFrame reads that output back.

Results follow the streaming semantics: update mode gives the last emission per key
(equal to the batch answer when nothing is late); append mode gives only what the
watermark closed, i.e. windows ending at or before max(event time) - 10 minutes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txlens.operators.aggregates import (
    merchant_window_aggregates,
    merchant_window_buckets,
    merchant_window_closed,
    merge_buckets,
    user_window_stats,
)
from txlens.operators.anomalies import detect_anomalies, enrich_user_stats
from txlens.operators.clean import clean_transactions
from txlens.operators.sketches import merchant_pane_sketches
from txlens.plans.batch import LATE_SPLITS, _anomaly_view, _merchant_view, _sketch_view, _user_view, late_arrivals, transactions
from txlens.session import scratch_path
from txlens.sources.envelope import file_source_options, read_envelope, write_envelope_splits
from txlens.sources.fixtures import fixture_envelope
from txlens.streaming.hot import HotUsers, start_hot_users
from txlens.streaming.queries import read_landed, start_landing, start_merchant_aggregates_bucketed
from txlens.streaming.sinks import latest_per_key, start_stream
from txlens.streaming.state import open_anomalies, open_merchant_windows, open_user_windows, with_open

N_SPLITS = 4


def stream_source(spark: SparkSession, sf_dir: str, n_splits: int = N_SPLITS, files_per_split: int | None = None) -> DataFrame:
    """Publish the fixture transactions as ``n_splits`` time-ordered file batches and
    subscribe to them as a stream of envelopes. Every call writes a log of its own, so a
    query's time holds the time of its log."""
    files_per_split = files_per_split or spark.sparkContext.defaultParallelism
    path = publish_log(spark, sf_dir, n_splits, files_per_split)
    return read_envelope(spark, path, streaming=True, options=file_source_options(max_files_per_trigger=files_per_split))


def publish_log(spark: SparkSession, sf_dir: str, n_splits: int = N_SPLITS, files_per_split: int | None = None) -> str:
    """Write the fixture transactions as envelopes in ``n_splits`` time-ordered appends."""
    files_per_split = files_per_split or spark.sparkContext.defaultParallelism
    env = fixture_envelope(spark, sf_dir)
    sec = F.unix_seconds("timestamp")
    lo, hi = env.agg(F.min(sec), F.max(sec)).first()
    span = max(1, (hi or 0) - (lo or 0) + 1)
    split = F.least(F.floor((sec - F.lit(lo)) * F.lit(n_splits) / F.lit(span)), F.lit(n_splits - 1)).cast("int")
    split = F.coalesce(split, F.pmod("offset", F.lit(n_splits)).cast("int"))  # records without a time arrive at any time
    path = scratch_path(spark, "log")
    write_envelope_splits(env.withColumn("_split", split), path, "_split", n_splits, files_per_split)
    return path


def state_partitions(spark: SparkSession) -> int:
    """State partitions for these runs: the session's shuffle partitions, capped at
    the cluster's parallelism (each stateful task per micro-batch has a fixed cost)."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def _finish(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


def _run(df: DataFrame, name: str, mode: str) -> str:
    return _run_kept(df, name, mode)[0]


def _run_kept(df: DataFrame, name: str, mode: str) -> tuple[str, str]:
    """Output folder and checkpoint of the finished query."""
    spark = df.sparkSession
    out = scratch_path(spark, f"{name}-out")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    _finish(
        start_stream(
            df, name, mode, ckpt, "parquet", out, trigger={"availableNow": True}, state_partitions=state_partitions(spark)
        )
    )
    return out, ckpt


def q_merchant_aggregates_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = clean_transactions(stream_source(spark, sf_dir))
    out = _run(merchant_window_aggregates(tx), "merchant_aggregates", "update")
    last = latest_per_key(spark.read.parquet(out), ["merchant", "window_start"])
    return _merchant_view(last)


def q_merchant_aggregates_stream_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same aggregates with state per bucket of users, merged from the latest parts."""
    tx = clean_transactions(stream_source(spark, sf_dir))
    out = _run(merchant_window_buckets(tx, 8), "merchant_buckets", "update")
    last = latest_per_key(spark.read.parquet(out), ["merchant", "window_start", "window_end", "bucket"])
    return _merchant_view(merge_buckets(last))


def q_merchant_aggregates_stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bucketed query as it runs: parts in the compacted table, merged groups published as JSON by every
    micro-batch; the last record of each (merchant, window)."""
    tx = clean_transactions(stream_source(spark, sf_dir, n_splits=8))
    out, parts, ckpt = (scratch_path(spark, f"merchant-compacted-{n}") for n in ("out", "parts", "ckpt"))
    _finish(
        start_merchant_aggregates_bucketed(
            tx, ckpt, parts, 8, "parquet", out, name="merchant_compacted", trigger={"availableNow": True}, state_partitions=state_partitions(spark), fanout=4
        )
    )
    schema = merchant_window_aggregates(tx).schema
    rows = spark.read.option("basePath", out).parquet(f"{out}/batch_id=*")
    rows = rows.select(F.from_json("value", schema).alias("v"), "batch_id").select("v.*", "batch_id")
    return _merchant_view(latest_per_key(rows, ["merchant", "window_start"]))


def q_merchant_windows_closed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: only windows that the watermark closed; those open at the log's end are not
    emitted."""
    tx = clean_transactions(stream_source(spark, sf_dir))
    out = _run(merchant_window_closed(tx), "merchant_closed", "append")
    return _merchant_view(spark.read.parquet(out))


def q_user_window_stats_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: only windows that the watermark closed; those open at the log's end are not
    emitted."""
    tx = clean_transactions(stream_source(spark, sf_dir))
    out = _run(user_window_stats(tx), "user_window_stats", "append")
    return _user_view(spark.read.parquet(out))


def q_anomalies_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: transactions of windows that the watermark closed (and those without event
    time); those of windows open at the log's end are not emitted."""
    tx = clean_transactions(stream_source(spark, sf_dir))
    out = _run(detect_anomalies(enrich_user_stats(tx)), "anomalies", "append")
    return _anomaly_view(spark.read.parquet(out))


def q_anomalies_stream_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with each user's buffered transactions spread over eight state partitions."""
    tx = clean_transactions(stream_source(spark, sf_dir))
    out = _run(detect_anomalies(enrich_user_stats(tx, stream_salt_buckets=8)), "anomalies_salted", "append")
    return _anomaly_view(spark.read.parquet(out))


def q_anomalies_stream_hot_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with only the frequent users spread, as a summary kept over the log's batches names them."""
    path = publish_log(spark, sf_dir)
    options = file_source_options(max_files_per_trigger=spark.sparkContext.defaultParallelism)
    tx = clean_transactions(read_envelope(spark, path, streaming=True, options=options))
    folder = scratch_path(spark, "hot-users")
    _finish(start_hot_users(tx, scratch_path(spark, "hot-users-ckpt"), folder, trigger={"availableNow": True}))
    hot = HotUsers(spark, folder).grown()
    out = _run(detect_anomalies(enrich_user_stats(tx, stream_salt_buckets=8, stream_hot_users=hot)), "anomalies_hot", "append")
    return _anomaly_view(spark.read.parquet(out))


def q_anomalies_stream_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over the table that a landing query parses each message into once."""
    landed = scratch_path(spark, "landed")
    _finish(start_landing(stream_source(spark, sf_dir), landed, scratch_path(spark, "landing-ckpt"), trigger={"availableNow": True}))
    tx = read_landed(spark, landed, max_files_per_trigger=spark.sparkContext.defaultParallelism)
    out = _run(detect_anomalies(enrich_user_stats(tx)), "anomalies_landed", "append")
    return _anomaly_view(spark.read.parquet(out))


# ---- closed output and open state together: the batch result ---------------------------------


def q_merchant_window_user_sketches_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketches of ``merchant_window_user_sketches`` kept by a stream, one state row per merchant and
    pane, in update mode; windows are united from the last emission of each pane."""
    tx = clean_transactions(stream_source(spark, sf_dir))
    out = _run(merchant_pane_sketches(tx), "merchant_sketches", "update")
    panes = latest_per_key(spark.read.parquet(out), ["merchant", "pane_start"])
    return _sketch_view(transactions(spark, sf_dir), panes)


def q_user_windows_late_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User windows of a log whose records partly come late: what the stream counts before a window closes."""
    env = late_arrivals(fixture_envelope(spark, sf_dir), "offset", "timestamp")
    path = scratch_path(spark, "late-log")
    files = spark.sparkContext.defaultParallelism
    write_envelope_splits(env, path, "batch", LATE_SPLITS, files)
    tx = clean_transactions(read_envelope(spark, path, streaming=True, options=file_source_options(max_files_per_trigger=files)))
    out = _run(user_window_stats(tx), "user_windows_late", "append")
    return spark.read.parquet(out).select("user_id", F.unix_seconds("window.start").alias("window_start"), "transaction_count")


def q_user_windows_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All user windows of an append query over the log: those it emitted, and those its state holds open."""
    tx = clean_transactions(stream_source(spark, sf_dir))
    out, ckpt = _run_kept(user_window_stats(tx), "user_windows_open", "append")
    both = with_open(spark.read.parquet(out), open_user_windows(spark, ckpt), ["user_id", "window"], "window.start")
    return _user_view(both)


def q_merchant_windows_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = clean_transactions(stream_source(spark, sf_dir))
    out, ckpt = _run_kept(merchant_window_closed(tx, readable_state=True), "merchant_open", "append")
    both = with_open(spark.read.parquet(out), open_merchant_windows(spark, ckpt), ["merchant", "window_start"], "window_start")
    return _merchant_view(both)


def q_anomalies_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies emitted, and those that the statistics so far give in the windows still open."""
    tx = clean_transactions(stream_source(spark, sf_dir))
    out, ckpt = _run_kept(detect_anomalies(enrich_user_stats(tx)), "anomalies_open", "append")
    both = with_open(spark.read.parquet(out), open_anomalies(spark, ckpt), ["transaction_id", "transaction_timestamp"], "transaction_timestamp")
    return _anomaly_view(both)
