"""What a stopped or running append-mode query still holds: windows open in its state.

An append query emits a window once, when the watermark passes its end, so the windows open
when a log ends never reach the sink. Their aggregates are in the query's state. Spark's state data
source reads the state of a committed batch from the checkpoint as a table, partition by partition,
without the query; the functions here find the operator in the checkpoint's metadata, name the
aggregation buffers and finish them as the aggregates would. Closed output and open windows together
are the batch result over everything the query read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.operators.aggregates import finish_merchant_parts
from txlens.operators.anomalies import STAT_COLUMNS, detect_anomalies
from txlens.operators.joins import join_small_side
from txlens.session import scratch_path

AGGREGATE, JOIN = "stateStoreSave", "symmetricHashJoin"


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operatorId, operatorName, stateStoreName, numPartitions, minBatchId, maxBatchId) of a checkpoint."""
    return spark.read.format("state-metadata").load(checkpoint)


def operator_ids(spark: SparkSession, checkpoint: str, name: str) -> list[int]:
    """Ids of the stateful operators of one kind; Spark numbers them from the sink back."""
    rows = state_operators(spark, checkpoint).where(F.col("operatorName") == name).select("operatorId").distinct().collect()
    return sorted(r["operatorId"] for r in rows)


def read_state(
    spark: SparkSession, checkpoint: str, operator_id: int = 0, join_side: str | None = None, batch_id: int | None = None
) -> DataFrame:
    """(key, value, partition_id) of one operator after its last committed batch, or after ``batch_id``."""
    r = spark.read.format("statestore").option("operatorId", str(operator_id))
    if join_side:
        r = r.option("joinSide", join_side)
    if batch_id is not None:
        r = r.option("batchId", str(batch_id))
    return r.load(checkpoint)


def _buffers(state: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """The state's keys and buffers under names of our own: Spark's buffer names repeat."""
    own = [f.name for f in state.schema["key"].dataType.fields]
    if own != keys:
        raise ValueError(f"the state is keyed by {own}, not {keys}")
    fields = state.schema["value"].dataType.fields
    if len(fields) != len(names):
        raise ValueError(f"the state holds the buffers {[f.name for f in fields]}, not {names}")
    return state.select("key.*", "value.*").toDF(*keys, *names)


def open_user_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Open windows of a ``user_window_stats`` query, with its columns."""
    (op,) = operator_ids(spark, checkpoint, AGGREGATE)
    names = ["_n", "_sum", "_avg_sum", "_avg_n", "_sd_n", "_sd_mean", "_sd_m2", "_max"]
    s = _buffers(read_state(spark, checkpoint, op, batch_id=batch_id), ["user_id", "window"], names)
    return s.select(
        "user_id",
        "window",
        F.col("_n").alias("transaction_count"),
        F.col("_sum").alias("total_spent"),
        F.try_divide(F.col("_avg_sum"), F.col("_avg_n").cast("double")).alias("avg_transaction_amount"),
        F.when(F.col("_sd_n") > 1, F.sqrt(F.col("_sd_m2") / (F.col("_sd_n") - 1))).alias("stddev_amount"),
        F.col("_max").alias("max_amount_in_window"),
    )


def open_merchant_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Open windows of a ``merchant_window_closed(..., readable_state=True)`` query, with its columns.

    The first aggregate's state, the operator farthest from the sink, holds all open parts."""
    op = operator_ids(spark, checkpoint, AGGREGATE)[-1]
    names = ["_n", "_total", "_n_amount", "_min", "_max"]
    parts = _buffers(read_state(spark, checkpoint, op, batch_id=batch_id), ["merchant", "window", "user_id", "currency"], names)
    return finish_merchant_parts(parts)


def open_anomalies(spark: SparkSession, checkpoint: str, batch_id: int | None = None, **rule_params) -> DataFrame:
    """Anomalies as of now in the open windows of an anomaly query: transactions that its join still
    holds back, with the statistics of their windows so far. Provisional: later transactions of
    a window change its statistics."""
    (stats_op,) = operator_ids(spark, checkpoint, AGGREGATE)
    (join_op,) = operator_ids(spark, checkpoint, JOIN)
    stats = _buffers(read_state(spark, checkpoint, stats_op, batch_id=batch_id), ["user_id", "window"], ["transaction_count", "_sum", "_n"])
    stats = stats.where("user_id IS NOT NULL").select("user_id", "window", "transaction_count", F.try_divide("_sum", F.col("_n").cast("double")).alias("avg_transaction_amount"))
    held = read_state(spark, checkpoint, join_op, "left", batch_id).select("value.*")
    # rows of windows that closed may stay a while in the join's state; they were emitted
    windows = read_state(spark, checkpoint, stats_op, batch_id=batch_id).select("key.window").distinct()
    held = held.join(F.broadcast(windows), "window", "left_semi")
    columns = [c for c in held.columns if c not in ("window", "_event_us", "_salt")]
    joined = join_small_side(held, stats, ["user_id", "window"], "left", name="open-stats", count_col="transaction_count", salt_cols=["transaction_id", "amount", "_event_us"])
    rows = joined.select(*columns, F.timestamp_micros("_event_us").alias("transaction_timestamp"), *STAT_COLUMNS)
    return detect_anomalies(rows, **rule_params)


def with_open(closed: DataFrame, open_: DataFrame, keys: list[str], start: str) -> DataFrame:
    """Closed and open rows together. A sink may be one batch ahead of the committed state (its files are
    committed first): what it emitted counts, so open rows of such keys go. Only closed rows from the
    first open ``start`` on are compared. The open rows are written to the scratch folder, so that the state
    is read once."""
    path = scratch_path(open_.sparkSession, "open")
    open_.write.parquet(path)
    open_ = open_.sparkSession.read.schema(open_.schema).parquet(path)
    first = open_.agg(F.min(start)).first()[0]
    if first is None:
        return closed.select(*open_.columns)
    emitted = closed.where(F.col(start) >= F.lit(first)).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return closed.select(*open_.columns).unionByName(open_.join(emitted, same, "left_anti"))
