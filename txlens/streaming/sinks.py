"""Stream sinks: Kafka, files (append), and versioned micro-batch files (update mode)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txlens.session import session_conf


def kafka_sink_options(bootstrap_servers: str, topic: str, extra: dict[str, str] | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    opts.update(extra or {})
    return opts


def versioned_batch_writer(path: str, fmt: str = "parquet"):
    """foreachBatch function writing micro-batch N to ``path/batch_id=N`` (overwrite),
    so a replayed batch after a failure replaces its own output: exactly once.

    Used where a file sink is wanted for update-mode output, which Spark's file sink
    does not accept."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write


def start_stream(
    df: DataFrame,
    name: str,
    mode: str,
    checkpoint: str,
    fmt: str = "parquet",
    path: str | None = None,
    options: dict[str, str] | None = None,
    trigger: dict | None = None,
    state_partitions: int | None = None,
    state_store: str | None = None,
) -> StreamingQuery:
    """Start a named query with its own checkpoint.

    ``fmt="kafka"``: key/value records to ``options['topic']``. File formats in
    ``append`` mode use Spark's file sink; in ``update`` mode a versioned
    foreachBatch writer. ``state_partitions`` fixes the number of state partitions
    (fixed for the life of the checkpoint); ``state_store="rocksdb"`` keeps large
    state off the JVM heap.
    """
    w = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
    if fmt == "kafka":
        w = w.format("kafka").options(**(options or {}))
    elif fmt == "memory":
        w = w.format("memory")
    elif mode == "append":
        w = w.format(fmt).options(**(options or {})).option("path", path)
    else:
        w = w.foreachBatch(versioned_batch_writer(path, fmt))
    if trigger:
        w = w.trigger(**trigger)
    conf: dict[str, str | None] = {}
    if state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    if state_store == "rocksdb":
        conf["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        )
    with session_conf(df.sparkSession, conf):
        return w.start()


def latest_per_key(updates: DataFrame, keys: list[str], version: str = "batch_id") -> DataFrame:
    """Collapse update-mode emissions to the last one per key (highest ``version``).

    A partial-aggregatable ``max_by``: each key has at most one row per micro-batch
    that touched it."""
    cols = [c for c in updates.columns if c not in keys and c != version]
    g = updates.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col(version)).alias("_last"))
    return g.select(*keys, "_last.*")
