"""Session construction and the shared scratch folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str | None = "local[*]",
    app_name: str = "txlens",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with UTC time, AQE on and shuffle partitions sized for the caller.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones in batch jobs).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(
    total_cores: int,
    input_bytes: int | None = None,
    partition_mb: int = 128,
    rocksdb_state: bool = True,
) -> dict[str, str]:
    """Settings for large runs, to pass as ``build_session(master=None, extra=...)``.

    Shuffle partitions start at max(3 x cores, input / partition_mb) so each reduce
    task handles about ``partition_mb`` and fits in memory without heavy spill; AQE
    coalesces what turns out small and splits skewed join partitions. Scans are cut
    into ``partition_mb`` splits. Large streaming state goes to RocksDB.
    """
    mb = 1024 * 1024
    parts = 3 * total_cores
    if input_bytes:
        parts = max(parts, int(input_bytes // (partition_mb * mb)) + 1)
    conf = {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": f"{partition_mb}m",
        "spark.sql.session.timeZone": "UTC",
    }
    if rocksdb_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        )
    return conf


def size_session(spark: SparkSession, input_bytes: int | None = None) -> None:
    """Apply :func:`cluster_conf` for the cores that the running cluster offers."""
    for k, v in cluster_conf(spark.sparkContext.defaultParallelism, input_bytes).items():
        spark.conf.set(k, v)


@contextlib.contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str | None]):
    """Temporarily set session options (a stream copies them when it starts)."""
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            if v is not None:
                spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def is_local(master: str) -> bool:
    """Whether driver and executors share one machine (and its folders)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session. Only in a local session without it (tests) a folder of our own
    is created and registered; on a cluster its absence is an error, since a
    machine-local folder is not seen by other machines and is lost with them.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            # getCheckpointDir adds a per-application subfolder; use its parent.
            return current.rsplit("/", 1)[0]
        if not is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="txlens-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder (never machine-local)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/txlens/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str | None:
    """Plain filesystem path for ``file:`` or scheme-less paths, else None."""
    if path.startswith("file:"):
        return path[len("file:"):].replace("///", "/", 1) if path.startswith("file:///") else path[5:]
    if "://" in path:
        return None
    return os.path.abspath(path)
