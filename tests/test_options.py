"""Scale options: input spreading, approximate distinct on a stream, RocksDB state."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import sorted_rows
from txlens.operators import merchant_window_aggregates
from txlens.operators.aggregates import merchant_window_closed
from txlens.operators.clean import clean_transactions
from txlens.plans import batch, streams
from txlens.session import scratch_path
from txlens.sources.fixtures import ensure_parallelism
from txlens.streaming.sinks import start_stream


def test_ensure_parallelism(spark, monkeypatch):
    from txlens.sources import fixtures

    path = f"{SF_SMALL}/events.parquet"
    one = spark.read.parquet(path)
    assert one.rdd.getNumPartitions() == 1
    spread = ensure_parallelism(one, path)
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert ensure_parallelism(one, "hdfs://host/events.parquet") is one
    monkeypatch.setattr(fixtures, "SPREAD_BYTES", 10)
    assert ensure_parallelism(one, path) is one


def _run(df, mode, name, **kw):
    spark = df.sparkSession
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    q = start_stream(df, name, mode, ckpt, "parquet", out, trigger={"availableNow": True}, state_partitions=2, **kw)
    q.awaitTermination(300)
    assert q.exception() is None
    return spark.read.parquet(out)


def test_stream_approx_distinct_and_rocksdb(spark):
    tx = clean_transactions(streams.stream_source(spark, SF_SMALL, n_splits=2, files_per_split=1))
    out = _run(merchant_window_aggregates(tx, exact_distinct=False), "update", "approx_rocks", state_store="rocksdb")
    from txlens.streaming.sinks import latest_per_key

    last = latest_per_key(out, ["merchant", "window_start"])
    exact = merchant_window_aggregates(batch.transactions(spark, SF_SMALL))
    cols = ["merchant", "window_start", "total_transactions", "total_amount"]
    assert sorted_rows(last, *cols) == sorted_rows(exact, *cols)
    # HLL within +-1 of exact at these small counts
    j = last.alias("a").join(exact.alias("e"), ["merchant", "window_start"])
    assert j.filter(F.abs(F.col("a.unique_users") - F.col("e.unique_users")) > 1).count() == 0


def test_stream_closed_windows_exact_distinct(spark):
    """Chained aggregates (append): exact users without a per-window set; equals the
    batch answer on the windows the watermark closed."""
    tx = clean_transactions(streams.stream_source(spark, SF_SMALL, n_splits=3, files_per_split=1))
    out = _run(merchant_window_closed(tx), "append", "bounded")
    b = batch.transactions(spark, SF_SMALL)
    max_sec = b.agg(F.max(F.unix_seconds("transaction_timestamp"))).first()[0]
    exact = merchant_window_aggregates(b).filter(F.unix_seconds("window_end") <= F.lit(max_sec - 600))
    cols = ["merchant", "window_start", "total_transactions", "total_amount", "average_amount",
            "min_amount", "max_amount", "unique_users", "currencies_used"]
    got = sorted_rows(out, *cols)
    assert len(got) > 1000 and got == sorted_rows(exact, *cols)


def test_stream_salted_join_equals_unsalted(spark):
    from txlens.operators import detect_anomalies, enrich_user_stats

    tx = clean_transactions(streams.stream_source(spark, SF_SMALL, n_splits=3, files_per_split=1))
    cols = ["transaction_id", "transaction_count", "avg_transaction_amount", "anomaly_reasons"]
    a = _run(detect_anomalies(enrich_user_stats(tx)), "append", "unsalted")
    b = _run(detect_anomalies(enrich_user_stats(tx, stream_salt_buckets=4)), "append", "salted4")
    assert b.count() > 0 and sorted_rows(a, *cols) == sorted_rows(b, *cols)


def test_cluster_conf_sizes_partitions():
    from txlens.session import cluster_conf

    c = cluster_conf(input_bytes=100 * 1024**4, total_cores=4000)  # 100 TB on 4,000 cores
    parts = int(c["spark.sql.shuffle.partitions"])
    assert parts == int(c["spark.sql.adaptive.coalescePartitions.initialPartitionNum"])
    assert 100 * 1024**4 / parts <= 128 * 1024**2  # <= 128 MB a reduce task before coalescing
    assert parts >= 12000 and c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert "RocksDB" in c["spark.sql.streaming.stateStore.providerClass"]
    small = cluster_conf(total_cores=8, rocksdb_state=False)
    assert small["spark.sql.shuffle.partitions"] == "24" and "spark.sql.streaming.stateStore.providerClass" not in small


def test_checkpoint_folder_must_be_named_on_a_cluster(monkeypatch):
    import pytest

    from txlens import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
    assert session.is_local("local[4]") and session.is_local("local") and not session.is_local("local-cluster[2,1,1024]")


def test_broadcast_side_is_measured_in_bytes(spark):
    from txlens.operators.joins import measured_size

    df = spark.createDataFrame([("x" * 5000, 1), ("y" * 3000, 2), (None, 3)], "k string, v long")
    rows, size = measured_size(df)
    assert rows == 3 and size >= 8000
