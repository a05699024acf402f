"""T7: plan shape -- no Python UDFs, pushdown and pruning, one shuffle-free enrichment."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from txlens.operators import detect_anomalies, enrich_user_stats, merchant_window_aggregates, user_window_stats
from txlens.plans import batch


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs(spark):
    import __spark_entry__ as se

    for name, fn in se.queries().items():
        if "stream" in name or not fn.__module__.startswith("txlens.plans."):
            continue
        p = _plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p, name


def test_enrichment_does_not_shuffle_transactions(spark):
    an = detect_anomalies(enrich_user_stats(batch.transactions(spark, SF_SMALL)))
    p = _plan(an)
    assert "BroadcastHashJoin" in p
    # only the statistics side (read back from its written table) is broadcast; no exchange on the big side
    assert "Exchange hashpartitioning" not in p


def test_scan_is_pruned(spark):
    import re

    df = user_window_stats(batch.transactions(spark, SF_SMALL)).select("user_id", "transaction_count")
    p = _plan(df)
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", p).group(1)
    # only what the statistics need: id (validity), time, user, value (amount)
    assert "props" not in schema and "event_type" not in schema, schema
    assert "PushedFilters: [" in p
    fp = df._jdf.queryExecution().optimizedPlan().toString()
    # unused statistics (stddev, max) are pruned from the aggregate
    assert "stddev" not in fp and "max(" not in fp


def test_merchant_batch_expands_reduced_rows_only(spark):
    """No distinct aggregate (Expand), and windows are made of rows reduced per pane: of users, at
    most five per (merchant, user, pane), and one for each window that a user enters."""
    import re

    tx = batch.transactions(spark, SF_SMALL)
    p = _plan(merchant_window_aggregates(tx))
    assert "Expand" not in p and "Generate" in p
    # plan text is top-down: below every expansion stands an aggregate by pane
    for at in (m.start() for m in re.finditer("Generate explode", p)):
        assert re.search(r"_pane#\d+", p[at:]) and "HashAggregate(keys=[merchant#" in p[at:]
    timed = tx.where("transaction_timestamp IS NOT NULL AND user_id IS NOT NULL")
    seen = timed.selectExpr("merchant", "user_id", "unix_seconds(transaction_timestamp) div 60 AS pane").distinct().count()
    entered = merchant_window_aggregates(tx).agg(F.sum("unique_users")).first()[0]
    assert seen <= entered <= 5 * seen


def test_large_scans_are_not_dealt_anew(spark, tmp_shared, monkeypatch):
    from txlens.sources import fixtures
    from txlens.sources.envelope import read_envelope

    spark.range(1000).coalesce(1).write.parquet(f"{tmp_shared}/t.parquet")
    assert "RoundRobinPartitioning" in _plan(fixtures.load_table(spark, tmp_shared, "t"))
    monkeypatch.setattr(fixtures, "SPREAD_BYTES", 10)
    assert "RoundRobinPartitioning" not in _plan(fixtures.load_table(spark, tmp_shared, "t"))
    fixtures.fixture_envelope(spark, SF_SMALL).write.parquet(f"{tmp_shared}/log")
    assert "RoundRobinPartitioning" not in _plan(read_envelope(spark, f"{tmp_shared}/log"))


def test_stream_plans_have_no_python_udfs(spark):
    from txlens.operators import detect_anomalies, enrich_user_stats
    from txlens.operators.aggregates import merchant_window_buckets, merchant_window_closed
    from txlens.operators.clean import clean_transactions, parse_transactions, valid_transactions, with_event_time
    from txlens.session import scratch_path
    from txlens.sources.envelope import read_envelope

    folder = scratch_path(spark, "plan-src")
    import os

    from txlens.session import local_path

    os.makedirs(local_path(folder), exist_ok=True)
    tx = clean_transactions(read_envelope(spark, folder, streaming=True))
    plans = [
        merchant_window_aggregates(tx),
        merchant_window_aggregates(tx, exact_distinct=False),
        merchant_window_buckets(tx, 4),
        merchant_window_closed(tx),
        detect_anomalies(enrich_user_stats(tx)),
        detect_anomalies(enrich_user_stats(tx, stream_salt_buckets=4)),
        valid_transactions(with_event_time(parse_transactions(read_envelope(spark, folder, streaming=True)))),
    ]
    for df in plans:
        assert df.isStreaming
        p = df._jdf.queryExecution().analyzed().toString()
        assert "PythonUDF" not in p and "EvalPython" not in p and "lambdafunction" not in p


def test_broadcast_needs_both_bounds(spark):
    """A side within the row bound but over the byte bound is shuffle-joined."""
    from txlens.operators.joins import join_small_side

    big = spark.range(0, 1000).withColumnRenamed("id", "k")
    small = spark.range(0, 100).withColumnRenamed("id", "k").withColumn("v", F.lit("x"))
    fits = join_small_side(big, small, ["k"], max_rows=1000, max_bytes=10**6, name="fits")
    too_wide = join_small_side(big, small, ["k"], max_rows=1000, max_bytes=1000, name="wide")
    assert "BroadcastHashJoin" in _plan(fits)
    assert "BroadcastHashJoin" not in _plan(too_wide) and "SortMergeJoin" in _plan(too_wide)
    assert fits.count() == too_wide.count() == 1000
