"""Open windows from a query's state: closed output and state together are the batch result."""

import pytest
from pyspark.sql import functions as F

from helpers import sorted_rows
from test_streaming import T0, _run_available, _stream, _tx, _write_batch
from txlens.operators.aggregates import merchant_window_aggregates, merchant_window_closed, user_window_stats
from txlens.operators.anomalies import detect_anomalies, enrich_user_stats
from txlens.operators.clean import clean_transactions
from txlens.session import scratch_path
from txlens.sources.envelope import read_envelope
from txlens.streaming import state
from txlens.streaming.sinks import start_stream


@pytest.fixture(scope="module")
def log(spark):
    """Three files; the last two windows stay open. Null users, merchants, currencies and times occur."""
    src = scratch_path(spark, "state-src")
    n = 0
    for i in range(3):
        recs = []
        for j in range(40):
            extra = {"currency": [None, "USD", "EUR"][j % 3], "merchant": ["A", None, "B"][j % 3 - j % 2]}
            t = None if j == 7 else T0 + i * 2400 + j * 50
            recs.append(_tx(n, None if j % 11 == 0 else f"u{j % 4}", t, 5.0 + j * (90 if j % 9 == 0 else 1), is_international=j % 2 == 0, **extra))
            n += 1
        _write_batch(src, i, recs)
    return src


def batch(spark, log):
    return clean_transactions(read_envelope(spark, log))


USER = ["user_id", "window", "transaction_count", "total_spent", "avg_transaction_amount", "stddev_amount", "max_amount_in_window"]


def test_user_windows(spark, log):
    out, ckpt = scratch_path(spark, "s-out"), scratch_path(spark, "s-ckpt")
    _run_available(user_window_stats(_stream(spark, log)), "append", out, ckpt, "state_users")
    closed, open_ = spark.read.parquet(out), state.open_user_windows(spark, ckpt)
    want = user_window_stats(batch(spark, log))
    assert 0 < closed.count() < want.count() and open_.count() == want.count() - closed.count()
    both = state.with_open(closed, open_, ["user_id", "window"], "window.start")
    assert sorted_rows(both, *USER) == sorted_rows(want, *USER)
    # a sink one batch ahead of the state: what it emitted is not doubled
    ahead = closed.unionByName(open_.limit(2))
    assert state.with_open(ahead, open_, ["user_id", "window"], "window.start").count() == want.count()


def test_state_of_an_earlier_batch(spark, log):
    out, ckpt = scratch_path(spark, "e-out"), scratch_path(spark, "e-ckpt")
    _run_available(user_window_stats(_stream(spark, log)), "append", out, ckpt, "state_earlier")
    first = state.open_user_windows(spark, ckpt, batch_id=0)
    rows = spark.read.parquet(f"{log}/batch-000.parquet")
    assert sorted_rows(first, *USER) == sorted_rows(user_window_stats(clean_transactions(rows)), *USER)


def test_merchant_windows(spark, log):
    out, ckpt = scratch_path(spark, "m-out"), scratch_path(spark, "m-ckpt")
    _run_available(merchant_window_closed(_stream(spark, log), readable_state=True), "append", out, ckpt, "state_merchants")
    closed = spark.read.parquet(out)
    want = merchant_window_aggregates(batch(spark, log))
    both = state.with_open(closed, state.open_merchant_windows(spark, ckpt), ["merchant", "window_start"], "window_start")
    assert closed.count() < both.count()
    assert "StateTable" not in both._jdf.queryExecution().toString()  # the state was read once, before
    assert sorted_rows(both, *want.columns) == sorted_rows(want, *want.columns)


def test_users_of_closed_merchant_windows_are_aggregated_once(spark):
    """Only the first state has a row per user; those after it, one per merchant, window and currency at most."""
    src = scratch_path(spark, "u-src")
    _write_batch(src, 0, [_tx(i, f"u{i % 200}", T0 + i % 120, currency=["USD", "EUR", None][i % 3]) for i in range(600)])
    for i in (1, 2):
        _write_batch(src, i, [_tx(1000 + i, "u", T0 + 9000 * i)])
    out, ckpt = scratch_path(spark, "u-out"), scratch_path(spark, "u-ckpt")
    q = start_stream(merchant_window_closed(_stream(spark, src), readable_state=True), "state_users_once", "append", ckpt, "parquet", out, trigger={"availableNow": True})
    q.awaitTermination()
    states = [p["stateOperators"] for p in q.recentProgress if p["stateOperators"]]
    rows = [max(s[i]["numRowsUpdated"] for s in states) for i in range(len(states[0]))]
    windows = spark.read.parquet(out).count()
    assert rows[-1] >= 1000 and windows and max(rows[:-1]) <= 3 * windows
    first = spark.read.parquet(out).where(F.col("window_start") == F.timestamp_seconds(F.lit(T0))).first()
    assert (first["total_transactions"], first["unique_users"], first["currencies_used"]) == (600, 200, ["EUR", "USD"])


@pytest.mark.parametrize("salt", [1, 4])
def test_anomalies(spark, log, salt):
    out, ckpt = scratch_path(spark, "a-out"), scratch_path(spark, "a-ckpt")
    query = detect_anomalies(enrich_user_stats(_stream(spark, log), stream_salt_buckets=salt), count_threshold=3)
    _run_available(query, "append", out, ckpt, f"state_anomalies_{salt}")
    closed = spark.read.parquet(out)
    open_ = state.open_anomalies(spark, ckpt, count_threshold=3)
    want = detect_anomalies(enrich_user_stats(batch(spark, log)), count_threshold=3)
    both = state.with_open(closed, open_, ["transaction_id", "transaction_timestamp"], "transaction_timestamp")
    cols = [c for c in want.columns if c != "detected_at"]
    assert open_.count() > 0 and sorted_rows(both, *cols) == sorted_rows(want, *cols)


def test_nothing_open(spark, log):
    """State of a query whose watermark passed everything, and of another layout."""
    src = scratch_path(spark, "n-src")
    for i, t in enumerate([0, 90_000, 90_000]):
        _write_batch(src, i, [_tx(i, "u", T0 + t)] if i < 2 else [])
    out, ckpt = scratch_path(spark, "n-out"), scratch_path(spark, "n-ckpt")
    _run_available(user_window_stats(_stream(spark, src)), "append", out, ckpt, "state_none")
    assert [r["transaction_count"] for r in state.open_user_windows(spark, ckpt).collect()] == [1]
    with pytest.raises(ValueError, match="keyed by"):
        state.open_merchant_windows(spark, ckpt)
    closed = spark.read.parquet(out)
    none = closed.where(F.lit(False))
    assert state.with_open(closed, none, ["user_id", "window"], "window.start").count() == 1
    ids = state.state_operators(spark, ckpt).select("operatorName").distinct().collect()
    assert [r[0] for r in ids] == [state.AGGREGATE]
