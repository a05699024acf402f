"""The frequent-users summary and the join that spreads only these."""

import os
import random
import shutil
from collections import Counter

from pyspark.sql import functions as F

from helpers import sorted_rows
from test_streaming import T0, _run_available, _stream, _tx, _write_batch
from txlens.operators.anomalies import detect_anomalies, enrich_user_stats
from txlens.operators.clean import clean_transactions
from txlens.session import local_path, scratch_path
from txlens.sources.envelope import read_envelope
from txlens.streaming import state
from txlens.streaming.app import start_processor
from txlens.streaming.hot import FrequentItems, HotUsers, start_hot_users
from txlens.streaming.monitor import ProgressTotals


def counts_of(spark, items):
    return spark.createDataFrame(list(Counter(items).items()) or [], "item string, n bigint")


def check(summary, true):
    n = sum(true.values())
    assert summary.total == n and summary.error <= n / (summary.k + 1) and len(summary.counters) <= summary.k
    for item, c in true.items():
        assert summary.counters.get(item, 0) <= c <= summary.counters.get(item, 0) + summary.error
    for item, c in true.items():
        if c >= 0.05 * n:
            assert item in summary.frequent(0.05)


def test_counters_stay_within_the_error_bound(spark):
    r = random.Random(1)
    summary, true = FrequentItems(k=25), Counter()
    for b in range(12):
        items = [f"u{min(int(r.paretovariate(0.9)), 3000)}" for _ in range(400)] + ["late"] * (200 if b > 8 else 0)
        true.update(items)
        summary = summary.added(counts_of(spark, items))
        check(summary, true)
    assert summary.error > 0


def test_summaries_merge_with_the_same_bound(spark):
    r = random.Random(2)
    true, parts = Counter(), []
    for _ in range(4):
        items = [f"u{int(r.paretovariate(1))}" for _ in range(500)]
        true.update(items)
        parts.append(FrequentItems(k=20).added(counts_of(spark, items)))
    a = parts[0].merged(parts[1]).merged(parts[2].merged(parts[3]))
    check(a, true)
    assert FrequentItems(k=3).added(counts_of(spark, [])).counters == {}
    assert FrequentItems(k=3).added(counts_of(spark, [None, "a"])).total == 1


def test_replayed_batches_count_once_and_the_list_only_grows(spark):
    path = scratch_path(spark, "hot")
    users = HotUsers(spark, path, k=5)
    rows = spark.createDataFrame([("a",)] * 8 + [("b",)] * 2, "user_id string")
    users.add_batch(rows, 0)
    users.add_batch(rows, 0)
    assert users.summary().total == 10 and users.grown(0.5) == ["a"]
    users.add_batch(spark.createDataFrame([("c",)] * 90, "user_id string"), 1)
    assert HotUsers(spark, path).grown(0.5) == ["a", "c"] == HotUsers(spark, path).known()


def hot_log(spark, name):
    """One user holds a third of all rows of three files."""
    src = scratch_path(spark, name)
    n = 0
    for i in range(3):
        recs = []
        for j in range(90):
            recs.append(_tx(n, "hot" if j % 3 == 0 else f"u{j % 20}", T0 + i * 2400 + j * 20, 900.0 if j % 30 == 0 else 10.0 + j, is_international=True))
            n += 1
        _write_batch(src, i, recs)
    return src


def test_only_hot_users_are_spread(spark):
    src = hot_log(spark, "spread-src")
    path = scratch_path(spark, "spread-hot")
    q = start_hot_users(_stream(spark, src), scratch_path(spark, "spread-hot-ckpt"), path, trigger={"availableNow": True})
    q.awaitTermination(300)
    hot = HotUsers(spark, path).grown(0.2)
    assert hot == ["hot"]
    found, rows, salts = {}, {}, {}
    for label, users in (("all", None), ("hot", hot), ("none", [])):
        totals = ProgressTotals.attach(spark)
        out = scratch_path(spark, f"spread-{label}")
        query = detect_anomalies(enrich_user_stats(_stream(spark, src), stream_salt_buckets=8, stream_hot_users=users))
        ckpt = scratch_path(spark, f"spread-ckpt-{label}")
        q = _run_available(query, "append", out, ckpt, f"spread_{label}")
        held = state.read_state(spark, ckpt, 0, "left").where("value.user_id = 'hot'")
        salts[label] = held.select("key.field2").distinct().count()
        rows[label] = totals.summary(q)["peak_state_rows"]
        spark.streams.removeListener(totals)
        found[label] = sorted_rows(spark.read.parquet(out), "transaction_id", "transaction_count", "avg_transaction_amount", "anomaly_reasons")
    assert found["all"] == found["hot"] == found["none"] and found["hot"]
    assert salts["none"] == 1 and salts["hot"] == salts["all"] > 4
    # copies of statistics are joined when they arrive, behind the watermark, and never stored
    assert rows["hot"] == rows["none"] == rows["all"]


def test_list_may_grow_between_restarts(spark):
    """Rows buffered before a user became hot meet the statistics copied after it did."""
    src = hot_log(spark, "grow-src")
    parts = scratch_path(spark, "grow-part")
    out, ckpt = scratch_path(spark, "grow-out"), scratch_path(spark, "grow-ckpt")
    os.makedirs(local_path(parts))
    for i, users in enumerate([[], ["hot"], ["hot", "u1"]]):
        shutil.copy2(f"{local_path(src)}/batch-{i:03d}.parquet", local_path(parts))
        query = detect_anomalies(enrich_user_stats(_stream(spark, parts), stream_salt_buckets=8, stream_hot_users=users))
        _run_available(query, "append", out, ckpt, f"grow_{i}")
    tx = clean_transactions(read_envelope(spark, src))
    last = tx.agg(F.max("transaction_timestamp")).first()[0]
    want = detect_anomalies(enrich_user_stats(tx)).where(F.window("transaction_timestamp", "30 minutes").end <= F.lit(last) - F.expr("INTERVAL 10 MINUTES"))
    cols = ["transaction_id", "transaction_count", "anomaly_reasons"]
    assert sorted_rows(spark.read.parquet(out), *cols) == sorted_rows(want, *cols)


def test_processor_keeps_and_uses_the_summary(spark, tmp_shared):
    src = hot_log(spark, "app-src")
    for run in range(2):
        qs = start_processor(
            spark, "parquet", src, {"maxFilesPerTrigger": "1"}, "parquet", f"{tmp_shared}/out", checkpoint_root=f"{tmp_shared}/ckpt",
            trigger={"availableNow": True}, state_partitions=2, user_buckets=1, hot_share=0.2, track_hot_users=True,
        )
        for q in qs:
            q.awaitTermination(300)
            assert q.exception() is None
        assert "HotUsers" in {q.name for q in qs}
        assert HotUsers(spark, f"{tmp_shared}/ckpt/hot-users").known() == ([] if run == 0 else ["hot"])
