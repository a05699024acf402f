"""Streams: late data (T3), update mode (T4), restart (T5), two queries, null keys (F3)."""

import datetime as dt
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import sorted_rows
from txlens.operators import detect_anomalies, enrich_user_stats, merchant_window_aggregates, user_window_stats
from txlens.operators.clean import clean_transactions
from txlens.plans import batch, streams
from txlens.session import local_path, scratch_path
from txlens.sources.envelope import file_source_options, read_envelope, write_envelope_splits
from txlens.streaming import await_any_then_stop, latest_per_key, start_anomaly_detection, start_merchant_aggregates
from txlens.streaming.monitor import ProgressTotals
from txlens.streaming.sinks import start_stream

T0 = 1704067200  # 2024-01-01 00:00:00 UTC
_ARROW = pa.schema(
    [
        ("key", pa.binary()),
        ("value", pa.binary()),
        ("topic", pa.string()),
        ("partition", pa.int32()),
        ("offset", pa.int64()),
        ("timestamp", pa.timestamp("us", tz="UTC")),
        ("timestampType", pa.int32()),
    ]
)


def _write_batch(folder, idx, records):
    """records: list of dicts (transaction JSON fields). One parquet file, ordered mtime."""
    d = local_path(folder)
    os.makedirs(d, exist_ok=True)
    rows = {
        "key": [(r.get("user_id") or "").encode() for r in records],
        "value": [json.dumps(r).encode() for r in records],
        "topic": ["t"] * len(records),
        "partition": [0] * len(records),
        "offset": list(range(idx * 1000, idx * 1000 + len(records))),
        "timestamp": [dt.datetime.fromtimestamp(T0, dt.timezone.utc)] * len(records),
        "timestampType": [0] * len(records),
    }
    path = os.path.join(d, f"batch-{idx:03d}.parquet")
    pq.write_table(pa.table(rows, schema=_ARROW), path)
    os.utime(path, (1_700_000_000 + idx * 10, 1_700_000_000 + idx * 10))


def _tx(i, user, sec, amount=10.0, **kw):
    r = {"transaction_id": f"t{i}", "user_id": user, "amount": amount, "transaction_time": sec, "merchant": "M"}
    r.update(kw)
    return r


def _stream(spark, folder):
    return clean_transactions(read_envelope(spark, folder, streaming=True, options=file_source_options(1)))


def _run_available(df, mode, out, ckpt, name):
    q = start_stream(df, name, mode, ckpt, "parquet", out, trigger={"availableNow": True}, state_partitions=2)
    q.awaitTermination(300)
    assert not q.isActive and q.exception() is None
    return q


def test_late_rows_dropped_after_spacer(spark):
    src = scratch_path(spark, "late-src")
    batches = [[0], [7200], [7201], [10, 7000], [864000]]
    n = 0
    for i, offs in enumerate(batches):
        _write_batch(src, i, [_tx(n + j, "u", T0 + o) for j, o in enumerate(offs)])
        n += len(offs)
    out, ckpt = scratch_path(spark, "late-out"), scratch_path(spark, "late-ckpt")
    totals = ProgressTotals.attach(spark)
    q = _run_available(user_window_stats(_stream(spark, src)), "append", out, ckpt, "late_test")
    got = {r.s - T0: r.c for r in spark.read.parquet(out).select(F.unix_seconds("window.start").alias("s"), F.col("transaction_count").alias("c")).collect()}
    assert got == {0: 1, 5400: 1, 7200: 2}  # +10 dropped as late, +7000 kept
    summary = totals.summary(q)
    spark.streams.removeListener(totals)
    assert summary["rows_dropped_by_watermark"] == 1 and summary["rows_counted_by_spark"] == 6
    # maxFilesPerTrigger=1: one micro-batch per file
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"] > 0] == [1, 1, 1, 2, 1]


def test_totals_hold_every_batch(spark):
    """Spark keeps the last 100 progress reports; the totals keep all."""
    src = scratch_path(spark, "many-src")
    spark.range(0, 110, 1, 110).write.parquet(src)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(src)
    totals = ProgressTotals.attach(spark)
    q = stream.writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "many-ckpt")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    summary = totals.summary(q)
    spark.streams.removeListener(totals)
    assert len(q.recentProgress) <= 100
    assert summary["batches"] >= 110 and summary["rows_counted_by_spark"] == 110


def test_update_mode_last_emission_equals_batch(spark):
    tx = clean_transactions(streams.stream_source(spark, SF_SMALL, n_splits=4, files_per_split=1))
    out, ckpt = scratch_path(spark, "upd-out"), scratch_path(spark, "upd-ckpt")
    _run_available(merchant_window_aggregates(tx), "update", out, ckpt, "update_test")
    emitted = spark.read.parquet(out)
    last = latest_per_key(emitted, ["merchant", "window_start"])
    cols = ["merchant", "window_start", "total_transactions", "total_amount", "min_amount", "max_amount", "unique_users", "currencies_used"]
    b = merchant_window_aggregates(batch.transactions(spark, SF_SMALL))
    assert sorted_rows(last, *cols) == sorted_rows(b, *cols)
    assert emitted.count() > last.count()  # some windows were updated in several batches


def test_restart_from_checkpoint(spark):
    src = scratch_path(spark, "rs-src")
    recs = [[_tx(i * 10 + j, f"u{j}", T0 + i * 3600 + j * 60) for j in range(5)] for i in range(4)]
    for i in range(2):
        _write_batch(src, i, recs[i])
    out, ckpt = scratch_path(spark, "rs-out"), scratch_path(spark, "rs-ckpt")
    _run_available(user_window_stats(_stream(spark, src)), "append", out, ckpt, "restart_a")
    first = spark.read.parquet(out).count()
    for i in range(2, 4):
        _write_batch(src, i, recs[i])
    _run_available(user_window_stats(_stream(spark, src)), "append", out, ckpt, "restart_b")
    res = spark.read.parquet(out).select("user_id", F.unix_seconds("window.start").alias("s"), "transaction_count")
    # windows of hours 0..2 are closed by the hour-3 rows; no repeats
    assert first == 5
    assert res.count() == 15 and res.select("user_id", "s").distinct().count() == 15


def test_two_named_queries_and_stop(spark):
    src = scratch_path(spark, "two-src")
    _write_batch(src, 0, [_tx(i, f"u{i % 3}", T0 + i * 30) for i in range(40)])
    tx = _stream(spark, src)
    root = scratch_path(spark, "two")
    q1 = start_merchant_aggregates(tx, f"{root}/ckpt-agg", fmt="parquet", path=f"{root}/agg", state_partitions=2)
    q2 = start_anomaly_detection(tx, f"{root}/ckpt-anom", fmt="parquet", path=f"{root}/anom", state_partitions=2)
    q1.processAllAvailable()
    q2.processAllAvailable()
    names = {q.name for q in spark.streams.active}
    assert {"MerchantAggregates", "AnomalyDetection"} <= names
    await_any_then_stop(spark, [q1, q2], timeout=1)
    assert not q1.isActive and not q2.isActive
    vals = [json.loads(r.value) for r in spark.read.parquet(f"{root}/agg").collect()]
    assert vals and all("window_start" in v and "currencies_used" in v for v in vals)


def test_stream_null_keys_take_the_side_path(spark):
    src = scratch_path(spark, "nk-src")
    _write_batch(
        src,
        0,
        [
            _tx(1, "a", T0 + 60, 10.0),
            _tx(2, "a", T0 + 120, 50.0),
            _tx(3, None, T0 + 120, 20000.0),
            _tx(4, "a", None, 20000.0),
            _tx(5, None, T0 + 120, 5.0),
        ],
    )
    _write_batch(src, 1, [_tx(6, "z", T0 + 86400, 1.0)])  # raises the watermark
    out, ckpt = scratch_path(spark, "nk-out"), scratch_path(spark, "nk-ckpt")
    _run_available(detect_anomalies(enrich_user_stats(_stream(spark, src))), "append", out, ckpt, "nullkeys")
    got = {r.transaction_id: (r.transaction_count, list(r.anomaly_reasons)) for r in spark.read.parquet(out).collect()}
    assert got == {"t3": (None, ["HIGH_AMOUNT"]), "t4": (None, ["HIGH_AMOUNT"])}


def test_stream_equals_batch_on_closed_windows(spark):
    tx = clean_transactions(streams.stream_source(spark, SF_SMALL, n_splits=3, files_per_split=1))
    out, ckpt = scratch_path(spark, "eq-out"), scratch_path(spark, "eq-ckpt")
    _run_available(detect_anomalies(enrich_user_stats(tx)), "append", out, ckpt, "equiv")
    s = spark.read.parquet(out)
    b = detect_anomalies(enrich_user_stats(batch.transactions(spark, SF_SMALL)))
    max_sec = batch.transactions(spark, SF_SMALL).agg(F.max(F.unix_seconds("transaction_timestamp"))).first()[0]
    closed = b.filter(
        F.col("transaction_timestamp").isNull() | (F.unix_seconds("transaction_timestamp") - F.pmod(F.unix_seconds("transaction_timestamp"), F.lit(1800)) + 1800
        <= F.lit(max_sec - 600))
    )
    cols = ["transaction_id", "transaction_count", "avg_transaction_amount"]
    a, c = sorted_rows(s, *cols), sorted_rows(closed, *cols)
    assert len(a) > 0 and a == c


def test_streams_survive_extreme_event_times(spark):
    src = scratch_path(spark, "ext-src")
    _write_batch(src, 0, [
        _tx(1, "a", T0, 10.0),
        _tx(2, "a", 9_199_999_999_999_999, 50.0),  # largest accepted event time (ms)
        _tx(3, "b", -9_200_000_000_000, 20.0),  # most negative (s)
        _tx(4, "c", -2**63, 20.0),  # out of range: no event time
    ])
    out, ckpt = scratch_path(spark, "ext-out"), scratch_path(spark, "ext-ckpt")
    _run_available(merchant_window_aggregates(_stream(spark, src)), "update", out, ckpt, "ext_m")
    out, ckpt = scratch_path(spark, "ext-out"), scratch_path(spark, "ext-ckpt")
    _run_available(detect_anomalies(enrich_user_stats(_stream(spark, src))), "append", out, ckpt, "ext_a")


def test_streams_survive_poison_messages(spark):
    """One micro-batch of malformed and extreme messages next to good ones."""
    src = scratch_path(spark, "poison-src")
    d = local_path(src)
    os.makedirs(d, exist_ok=True)
    values = [
        b"\xff\xfe\x00garbage",
        b'{"transaction_id": "p1", "amount": NaN, "user_id": "u", "transaction_time": %d}' % T0,
        b'{"transaction_id": "p2", "amount": Infinity, "user_id": "u", "transaction_time": %d}' % T0,
        b'{"transaction_id": "p3", "amount": 1e300, "user_id": "u", "transaction_time": %d, "merchant": "M"}' % T0,
        b'{"transaction_id": "p4", "amount": 5, "user_id": "u", "transaction_time": 99999999999999999999999}',
        b'{"transaction_id": "p5", "amount": "5", "user_id": 7, "transaction_time": "x"}',
        json.dumps(_tx(6, "u", T0 + 60, 10.0)).encode(),
        json.dumps(_tx(7, "z", T0 + 86400, 1.0)).encode(),
    ]
    table = pa.table(
        {
            "key": [b"k"] * len(values),
            "value": values,
            "topic": ["t"] * len(values),
            "partition": [0] * len(values),
            "offset": list(range(len(values))),
            "timestamp": [dt.datetime.fromtimestamp(T0, dt.timezone.utc)] * len(values),
            "timestampType": [0] * len(values),
        },
        schema=_ARROW,
    )
    pq.write_table(table, os.path.join(d, "poison.parquet"))
    out, ckpt = scratch_path(spark, "poison-out"), scratch_path(spark, "poison-ckpt")
    _run_available(merchant_window_aggregates(_stream(spark, src)), "update", out, ckpt, "poison_m")
    out, ckpt = scratch_path(spark, "poison-out"), scratch_path(spark, "poison-ckpt")
    _run_available(detect_anomalies(enrich_user_stats(_stream(spark, src))), "append", out, ckpt, "poison_a")
    got = {r.transaction_id for r in spark.read.parquet(out).collect()}
    assert got <= {"p1", "p2", "p3", "p4"}  # the user's average is NaN: nothing exceeds it, and nothing fails


def test_admission_by_bytes(spark):
    src = scratch_path(spark, "bytes-src")
    for i in range(4):
        _write_batch(src, i, [_tx(i * 10 + j, "u", T0 + i * 60 + j) for j in range(5)])
    env = read_envelope(spark, src, streaming=True, options=file_source_options(max_bytes_per_trigger=1))
    out, ckpt = scratch_path(spark, "bytes-out"), scratch_path(spark, "bytes-ckpt")
    q = _run_available(env.select("offset"), "append", out, ckpt, "bytes_cap")
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == [5, 5, 5, 5]


def test_splits_are_staged_without_a_sort(spark):
    """A sort by split holds all of a task's rows; the splits' files are open side by side instead."""
    tx = spark.range(0, 300, 1, 2).selectExpr("cast(id AS string) AS key", "cast(id AS string) AS value", "cast(id % 3 AS int) AS _split")
    runs = spark._jsparkSession.sharedState().statusStore()
    before = runs.executionsList().size()
    path = scratch_path(spark, "splits")
    write_envelope_splits(tx, path, "_split", 3, 1)
    plans = [runs.executionsList().apply(i).physicalPlanDescription() for i in range(before, runs.executionsList().size())]
    staged = [p for p in plans if "-staged" in p and "InsertIntoHadoopFsRelationCommand" in p and "Range" in p]
    assert staged and not [p for p in staged if "Sort" in p]
    assert len(os.listdir(local_path(f"{path}-staged"))) >= 3 and spark.read.parquet(path).count() == 300
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
