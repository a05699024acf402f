"""Late rows replayed per batch against the stream's own counts, and delays by a quantile sketch."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import sorted_rows
from test_streaming import T0, _run_available, _stream, _tx, _write_batch
from txlens.operators.aggregates import user_window_stats
from txlens.operators.clean import clean_transactions
from txlens.operators.lateness import KLL_ERROR, batch_watermarks, counted, delay_for_share, late_rows_by_batch, with_lateness
from txlens.session import scratch_path
from txlens.sources.envelope import read_envelope
from txlens.streaming.monitor import ProgressTotals


def published(spark, batches, name):
    src = scratch_path(spark, name)
    n = 0
    for i, secs in enumerate(batches):
        _write_batch(src, i, [_tx(n + j, "u", None if s is None else T0 + s) for j, s in enumerate(secs)])
        n += len(secs)
    of = {f"t{k}": i for i, secs in enumerate(batches) for k in range(sum(map(len, batches[:i])), sum(map(len, batches[: i + 1])))}
    batch = spark.createDataFrame(list(of.items()), "transaction_id string, batch int")
    return src, clean_transactions(read_envelope(spark, src)).join(batch, "transaction_id")


def statuses(rows):
    return {r["transaction_id"]: (r["status"], r["lateness"]) for r in with_lateness(rows, "batch").collect()}


def test_status_of_each_row(spark):
    src, rows = published(spark, [[0], [7200], [7201], [10, 7000, None], [864000]], "late-status")
    got = statuses(rows)
    assert got["t0"] == ("on_time", 0) and got["t2"] == ("on_time", 0)
    assert got["t3"] == ("dropped", 7191)  # its window closed for late rows one batch ago
    assert got["t4"] == ("on_time", 201) and got["t5"] == (None, None) and got["t6"] == ("on_time", 0)
    marks = {r["batch"]: (r["closes"], r["drops"]) for r in batch_watermarks(rows, "batch").collect()}
    assert marks[0] == (None, None) and marks[1] == (T0 - 600, None) and marks[3] == (T0 + 7201 - 600, T0 + 7200 - 600)
    per = {r["batch"]: (r["on_time"], r["late"], r["dropped"], r["untimed"]) for r in late_rows_by_batch(with_lateness(rows, "batch"), "batch").collect()}
    assert per[3] == (1, 0, 1, 1)


def test_row_right_after_the_watermark_rose_is_counted(spark):
    src, rows = published(spark, [[0], [7200], [10], [11], [864000]], "late-lag")
    got = statuses(rows)
    assert got["t2"][0] == "late" and got["t3"][0] == "dropped"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_equals_the_stream(spark, seed):
    """Random arrival: the windows the stream emits hold exactly the rows that the replay counts, and Spark
    reports as many dropped rows (one per window and batch, as they are combined before they are dropped)."""
    r = random.Random(seed)
    batches = [[max(0, int(i * 1500 + r.uniform(-6000, 1500))) for _ in range(r.randrange(1, 8))] for i in range(9)] + [[10**6]]
    src, rows = published(spark, batches, f"late-random-{seed}")
    out = scratch_path(spark, "late-out")
    totals = ProgressTotals.attach(spark)
    q = _run_available(user_window_stats(_stream(spark, src)), "append", out, scratch_path(spark, "late-ckpt"), f"late_{seed}")
    dropped = totals.summary(q)["rows_dropped_by_watermark"]
    spark.streams.removeListener(totals)
    marked = with_lateness(rows, "batch")
    want = user_window_stats(counted(marked)).where(F.unix_seconds("window.end") < T0 + 10**6 - 3600)
    cols = ["user_id", "window", "transaction_count"]
    assert sorted_rows(spark.read.parquet(out), *cols) == sorted_rows(want, *cols)
    window = F.floor(F.unix_seconds("transaction_timestamp") / 1800)
    assert dropped == marked.where("status = 'dropped'").select("batch", window).distinct().count()


def test_delay_for_a_share_of_the_rows(spark):
    rows = spark.range(0, 20_000, 1, 5).select(F.pmod(F.xxhash64("id"), F.lit(5000)).alias("lateness"))
    n = rows.count()
    for r in delay_for_share(rows).collect():
        below, under = rows.where(F.col("lateness") <= r["delay_seconds"]).count(), rows.where(F.col("lateness") < r["delay_seconds"]).count()
        assert below >= (r["share"] - KLL_ERROR) * n and under <= (r["share"] + KLL_ERROR) * n
    assert delay_for_share(rows.limit(0)).count() == 0


def test_empty_and_untimed_logs(spark):
    src, rows = published(spark, [[None, None]], "late-none")
    assert statuses(rows) == {"t0": (None, None), "t1": (None, None)}
    assert with_lateness(rows.limit(0), "batch").count() == 0
