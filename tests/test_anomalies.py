"""Enrichment, rules and reasons (FIXTURES.md section 5 C, D; SURVEY T2)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import epoch, prepared, sorted_rows, tx_rows
from txlens.operators import detect_anomalies, enrich_user_stats, enrich_user_stats_rangejoin
from txlens.plans import batch


def _with_time(spark, rows):
    # like prepare_transactions but keeps a null event time (FIXTURES C4)
    from txlens.operators.clean import valid_transactions, with_event_time

    return valid_transactions(with_event_time(tx_rows(spark, rows)))


def test_enrichment_null_keys(spark):
    rows = [
        {"transaction_id": "1", "user_id": "a", "amount": 10.0, "transaction_time": epoch(0, 1)},
        {"transaction_id": "2", "user_id": "a", "amount": 50.0, "transaction_time": epoch(0, 2)},
        {"transaction_id": "3", "user_id": None, "amount": 20000.0, "transaction_time": epoch(0, 2)},
        {"transaction_id": "4", "user_id": "a", "amount": 20000.0, "transaction_time": None},
        {"transaction_id": "5", "user_id": None, "amount": 5.0, "transaction_time": epoch(0, 2)},
    ]
    tx = _with_time(spark, rows)
    for fn in (enrich_user_stats, enrich_user_stats_rangejoin):
        got = {r.transaction_id: (r.transaction_count, r.avg_transaction_amount) for r in fn(tx).collect()}
        assert got == {"1": (2, 30.0), "2": (2, 30.0), "3": (None, None), "4": (None, None), "5": (None, None)}
    an = {r.transaction_id: r.anomaly_reasons for r in detect_anomalies(enrich_user_stats(tx)).collect()}
    assert an == {"3": ["HIGH_AMOUNT"], "4": ["HIGH_AMOUNT"]}


def test_thresholds_are_strict(spark):
    t = epoch(3, 0)
    rows = []
    # user p: amounts 10,10,10,60 -> avg 22.5, 3*avg = 67.5: no hit; add equality case below
    for i, a in enumerate([10.0, 10.0, 10.0, 90.0]):
        rows.append({"transaction_id": f"p{i}", "user_id": "p", "amount": a, "transaction_time": t})
    # user q: 10 rows (count = 10, no hit) ; user r: 11 rows (hit)
    rows += [{"transaction_id": f"q{i}", "user_id": "q", "amount": 1.0, "transaction_time": t} for i in range(10)]
    rows += [{"transaction_id": f"r{i}", "user_id": "r", "amount": 1.0, "transaction_time": t} for i in range(11)]
    # international at 1000.00 (no) and 1000.01 (hit), null flag (no)
    rows += [
        {"transaction_id": "i0", "user_id": "i0", "amount": 1000.00, "is_international": True, "transaction_time": t},
        {"transaction_id": "i1", "user_id": "i1", "amount": 1000.01, "is_international": True, "transaction_time": t},
        {"transaction_id": "i2", "user_id": "i2", "amount": 5000.0, "is_international": None, "transaction_time": t},
    ]
    an = {r.transaction_id: r.anomaly_reasons for r in detect_anomalies(enrich_user_stats(prepared(spark, rows))).collect()}
    # p3: 90 = 3 x avg(10,10,10,90)=30 -> equality, no hit
    assert "p3" not in an
    assert not any(k.startswith("q") for k in an)
    assert all(an[f"r{i}"] == ["HIGH_FREQUENCY"] for i in range(11))
    assert "i0" not in an and an["i1"] == ["HIGH_INTERNATIONAL"] and "i2" not in an


def test_no_stats_default_limit(spark):
    rows = [
        {"transaction_id": "a", "user_id": None, "amount": 10000.0, "transaction_time": epoch(4, 0)},
        {"transaction_id": "b", "user_id": None, "amount": 10000.01, "transaction_time": epoch(4, 0), "is_international": True},
    ]
    an = {r.transaction_id: r.anomaly_reasons for r in detect_anomalies(enrich_user_stats(prepared(spark, rows))).collect()}
    assert an == {"b": ["HIGH_AMOUNT", "HIGH_INTERNATIONAL"]}


def test_reason_order_all_three(spark):
    t = epoch(5, 0)
    rows = [{"transaction_id": f"s{i}", "user_id": "s", "amount": 1.0, "transaction_time": t} for i in range(11)]
    rows.append({"transaction_id": "big", "user_id": "s", "amount": 5000.0, "is_international": True, "transaction_time": t})
    an = {r.transaction_id: r.anomaly_reasons for r in detect_anomalies(enrich_user_stats(prepared(spark, rows))).collect()}
    assert an["big"] == ["HIGH_AMOUNT", "HIGH_FREQUENCY", "HIGH_INTERNATIONAL"]


def test_three_join_forms_agree(spark):
    """window-equality join == literal range join == window function, on fixture data."""
    tx = batch.transactions(spark, SF_SMALL)
    cols = ["transaction_id", "transaction_count", "avg_transaction_amount"]
    a = sorted_rows(enrich_user_stats(tx), *cols)
    b = sorted_rows(enrich_user_stats_rangejoin(tx), *cols)
    w = Window.partitionBy("user_id", F.floor(F.unix_seconds("transaction_timestamp") / 1800))
    ok = F.col("user_id").isNotNull() & F.col("transaction_timestamp").isNotNull()
    c = sorted_rows(
        tx.select(
            "transaction_id",
            F.when(ok, F.count("*").over(w)).alias("transaction_count"),
            F.when(ok, F.avg("amount").over(w)).alias("avg_transaction_amount"),
        ),
        *cols,
    )
    assert len(a) == tx.count() and a == b == c


def test_broadcast_and_shuffle_paths_agree(spark):
    tx = batch.transactions(spark, SF_SMALL)
    cols = ["transaction_id", "transaction_count", "avg_transaction_amount"]
    small = enrich_user_stats(tx)
    big = enrich_user_stats(tx, broadcast_max_rows=0)
    plan_big = big._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan_big
    assert sorted_rows(small, *cols) == sorted_rows(big, *cols)


def test_rule_counts_sf001(spark):
    an = detect_anomalies(enrich_user_stats(batch.transactions(spark, SF_SMALL)))
    c = an.agg(
        F.count("*"),
        F.sum(F.array_contains("anomaly_reasons", "HIGH_AMOUNT").cast("int")),
        F.sum(F.array_contains("anomaly_reasons", "HIGH_FREQUENCY").cast("int")),
        F.sum(F.array_contains("anomaly_reasons", "HIGH_INTERNATIONAL").cast("int")),
        F.sum((F.size("anomaly_reasons") == 3).cast("int")),
    ).first()
    assert all(c) and c[0] <= sum(c[1:4])  # each rule fires, alone and with the others


def test_hot_keys_are_salted_in_the_shuffle_join(spark):
    """Statistics too big to broadcast: keys with > hot_key_rows rows are split."""
    tx = batch.transactions(spark, SF_SMALL)
    cols = ["transaction_id", "transaction_count", "avg_transaction_amount"]
    ref = sorted_rows(enrich_user_stats(tx), *cols)
    salted = enrich_user_stats(tx, broadcast_max_rows=0, hot_key_rows=3)
    p = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in p and "_buckets" in p
    assert sorted_rows(salted, *cols) == ref
    # the salted side holds one stats row per bucket: more rows than keys
    # (max 15 rows per user-window at sf0.001, so buckets of 3 give up to 5 copies)
