"""Generator determinism and domains; load and size reports."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from txlens.operators import record_size_profile, throughput_by_worker, throughput_overall
from txlens.schema import CURRENCIES, MERCHANTS, PAYMENT_METHODS, TRANSACTION_TYPES
from txlens.sources.generate import generate_transactions


def test_generator_is_partition_independent(spark):
    a = generate_transactions(spark, n=5000, num_partitions=1)
    b = generate_transactions(spark, n=5000, num_partitions=7)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    c = generate_transactions(spark, n=5000, seed=7)
    assert c.exceptAll(a).count() > 4900


def test_generator_domains(spark):
    g = generate_transactions(spark, n=20000)
    r = g.agg(
        F.count_distinct("transaction_id").alias("ids"),
        F.min("amount").alias("lo"),
        F.max("amount").alias("hi"),
        F.count_distinct("user_id").alias("users"),
        F.max(F.abs(F.col("amount") * 100 - F.round(F.col("amount") * 100))).alias("frac"),
    ).first()
    assert r.ids == 20000 and 10.0 <= r.lo and r.hi <= 1000.0 and r.users <= 1000 and r.frac < 1e-6
    for col, dom in [("currency", CURRENCIES), ("merchant", MERCHANTS), ("transaction_type", TRANSACTION_TYPES), ("payment_method", PAYMENT_METHODS)]:
        assert {x[0] for x in g.select(col).distinct().collect()} == set(dom)
    assert len(g.first().transaction_id) == 36


def test_generator_from_table_ids(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    g = generate_transactions(ids=ev, id_col="event_id")
    assert g.count() == ev.count()


def test_throughput_reports(spark):
    df = spark.createDataFrame(
        [(0, 100, True), (0, 110, True), (0, 120, False), (1, 100, True), (2, 5, True)],
        "w int, sec long, ok boolean",
    )
    byw = {r.worker_id: r for r in throughput_by_worker(df, "w", "sec", "ok").collect()}
    assert (byw[0].message_count, byw[0].success_count, byw[0].error_count) == (3, 2, 1)
    assert byw[0].elapsed == 20.0 and byw[0].throughput == 3 / 20
    assert byw[1].throughput == 0.0  # zero elapsed guard
    o = throughput_overall(df, "w", "sec", "ok", target=0.04).first()
    assert (o.workers, o.total_messages, o.total_errors, o.elapsed) == (3, 5, 1, 115.0)
    assert o.target_reached is True


def test_record_size(spark):
    df = spark.createDataFrame(
        [("id1", "user_1", 5.0, "USD", 1, "eBay", True, "purchase", "paypal")],
        "transaction_id string, user_id string, amount double, currency string, transaction_time long, "
        "merchant string, is_international boolean, transaction_type string, payment_method string",
    )
    r = record_size_profile(df, include_json=True).first()
    assert r.avg_record_bytes == 3 + 6 + 3 + 4 + 8 + 6 + 20
    assert r.raw_bytes == 50 and r.stored_bytes == 50 * 1.5 * 3 / 5
    assert r.avg_json_bytes > 100


def test_record_size_query_profiles_every_row(spark):
    from txlens.plans import batch

    rows = batch.fields(spark, SF_SMALL)
    assert rows.where("amount = 0 OR isnan(amount) OR abs(amount) >= 1e7").count() > 0
    profile = batch.q_record_size_profile(spark, SF_SMALL).first()
    assert profile["records"] == rows.count()
    texts = [r["j"] for r in rows.selectExpr("to_json(struct(*)) AS j").collect()]
    assert profile["avg_json_bytes"] * len(texts) == pytest.approx(sum(len(t.encode()) for t in texts))


def test_properties_on_generated_data(spark):
    """T6 with several seeds: sliding counts sum to 5 x rows, tumbling to rows, and a row
    is an anomaly exactly when its reasons are non-empty."""
    from txlens.operators import detect_anomalies, enrich_user_stats, merchant_window_aggregates, user_window_stats
    from txlens.operators.anomalies import with_reasons
    from txlens.operators.clean import prepare_transactions

    for seed in (1, 2, 3):
        g = prepare_transactions(generate_transactions(spark, n=3000, seed=seed, rate_per_sec=1, users=20))
        n = g.count()
        assert merchant_window_aggregates(g).agg(F.sum("total_transactions")).first()[0] == 5 * n
        assert user_window_stats(g).agg(F.sum("transaction_count")).first()[0] == n
        r = with_reasons(enrich_user_stats(g))
        hits = r.filter(F.size("anomaly_reasons") > 0).count()
        assert detect_anomalies(enrich_user_stats(g)).count() == hits > 0
