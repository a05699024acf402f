"""Skew: one user and one merchant hold a third of all rows."""

import math

from pyspark.sql import functions as F

from helpers import sorted_rows
from txlens.operators import enrich_user_stats, merchant_window_aggregates
from txlens.operators.aggregates import user_window_counts
from txlens.operators.clean import prepare_transactions
from txlens.sources.generate import generate_transactions


def _skewed(spark, n=30000):
    g = generate_transactions(spark, n=n, rate_per_sec=10, users=200, num_partitions=6)
    hot = F.xxhash64("transaction_id") % 3 == 0
    return prepare_transactions(
        g.withColumn("user_id", F.when(hot, F.lit("user_hot")).otherwise(F.col("user_id")))
        .withColumn("merchant", F.when(hot, F.lit("Amazon")).otherwise(F.col("merchant")))
    )


def test_hot_user_salted_join_equals_broadcast(spark):
    tx = _skewed(spark)
    cols = ["transaction_id", "transaction_count", "avg_transaction_amount"]
    ref = sorted_rows(enrich_user_stats(tx), *cols)
    hot_rows = 500
    salted = enrich_user_stats(tx, broadcast_max_rows=0, hot_key_rows=hot_rows)
    assert sorted_rows(salted, *cols) == ref
    # the hot user's windows hold ~1,800 rows each: split into ceil(count / 500) buckets
    stats = user_window_counts(tx, 1800).filter("user_id = 'user_hot'")
    counts = [r.transaction_count for r in stats.collect()]
    assert max(counts) > 3 * hot_rows
    buckets = {math.ceil(c / hot_rows) for c in counts}
    assert max(buckets) >= 4


def test_hot_user_salted_range_join_equals_broadcast(spark):
    from txlens.operators import enrich_user_stats_rangejoin

    tx = _skewed(spark)
    cols = ["transaction_id", "transaction_count", "avg_transaction_amount"]
    ref = sorted_rows(enrich_user_stats(tx), *cols)
    assert sorted_rows(enrich_user_stats_rangejoin(tx), *cols) == ref
    salted = enrich_user_stats_rangejoin(tx, broadcast_max_rows=0, hot_key_rows=500)
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert sorted_rows(salted, *cols) == ref


def test_hot_merchant_panes_equal_window_form(spark):
    tx = _skewed(spark)
    a = merchant_window_aggregates(tx).select(
        "merchant", "window_start", "total_transactions", "unique_users", "currencies_used", "min_amount"
    )
    b = (
        tx.groupBy("merchant", F.window("transaction_timestamp", "5 minutes", "1 minute").alias("w"))
        .agg(
            F.count("*").alias("total_transactions"),
            F.count_distinct("user_id").alias("unique_users"),
            F.sort_array(F.collect_set("currency")).alias("currencies_used"),
            F.min("amount").alias("min_amount"),
        )
        .select("merchant", F.col("w.start").alias("window_start"), "total_transactions", "unique_users",
                "currencies_used", "min_amount")
    )
    assert sorted_rows(a, *a.columns) == sorted_rows(b, *b.columns)
    top = a.groupBy("merchant").agg(F.sum("total_transactions").alias("n")).orderBy(F.desc("n")).first()
    assert top.merchant == "Amazon"
