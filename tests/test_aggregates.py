"""Windows and aggregates (FIXTURES.md section 5 E, F; SURVEY T2, T6)."""

import pytest
from pyspark.sql import functions as F

from helpers import epoch, prepared, sorted_rows
from txlens.operators import merchant_window_aggregates, sliding_window_expand, user_window_stats
from txlens.plans import batch
from conftest import SF_SMALL


def test_window_edges_half_open(spark):
    rows = [
        {"transaction_id": str(i), "user_id": "u", "amount": 1.0, "transaction_time": epoch(0, m, s), "merchant": "M"}
        for i, (m, s) in enumerate([(0, 0), (4, 59), (5, 0), (29, 59), (30, 0)])
    ]
    st = user_window_stats(prepared(spark, rows)).select(
        F.unix_seconds("window.start").alias("s"), "transaction_count"
    )
    got = dict(sorted_rows(st, "s", "transaction_count"))
    assert got == {epoch(0, 0): 4, epoch(0, 30): 1}


def test_sliding_starts(spark):
    rows = [{"transaction_id": "x", "user_id": "u", "amount": 2.0, "transaction_time": epoch(0, 7), "merchant": "M"}]
    w = sliding_window_expand(prepared(spark, rows)).select(F.unix_seconds("window.start").alias("s"))
    assert sorted(r.s for r in w.collect()) == [epoch(0, m) for m in (3, 4, 5, 6, 7)]
    agg = merchant_window_aggregates(prepared(spark, rows)).select(F.unix_seconds("window_start").alias("s"))
    assert sorted(r.s for r in agg.collect()) == [epoch(0, m) for m in (3, 4, 5, 6, 7)]


def test_group_semantics(spark):
    t = epoch(1, 0, 10)
    rows = [
        {"transaction_id": "1", "user_id": "a", "amount": 10.0, "currency": "USD", "transaction_time": t, "merchant": "M"},
        {"transaction_id": "1", "user_id": "a", "amount": 20.0, "currency": None, "transaction_time": t, "merchant": "M"},
        {"transaction_id": "2", "user_id": "b", "amount": 30.5, "currency": "EUR", "transaction_time": t, "merchant": "M"},
        {"transaction_id": "3", "user_id": "c", "amount": 7.25, "currency": "GBP", "transaction_time": t, "merchant": None},
        {"transaction_id": "4", "user_id": "d", "amount": 5.0, "currency": "JPY", "transaction_time": None, "merchant": "M"},
    ]
    agg = merchant_window_aggregates(prepared(spark, rows)).filter(F.col("window_start") == F.timestamp_seconds(F.lit(epoch(1, 0))))
    got = {r.merchant: r for r in agg.collect()}
    m = got["M"]
    assert m.total_transactions == 3  # duplicate id counts twice; null-time row has no window
    assert m.total_amount == 60.5 and m.min_amount == 10.0 and m.max_amount == 30.5
    assert m.average_amount == pytest.approx(60.5 / 3)
    assert m.unique_users == 2  # user a twice
    assert m.currencies_used == ["EUR", "USD"]  # null currency not in the set, sorted
    assert got[None].total_transactions == 1  # null merchant is its own group
    one = user_window_stats(prepared(spark, rows)).filter("user_id = 'c'").first()
    assert one.stddev_amount is None and one.transaction_count == 1  # one row: stddev null


def test_exact_money_sums(spark):
    rows = [
        {"transaction_id": str(i), "user_id": "u", "amount": 0.1, "transaction_time": epoch(2, 0), "merchant": "M"}
        for i in range(10)
    ]
    r = user_window_stats(prepared(spark, rows)).first()
    assert r.total_spent == 1.0  # exact, not 0.9999999999999999
    assert r.avg_transaction_amount == 0.1


def test_pane_batch_equals_direct_window_form(spark):
    """Pane pre-aggregation == Spark's window()-Expand form on the fixture data."""
    tx = batch.transactions(spark, SF_SMALL)
    panes = merchant_window_aggregates(tx)
    direct = (
        tx.groupBy("merchant", F.window("transaction_timestamp", "5 minutes", "1 minute").alias("w"))
        .agg(
            F.count("*").alias("total_transactions"),
            F.min("amount").alias("min_amount"),
            F.max("amount").alias("max_amount"),
            F.count_distinct("user_id").alias("unique_users"),
            F.sort_array(F.collect_set("currency")).alias("currencies_used"),
            F.sum("amount").alias("total_amount"),
        )
        .select("merchant", F.col("w.start").alias("window_start"), "total_transactions", "min_amount", "max_amount",
                "unique_users", "currencies_used", "total_amount")
    )
    cols = ["merchant", "window_start", "total_transactions", "min_amount", "max_amount", "unique_users", "currencies_used", "total_amount"]
    a = sorted_rows(panes.select(*cols), *cols)
    b = sorted_rows(direct, *cols)
    assert len(a) > 1000 and a == b


def test_non_divisible_slide(spark):
    """window 5 min sliding by 2 min: panes of gcd = 1 min, same as window()."""
    tx = batch.transactions(spark, SF_SMALL)
    a = merchant_window_aggregates(tx, "5 minutes", "2 minutes").select("merchant", "window_start", "total_transactions")
    b = (
        tx.groupBy("merchant", F.window("transaction_timestamp", "5 minutes", "2 minutes").alias("w"))
        .agg(F.count("*").alias("total_transactions"))
        .select("merchant", F.col("w.start").alias("window_start"), "total_transactions")
    )
    assert sorted_rows(a, *a.columns) == sorted_rows(b, *b.columns)


def test_properties_counts(spark):
    """T6: sum over sliding windows = 5 x rows; sum over tumbling windows = rows."""
    tx = batch.transactions(spark, SF_SMALL)
    n = tx.where("transaction_timestamp IS NOT NULL").count()
    s5 = merchant_window_aggregates(tx).agg(F.sum("total_transactions")).first()[0]
    s30 = user_window_stats(tx).agg(F.sum("transaction_count")).first()[0]
    assert (s5, s30) == (5 * n, n)


def test_approx_distinct_option(spark):
    tx = batch.transactions(spark, SF_SMALL)
    a = merchant_window_aggregates(tx, exact_distinct=False).select("merchant", "window_start", "unique_users")
    e = merchant_window_aggregates(tx).select("merchant", "window_start", F.col("unique_users").alias("exact"))
    j = a.join(e, ["merchant", "window_start"]).filter(F.abs(F.col("unique_users") - F.col("exact")) > 1)
    assert j.count() == 0


def test_a_lone_small_amount_is_kept_and_raises_no_alarm(spark):
    from txlens.operators import detect_anomalies, enrich_user_stats

    tx = prepared(spark, [{"transaction_id": "a", "user_id": "u", "amount": 0.004, "transaction_time": epoch(6, 0), "merchant": "M"}])
    m = merchant_window_aggregates(tx).first()
    assert (m.total_amount, m.average_amount) == (0.004, 0.004)
    assert detect_anomalies(enrich_user_stats(tx)).count() == 0


def test_amounts_are_summed_as_doubles(spark):
    t = epoch(6, 0)
    for amounts in ([1234.5678, 1.2345], [2e17, 5.0], [10.0, 1e300], [10.0, float("inf")], [10.0, float("nan")]):
        rows = [{"transaction_id": str(i), "user_id": "u", "amount": a, "transaction_time": t, "merchant": "M"} for i, a in enumerate(amounts)]
        tx = prepared(spark, rows)
        m, u = merchant_window_aggregates(tx).first(), user_window_stats(tx).first()
        for got in (m.total_amount, u.total_spent):
            assert repr(got) == repr(sum(amounts))
        for got in (m.average_amount, u.avg_transaction_amount):
            assert repr(got) == repr(sum(amounts) / 2)
        assert (m.total_transactions, u.transaction_count) == (2, 2)


def test_non_finite_amounts_reach_the_rules(spark):
    """NaN and Infinity pass amount > 0 (NaN sorts above all numbers): the averages follow, and
    comparisons with them never fail a query."""
    from txlens.operators import detect_anomalies, enrich_user_stats

    t = epoch(7, 0)
    rows = [
        {"transaction_id": "a", "user_id": "u", "amount": 10.0, "transaction_time": t, "is_international": True},
        {"transaction_id": "b", "user_id": "u", "amount": float("inf"), "transaction_time": t, "is_international": True},
        {"transaction_id": "c", "user_id": "v", "amount": float("nan"), "transaction_time": t, "is_international": True},
    ]
    hits = {r.transaction_id: r.anomaly_reasons for r in detect_anomalies(enrich_user_stats(prepared(spark, rows))).collect()}
    assert hits == {"b": ["HIGH_INTERNATIONAL"], "c": ["HIGH_INTERNATIONAL"]}


def test_users_are_counted_once_per_window(spark):
    """Users that come, pause and return, panes without users, null users and merchants."""
    import random

    r = random.Random(5)
    rows = [
        {
            "transaction_id": str(i), "user_id": r.choice(["a", "b", "c", None]), "amount": 1.0, "merchant": r.choice(["M", None]),
            "currency": r.choice(["USD", "EUR", None]), "transaction_time": epoch(8, 0) + r.choice([r.randrange(1200), r.randrange(7200)]),
        }
        for i in range(300)
    ]
    for window, slide in (("5 minutes", "1 minute"), ("10 minutes", "3 minutes"), ("4 minutes", "4 minutes")):
        got = merchant_window_aggregates(prepared(spark, rows), window, slide)
        plain = (
            prepared(spark, rows)
            .groupBy("merchant", F.window("transaction_timestamp", window, slide).alias("w"))
            .agg(F.count_distinct("user_id").alias("users"), F.count("*").alias("n"), F.array_sort(F.collect_set("currency")).alias("c"))
        )
        assert sorted_rows(got, "merchant", "window_start", "unique_users", "total_transactions", "currencies_used") == sorted_rows(
            plain.select("merchant", "w.start", "users", "n", "c"), "merchant", "start", "users", "n", "c"
        )
