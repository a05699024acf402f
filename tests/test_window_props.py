"""Property: pane arithmetic gives exactly the windows Spark's window() gives."""

import math
import random

from helpers import sorted_rows
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txlens.functions.columns import pane_start, window_starts_for_pane


@settings(max_examples=12, deadline=None, derandomize=True)
@given(
    slide=st.sampled_from([1, 2, 5, 7, 15, 30, 60, 90]),
    factor=st.sampled_from([1, 2, 3, 5]),
    extra=st.sampled_from([0, 1, 13, 29]),
    seed=st.integers(0, 10**6),
)
def test_pane_window_starts_equal_spark_windows(spark, slide, factor, extra, seed):
    window = slide * factor + extra  # also windows that are not a multiple of the slide
    pane = math.gcd(window, slide)
    rng = random.Random(seed)
    secs = [rng.randint(-10**9, 4 * 10**9) for _ in range(200)] + [0, -1, 59, 60, 61]
    df = spark.createDataFrame([(s,) for s in secs], "sec long").withColumn("ts", F.timestamp_seconds("sec"))
    ours = df.select(
        "sec", F.explode(window_starts_for_pane(pane_start(F.col("sec"), pane), window, slide)).alias("start")
    )
    theirs = df.select("sec", F.window("ts", f"{window} seconds", f"{slide} seconds").alias("w")).select(
        "sec", F.unix_seconds("w.start").alias("start")
    )
    a = sorted(tuple(r) for r in ours.collect())
    b = sorted(tuple(r) for r in theirs.collect())
    assert a == b


def _epoch_rule(t):
    if t is None:
        return None
    s = int(t / 1000) if t > 10**12 else t  # toward zero, as the reference's division
    if t > 10**12:
        s = (t - (t % 1000 if t >= 0 else -((-t) % 1000))) // 1000
    from txlens.functions.columns import MAX_EPOCH_SECONDS

    return s if abs(s) <= MAX_EPOCH_SECONDS else None


@settings(max_examples=8, deadline=None, derandomize=True)
@given(st.lists(st.one_of(
    st.integers(-10**13, 10**13),
    st.sampled_from([10**12, 10**12 + 1, 10**12 - 1, 0, -1, 1704067200, 1704067200999, 9_200_000_000_000,
                     9_200_000_000_001, -2**63, 2**63 - 1, 9_223_372_036_854 - 604_800, 9_223_372_036_855 - 604_800]),
    st.integers(-2**63, 2**63 - 1),
    st.none(),
), min_size=1, max_size=60))
def test_epoch_rule_matches_python(spark, values):
    from txlens.functions.columns import ms_or_seconds_to_timestamp

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t long")
    got = {r.i: r.s for r in df.select("i", F.unix_seconds(ms_or_seconds_to_timestamp("t")).alias("s")).collect()}
    assert got == {i: _epoch_rule(v) for i, v in enumerate(values)}


@settings(max_examples=8, deadline=None, derandomize=True)
@given(st.lists(st.floats(1e-3, 1e12), min_size=1, max_size=200))
def test_money_sums_are_double_sums(spark, amounts):
    import math

    from txlens.operators import user_window_stats
    from helpers import epoch, prepared

    rows = [{"transaction_id": str(i), "user_id": "u", "amount": a, "transaction_time": epoch(1, 0)} for i, a in enumerate(amounts)]
    r = user_window_stats(prepared(spark, rows).repartition(3)).first()
    assert math.isclose(r.total_spent, math.fsum(amounts), rel_tol=1e-12)
    assert math.isclose(r.avg_transaction_amount, math.fsum(amounts) / len(amounts), rel_tol=1e-12)


@settings(max_examples=6, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.binary(max_size=80), st.none()), min_size=1, max_size=80))
def test_arbitrary_message_bytes_never_fail(spark, values):
    """Any value bytes (invalid UTF-8, truncated JSON, nothing) parse to null fields
    or to a transaction; the validity filter drops what has no id or amount."""
    from txlens.operators.clean import clean_transactions
    from txlens.schema import ENVELOPE_SCHEMA

    rows = [(None, v, "t", 0, i, None, 0) for i, v in enumerate(values)]
    env = spark.createDataFrame(rows, ENVELOPE_SCHEMA)
    assert clean_transactions(env).count() <= len(values)


_ANY_VALUE = st.one_of(
    st.none(),
    st.booleans(),
    st.integers(-2**70, 2**70),
    st.floats(allow_nan=False, allow_infinity=False),
    st.text(max_size=8),
)


@settings(max_examples=6, deadline=None, derandomize=True)
@given(st.lists(
    st.fixed_dictionaries(
        {
            "transaction_id": st.one_of(st.text(min_size=1, max_size=6), _ANY_VALUE),
            "user_id": st.one_of(st.sampled_from(["u1", "u2"]), _ANY_VALUE),
            "amount": st.one_of(st.floats(0.01, 1e6), _ANY_VALUE),
            "transaction_time": st.one_of(st.integers(1704067200, 1704080000), _ANY_VALUE),
            "merchant": st.one_of(st.sampled_from(["A", "B"]), _ANY_VALUE),
            "currency": _ANY_VALUE,
            "is_international": _ANY_VALUE,
        }
    ),
    min_size=1,
    max_size=40,
))
def test_arbitrary_field_values_flow_through_every_operator(spark, records):
    import json

    from txlens.operators import detect_anomalies, enrich_user_stats, merchant_window_aggregates, user_window_stats
    from txlens.operators.clean import clean_transactions
    from txlens.schema import ENVELOPE_SCHEMA

    rows = [(None, json.dumps(r).encode(), "t", 0, i, None, 0) for i, r in enumerate(records)]
    tx = clean_transactions(spark.createDataFrame(rows, ENVELOPE_SCHEMA))
    n = tx.count()
    assert merchant_window_aggregates(tx).count() >= 0
    assert user_window_stats(tx).count() <= n
    assert detect_anomalies(enrich_user_stats(tx)).count() <= n


@settings(max_examples=4, deadline=None, derandomize=True, phases=[Phase.explicit, Phase.generate])  # no slow shrinking
@given(seed=st.integers(0, 10**6), users=st.sampled_from([1, 3, 20]), rate=st.sampled_from([1, 5, 50]))
def test_enrichment_forms_agree_on_random_data(spark, seed, users, rate):
    """Equi-join on (user, window), literal range join and a window-function brute
    force give the same statistics per transaction, nulls included."""
    from pyspark.sql import Window

    from txlens.operators import enrich_user_stats, enrich_user_stats_rangejoin
    from txlens.operators.clean import valid_transactions, with_event_time
    from txlens.sources.generate import generate_transactions

    g = generate_transactions(spark, n=600, seed=seed, users=users, rate_per_sec=rate, num_partitions=3)
    h = F.xxhash64("transaction_id", F.lit(seed))
    g = g.withColumn("user_id", F.when(F.pmod(h, F.lit(17)) == 0, F.lit(None)).otherwise(F.col("user_id")))
    g = g.withColumn("transaction_time", F.when(F.pmod(h, F.lit(19)) == 0, F.lit(None)).otherwise(F.col("transaction_time")))
    tx = valid_transactions(with_event_time(g))
    cols = ["transaction_id", "transaction_count", "avg_transaction_amount"]
    a = sorted_rows(enrich_user_stats(tx), *cols)
    b = sorted_rows(enrich_user_stats_rangejoin(tx), *cols)
    ok = F.col("user_id").isNotNull() & F.col("transaction_timestamp").isNotNull()
    # window key by arithmetic: F.window would drop the rows without event time
    w = Window.partitionBy("user_id", F.floor(F.unix_seconds("transaction_timestamp") / 1800))
    c = sorted_rows(
        tx.select(
            "transaction_id",
            F.when(ok, F.count(F.lit(1)).over(w)).alias("transaction_count"),
            F.when(ok, F.avg("amount").over(w)).alias("avg_transaction_amount"),
        ),
        *cols,
    )
    assert len(a) == tx.count() and a == b == c
