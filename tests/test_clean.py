"""T1: JSON decode, epoch normalisation, validity filters (FIXTURES.md section 5 A, B, D)."""

from pyspark.sql import functions as F

from txlens.functions.columns import ms_or_seconds_to_timestamp
from txlens.operators.clean import clean_transactions, parse_transactions, valid_transactions, with_event_time
from txlens.schema import ENVELOPE_SCHEMA


def _envelope(spark, values):
    rows = [(None, None if v is None else v.encode(), "t", 0, i, None, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


def test_json_edge_cases(spark):
    values = [
        '{"transaction_id":"a","amount":5}',  # A1
        "{bad",  # A2
        '{"transaction_id":"b","amount":"x","is_international":true}',  # A3
        '{"transaction_id":7,"amount":"5"}',  # A4
        "[1]",  # A5
        None,  # A6
        "",  # A6
        '{"transaction_id":"c","amount":3,"zzz":1}',  # A7
        '{"transaction_id":"d","amount":1,"transaction_time":1.5}',  # A8
        '{"TRANSACTION_ID":"e","amount":2}',  # A9
        '[{"transaction_id":"f","amount":2}]',  # A5, array of objects
    ]
    p = parse_transactions(_envelope(spark, values)).collect()
    assert (p[0].transaction_id, p[0].amount, p[0].currency) == ("a", 5.0, None)
    assert p[1].transaction_id is None and p[1].amount is None
    assert p[2].transaction_id == "b" and p[2].amount is None and p[2].is_international is True
    assert p[3].transaction_id == "7" and p[3].amount is None
    assert p[4].transaction_id is None
    assert p[5].transaction_id is None and p[6].transaction_id is None
    assert p[7].transaction_id == "c" and p[7].amount == 3.0
    assert p[8].transaction_id == "d" and p[8].transaction_time is None
    assert p[9].transaction_id is None
    assert p[10].transaction_id is None and p[10].amount is None
    kept = clean_transactions(_envelope(spark, values)).select("transaction_id").collect()
    assert sorted(r[0] for r in kept) == ["a", "c", "d"]


def test_epoch_branches(spark):
    df = spark.createDataFrame(
        [(1, 1704067200), (2, 1704067200999), (3, 1000000000000), (4, 1000000000001), (5, None), (6, 10**15), (7, 10**18)],
        "id int, t long",
    )
    out = df.select("id", F.unix_seconds(ms_or_seconds_to_timestamp("t")).alias("s")).orderBy("id").collect()
    got = {r.id: r.s for r in out}
    assert got[1] == 1704067200  # B1 seconds
    assert got[2] == 1704067200  # B2 ms, fraction cut
    assert got[3] == 1000000000000  # B3 exactly 10^12 is seconds (year 33658)
    assert got[4] == 1000000000  # B4 ms -> 2001-09-09 01:46:40
    assert got[5] is None  # B5
    assert got[6] == 10**12  # large ms value
    assert got[7] is None  # 10^15 s overflows microseconds: null, not an error


def test_epoch_overflow_is_null_not_error(spark):
    df = spark.createDataFrame([(999999999999,), (-10**13,), (-2**63,), (2**63 - 1,), (9_200_000_000_000,)], "t long")
    # 999999999999 s is in range; -10^13 s would overflow microseconds; the extreme
    # bigints must give null, not an overflow error
    out = [r[0] for r in df.select(F.unix_seconds(ms_or_seconds_to_timestamp("t"))).collect()]
    assert out == [999999999999, None, None, None, 9_200_000_000]  # last two are ms values


def test_extreme_event_time_windows_do_not_overflow(spark):
    from txlens.operators import merchant_window_aggregates, user_window_stats
    from txlens.operators.clean import prepare_transactions

    # largest event time (via the ms branch) and the most negative one (seconds)
    rows = [("t1", "u", 5.0, 9_199_999_999_999_999, "M"), ("t2", "u", 5.0, -9_200_000_000_000, "M")]
    tx = prepare_transactions(spark.createDataFrame(
        rows, "transaction_id string, user_id string, amount double, transaction_time long, merchant string"
    ).select("*", F.lit(None).cast("string").alias("currency")))
    assert merchant_window_aggregates(tx).count() == 10
    assert user_window_stats(tx).count() == 2


def test_validity_filter(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("b", 0.0), ("c", -1.0), ("d", None), (None, 5.0), ("e", 0.01)], "transaction_id string, amount double"
    )
    assert sorted(r[0] for r in valid_transactions(df).collect()) == ["a", "e"]


def test_event_time_column(spark):
    df = spark.createDataFrame([("a", 1704067260)], "transaction_id string, transaction_time long")
    r = with_event_time(df).select(F.unix_seconds("transaction_timestamp")).first()[0]
    assert r == 1704067260
