"""Lost offsets and dead letters."""

import json
import random

import pytest
from pyspark.sql import functions as F

from txlens.operators.clean import clean_transactions
from txlens.operators.deadletters import classify_messages, dead_letters, rejection_report
from txlens.operators.offsets import loss_by_partition, missing_offsets
from txlens.schema import ENVELOPE_SCHEMA


def gaps_of(have, start=None, end=None):
    """Brute force: maximal runs of offsets that are not there, between the first and the last (or the ends)."""
    low, high = (min(have), max(have)) if start is None else (start, end - 1)
    out, run = [], None
    for o in range(low, high + 2):
        if o <= high and o not in have:
            run = o if run is None else run
        elif run is not None:
            out.append((run, o - 1, o - run))
            run = None
    return out


@pytest.mark.parametrize("block", [1, 7, 64, 10_000])
def test_gaps_equal_brute_force(spark, block):
    r = random.Random(block)
    logs = {(t, p): {o for o in range(300) if r.random() < share and not 100 <= o < hole} for t, p, share, hole in [("a", 0, 0.9, 0), ("a", 1, 0.5, 230), ("b", 0, 0.02, 0), ("b", 7, 1.0, 101)]}
    rows = [(t, p, o) for (t, p), have in logs.items() for o in have]
    df = spark.createDataFrame(rows + rows[:40] + [("a", 0, None)], "topic string, partition int, offset bigint").repartition(5)
    got = sorted(tuple(r) for r in missing_offsets(df, block).collect())
    assert got == sorted((t, p, *g) for (t, p), have in logs.items() for g in gaps_of(have))
    ends = spark.createDataFrame([(t, p, 0, 320) for t, p in logs] + [("c", 2, 5, 9), ("c", 3, 4, 4)], "topic string, partition int, start bigint, end bigint")
    got = sorted(tuple(r) for r in missing_offsets(df, block, ends).collect())
    assert got == sorted([(t, p, *g) for (t, p), have in logs.items() for g in gaps_of(have, 0, 320)] + [("c", 2, 5, 8, 4)])
    per = {(r["topic"], r["partition"]): (r["records"], r["lost"]) for r in loss_by_partition(missing_offsets(df, block, ends), df.where("offset IS NOT NULL")).collect()}
    assert all(per[k] == (len(have), 320 - len(have)) for k, have in logs.items()) and per[("c", 2)] == (0, 4)


def test_no_log_no_gaps(spark):
    df = spark.createDataFrame([], "topic string, partition int, offset bigint")
    assert missing_offsets(df).count() == 0


def test_a_hot_partition_is_dealt_by_blocks(spark):
    df = spark.range(100).select((F.col("id") % 2).cast("string").alias("topic"), (F.col("id") % 3).cast("int").alias("partition"), F.col("id").alias("offset"))
    plan = missing_offsets(df, 10)._jdf.queryExecution().executedPlan().toString()
    import re

    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert keys and all(k.startswith("topic") for k in keys) and "block" in keys[0]  # a partition's rows by block, its borders after


GOOD = {"transaction_id": "1", "user_id": "u", "amount": 5.0, "currency": "USD", "transaction_time": 1704067200, "merchant": "m", "is_international": True, "transaction_type": "p", "payment_method": "c"}


def message(**changes):
    return json.dumps({k: v for k, v in {**GOOD, **changes}.items() if v != "absent"})


CASES = [
    (message(), None, []),
    (message(amount=7), None, []),
    (message(amount="NaN"), None, []),  # the parser reads a quoted NaN as a number
    (message(transaction_id=5), None, []),
    (message(extra={"a": 1}), None, []),
    (message(is_international="yes"), None, ["is_international:STRING"]),
    (message(transaction_time="soon"), None, ["transaction_time:STRING"]),
    (None, "empty", []),
    ("", "empty", []),
    ("  ", "empty", []),
    ("{not json", "not_json", []),
    (message()[:30], "not_json", []),
    ("[1, 2]", "not_an_object", []),
    ("12", "not_an_object", []),
    ("null", "not_an_object", []),
    ("{}", "no_transaction_id", []),
    (message(transaction_id=None), "no_transaction_id", []),
    (message(transaction_id="absent", amount="x"), "no_transaction_id", ["amount:STRING"]),
    (message(amount=None), "no_amount", []),
    (message(amount="absent"), "no_amount", []),
    (message(amount="12.5"), "wrong_type", ["amount:STRING"]),
    (message(amount=True), "wrong_type", ["amount:BOOLEAN"]),
    (message(amount={"a": 1}), "wrong_type", ["amount:OBJECT"]),
    (message(amount=0), "amount_not_positive", []),
    (message(amount=-1.5), "amount_not_positive", []),
]


@pytest.fixture(scope="module")
def log(spark):
    rows = [(b"u", None if t is None else bytearray(t.encode()), "t", 0, i, None, 0) for i, (t, _, _) in enumerate(CASES)]
    rows.append((None, bytearray(b"\xff\xfe{"), "t", 0, len(CASES), None, 0))
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


def test_reasons(log):
    got = {r["offset"]: (r["reason"], r["wrong"]) for r in classify_messages(log).collect()}
    assert {i: got[i] for i in range(len(CASES))} == {i: (reason, wrong) for i, (_, reason, wrong) in enumerate(CASES)}
    assert got[len(CASES)][0] == "not_json"


def test_valid_and_rejected_are_the_log(log):
    valid = clean_transactions(log).count()
    assert valid + dead_letters(log).count() == log.count() and valid == sum(r is None for _, r, _ in CASES)
    assert dead_letters(log).columns == [*log.columns, "reason", "wrong"]
    report = {r["reason"]: (r["messages"], r["first_offset"], r["last_offset"]) for r in rejection_report(log).collect()}
    assert report[None][0] == valid and sum(n for n, _, _ in report.values()) == log.count() and report["empty"] == (3, 7, 9)
    assert dead_letters(log.limit(0)).count() == 0
