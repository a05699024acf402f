"""JSON encoding of the outputs (FIXTURES.md section 5 G) and the envelope round trip."""

import json

from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import prepared, tx_rows
from txlens.functions.json import encode_json
from txlens.operators import encode_aggregates, merchant_window_aggregates
from txlens.operators.clean import parse_transactions
from txlens.plans import batch
from txlens.schema import TRANSACTION_FIELDS
from txlens.sources.envelope import publish_transactions, read_envelope, to_envelope


def test_json_nulls_and_timestamps(spark):
    df = spark.sql(
        "select 'a' as k, cast(null as string) as n, array('x', null) as arr, "
        "timestamp_micros(1704067200500000) as t"
    )
    v = json.loads(df.select(encode_json("k", "n", "arr", "t").alias("v")).first().v)
    assert "n" not in v
    assert v["arr"] == ["x", None]
    assert v["t"] == "2024-01-01T00:00:00.500Z"
    kept = json.loads(df.select(encode_json("k", "n", keep_nulls=True).alias("v")).first().v)
    assert kept == {"k": "a", "n": None}


def test_encode_aggregates_keys(spark):
    enc = encode_aggregates(merchant_window_aggregates(batch.transactions(spark, SF_SMALL)))
    r = enc.where("key IS NOT NULL").first()
    v = json.loads(r.value)
    assert r.key == v["merchant"]
    assert list(v) == [
        "merchant", "window_start", "window_end", "total_transactions", "total_amount",
        "average_amount", "min_amount", "max_amount", "unique_users", "currencies_used",
    ]


def test_envelope_round_trip(spark, tmp_shared):
    fields = batch.fields(spark, SF_SMALL)
    publish_transactions(fields, tmp_shared, offset="transaction_id")
    env = read_envelope(spark, tmp_shared)
    assert env.count() == fields.count()
    back = parse_transactions(env).select(*TRANSACTION_FIELDS)
    assert back.exceptAll(fields).count() == 0 and fields.exceptAll(back).count() == 0
    e = env.first()
    assert e.key is None or e.key.decode() == json.loads(e.value.decode())["user_id"]
    # one key always maps to one partition
    per_key = env.groupBy("key").agg(F.count_distinct("partition").alias("p"))
    assert per_key.filter("p > 1").count() == 0
    assert env.select("partition").distinct().count() <= 12


def test_envelope_keeps_nulls_in_value(spark):
    df = tx_rows(spark, [{"transaction_id": "t1", "user_id": "u1"}])
    v = json.loads(to_envelope(df).first().value.decode())
    assert v == {f: {"transaction_id": "t1", "user_id": "u1"}.get(f) for f in TRANSACTION_FIELDS}


def test_null_merchant_gives_null_key_and_no_field(spark):
    from txlens.operators.encode import encode_aggregates

    tx = prepared(spark, [{"transaction_id": "a", "user_id": "u", "amount": 1.5, "transaction_time": 1704067200}])
    r = encode_aggregates(merchant_window_aggregates(tx)).first()
    v = json.loads(r.value)
    assert r.key is None and "merchant" not in v
    assert (v["total_transactions"], v["total_amount"], v["currencies_used"]) == (1, 1.5, [])


def test_landing_is_date_partitioned_and_pruned(spark, tmp_shared):
    import datetime as dt

    from txlens.operators.clean import land_transactions

    fields = batch.fields(spark, SF_SMALL)
    log = f"{tmp_shared}/log"
    publish_transactions(fields, log, offset="transaction_id")
    landed = f"{tmp_shared}/landed"
    land_transactions(read_envelope(spark, log), landed)
    t = spark.read.parquet(landed)
    assert t.count() == batch.transactions(spark, SF_SMALL).count() and "event_date" in t.columns
    day = t.filter(F.col("event_date") == F.lit(dt.date(2024, 1, 1)))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert day.count() == t.filter(F.to_date(F.col("transaction_timestamp")) == F.lit(dt.date(2024, 1, 1))).count()
