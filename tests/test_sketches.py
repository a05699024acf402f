"""Pane sketches against exact counts."""

import pytest
from pyspark.sql import functions as F

from helpers import epoch, prepared
from txlens.operators import sketches
from txlens.plans import batch


@pytest.fixture(scope="module")
def many(spark):
    """Three merchants, 20 minutes, up to 9,000 users a window: the sketches of 4,096 entries are full."""
    t = F.timestamp_seconds(F.lit(epoch(0, 0)) + F.pmod(F.col("id") * 7919, F.lit(1200)))
    user = F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(12_000)).cast("string"))
    return spark.range(0, 60_000, 1, 4).select(
        F.concat(F.lit("m"), (F.col("id") % 3).cast("string")).alias("merchant"), F.when(F.col("id") % 50 != 0, user).alias("user_id"), t.alias("transaction_timestamp")
    )


def exact(tx, w=300):
    return {(r["merchant"], r["window_start"]): r for r in batch._exact_user_changes(tx, w).collect()}


def test_estimates_stay_within_the_stated_bounds(many):
    want = exact(many)
    found = sketches.window_user_changes(sketches.merchant_window_sketches(sketches.merchant_pane_sketches(many))).collect()
    assert {(r["merchant"], r["window_start"]) for r in found} == set(want)
    full = 0
    for r in found:
        x = want[(r["merchant"], r["window_start"])]
        union = x["n_users"] + x["n_left"]
        full += union > 1 << sketches.LG_K
        assert abs(r["users_by_hll"] - x["n_users"]) <= 4 * sketches.hll_error() * x["n_users"]
        room = 4 * sketches.theta_error() * union if union > 1 << sketches.LG_K else 0
        assert abs(r["users_by_theta"] - x["n_users"]) <= room
        assert abs(r["entered"] - x["n_entered"]) <= room and abs(r["left"] - x["n_left"]) <= room
    assert full > 10


def test_panes_merge_to_the_sketch_of_all_rows(many):
    """Stored panes, merged in any grouping, estimate what one pass over the rows does."""
    one = many.where(F.col("transaction_timestamp") < F.timestamp_seconds(F.lit(epoch(0, 5)))).groupBy("merchant").agg(
        F.theta_sketch_estimate(F.theta_sketch_agg("user_id", sketches.LG_K)).alias("n"), F.hll_sketch_estimate(F.hll_sketch_agg("user_id", sketches.LG_K)).alias("h")
    )
    want = {r["merchant"]: (r["n"], r["h"]) for r in one.collect()}
    panes = sketches.merchant_pane_sketches(many)
    found = sketches.window_user_changes(sketches.merchant_window_sketches(panes)).where(F.col("window_start") == epoch(0, 0)).collect()
    for r in found:
        n, h = want[r["merchant"]]
        assert abs(r["users_by_theta"] - n) <= 4 * sketches.theta_error() * n and abs(r["users_by_hll"] - h) <= 4 * sketches.hll_error() * h


def test_small_windows_are_exact(spark):
    rows = [dict(transaction_id=str(i), user_id=u, amount=1.0, merchant=m, transaction_time=epoch(0, t)) for i, (m, u, t) in enumerate(
        [("a", "x", 0), ("a", "y", 0), ("a", "x", 5), ("a", "z", 5), ("a", None, 6), (None, "x", 0), ("b", None, 0)])]
    tx = prepared(spark, rows)
    found = sketches.window_user_changes(sketches.merchant_window_sketches(sketches.merchant_pane_sketches(tx))).collect()
    got = {(r["merchant"], (r["window_start"] - epoch(0, 0)) // 60): (r["users_by_theta"], r["users_by_hll"], r["entered"], r["left"]) for r in found}
    assert got[("a", 0)] == (2, 2, 2, 0)
    assert got[("a", 5)] == (2, 2, 1, 1)  # z entered, y left
    assert got[("a", 6)] == (0, 0, 0, 2) or got[("a", 6)][0] == 0  # a window of unknown users only
    assert got[(None, 0)] == (1, 1, 1, 0) and got[("b", 0)] == (0, 0, 0, 0)
    assert sketches.merchant_window_sketches(sketches.merchant_pane_sketches(tx.limit(0))).count() == 0


def test_rows_are_sketched_before_they_are_copied(many):
    plan = sketches.merchant_window_sketches(sketches.merchant_pane_sketches(many))._jdf.queryExecution().optimizedPlan().toString()
    generate, aggregate = plan.index("Generate"), plan.index("Aggregate [merchant", plan.index("Generate"))
    assert "hll_sketch_agg" in plan[aggregate:] and "hll_sketch_agg" not in plan[:generate]


def test_exact_changes_equal_sets_and_shuffle_no_row_per_user_and_window(spark):
    rows = [(m, u, epoch(0, 0) + 60 * p) for i, (m, u) in enumerate((m, u) for m in (None, "m") for u in (None, "a", "b", "c")) for p in ((i * 7) % 5, 3 * i, 3 * i + 4, 30)]
    tx = spark.createDataFrame(rows, "merchant string, user_id string, t long").selectExpr("merchant", "user_id", "timestamp_seconds(t) AS transaction_timestamp")
    users = {}
    for m, u, t in rows:
        for start in range(t - 240, t + 1, 60):
            users.setdefault((m, start), set()).add(u)
    want = {}
    for (m, start), held in users.items():
        now, then = held - {None}, users.get((m, start - 300), set()) - {None}
        want[m, start] = (len(now), len(now - then), len(then - now))
    found = batch._exact_user_changes(tx, 300)
    assert {(r["merchant"], r["window_start"]): (r["n_users"], r["n_entered"], r["n_left"]) for r in found.collect()} == want
    shuffled = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and not [x for x in shuffled if "user_id" in x and ("ws#" in x or "window_start#" in x)]
