"""Distinct users of merchant windows from mergeable sketches over panes.

Each (merchant, pane) keeps two fixed-size sketches of its users: HyperLogLog for the count and theta
for set operations. A window's users are the union of its panes' sketches, so rows are sketched once
and only sketches, one per pane, are copied to the windows that hold the pane (a row's user never is).
Panes can be stored and merged later, over any windows that are made of whole panes, and a stream keeps
one sketch per merchant and pane as its state. Theta sketches also give the users that entered or left
between a window and the one right before it.

Stated errors: a HyperLogLog sketch of 2^k registers has a relative standard error of 1.04 / sqrt(2^k);
a theta sketch of 2^k entries counts up to 2^k users exactly, beyond that with 1 / sqrt(2^k - 1) of
the union that it is part of.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.functions.columns import epoch_seconds, interval_seconds, pane_start, window_starts_for_pane
from txlens.schema import MERCHANT_SLIDE, MERCHANT_WINDOW

#: log2 of a sketch's registers (entries).
LG_K = 12


def hll_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a HyperLogLog count."""
    return 1.04 / math.sqrt(1 << lg_k)


def theta_error(lg_k: int = LG_K) -> float:
    """Standard error of a theta estimate, relative to the union it is part of (0 up to 2^lg_k users)."""
    return 1 / math.sqrt((1 << lg_k) - 1)


def merchant_pane_sketches(tx: DataFrame, pane: str = MERCHANT_SLIDE, ts: str = "transaction_timestamp", lg_k: int = LG_K) -> DataFrame:
    """(merchant, pane_start second, users_hll, users_theta), batch or stream (the window's own state: one row
    per merchant and pane, whatever the number of users). Null users are in no sketch."""
    w = interval_seconds(pane)
    aggs = [F.hll_sketch_agg("user_id", lg_k).alias("users_hll"), F.theta_sketch_agg("user_id", lg_k).alias("users_theta")]
    if tx.isStreaming:
        g = tx.groupBy(F.col("merchant"), F.window(ts, pane).alias("window")).agg(*aggs)
        return g.select("merchant", F.unix_seconds("window.start").alias("pane_start"), "users_hll", "users_theta")
    timed = tx.filter(F.col(ts).isNotNull()).withColumn("pane_start", pane_start(epoch_seconds(ts), w))
    return timed.groupBy("merchant", "pane_start").agg(*aggs)


def merchant_window_sketches(panes: DataFrame, window: str = MERCHANT_WINDOW, slide: str = MERCHANT_SLIDE, lg_k: int = LG_K) -> DataFrame:
    """(merchant, window_start second, users_hll, users_theta): panes' sketches united per window. The panes'
    width divides both window and slide."""
    starts = window_starts_for_pane(F.col("pane_start"), interval_seconds(window), interval_seconds(slide))
    copied = panes.select("merchant", F.explode(starts).alias("window_start"), "users_hll", "users_theta")
    return copied.groupBy("merchant", "window_start").agg(F.hll_union_agg("users_hll").alias("users_hll"), F.theta_union_agg("users_theta", lg_k).alias("users_theta"))


def window_user_changes(windows: DataFrame, window: str = MERCHANT_WINDOW, lg_k: int = LG_K) -> DataFrame:
    """Estimates per (merchant, window_start): users (by HyperLogLog and by theta), users that were not in the
    window right before it (entered) and users of that one that are gone (left). Where the merchant
    has no window right before, all its users entered."""
    before = windows.select(F.col("merchant").alias("_m"), (F.col("window_start") + interval_seconds(window)).alias("_w"), F.col("users_theta").alias("_theta"))
    same = F.col("merchant").eqNullSafe(F.col("_m")) & (F.col("window_start") == F.col("_w"))
    both = windows.join(before, same, "left")

    def count(sketch: Column) -> Column:
        return F.theta_sketch_estimate(sketch).cast("bigint")

    users = count(F.col("users_theta"))
    none = F.col("_theta").isNull()
    return both.select(
        "merchant",
        "window_start",
        F.hll_sketch_estimate("users_hll").alias("users_by_hll"),
        users.alias("users_by_theta"),
        F.when(none, users).otherwise(count(F.theta_difference("users_theta", "_theta"))).alias("entered"),
        F.when(none, F.lit(0).cast("bigint")).otherwise(count(F.theta_difference("_theta", "users_theta"))).alias("left"),
        F.when(none, users).otherwise(count(F.theta_union("users_theta", "_theta", lg_k))).alias("union"),
    )
