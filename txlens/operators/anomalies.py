"""Enrich each transaction with its user's window statistics, then apply the rules.

The statistics of a transaction are those of the tumbling window that contains it
(range ``start <= ts < end``). Tumbling windows do not overlap, so the range is the
same as equality of the window start: the join is an equi-join on
(user_id, window), which both batch and streaming plans accept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.functions.columns import interval_seconds, tumbling_start_sec
from txlens.functions.rules import any_rule, high_amount, high_frequency, high_international, reasons_array
from txlens.operators.aggregates import user_window_counts, user_window_stats
from txlens.operators.joins import DEFAULT_BROADCAST_MAX_ROWS, DEFAULT_HOT_KEY_ROWS, join_small_side
from txlens.schema import (
    AMOUNT_THRESHOLD_MULTIPLIER,
    INTERNATIONAL_AMOUNT_LIMIT,
    NO_STATS_AMOUNT_LIMIT,
    TRANSACTION_COUNT_THRESHOLD,
    USER_WINDOW,
)

STAT_COLUMNS = ["transaction_count", "avg_transaction_amount"]


def enrich_user_stats(
    tx: DataFrame,
    window: str = USER_WINDOW,
    ts: str = "transaction_timestamp",
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    stream_salt_buckets: int = 1,
    stream_hot_users: Sequence[str] | None = None,
) -> DataFrame:
    """Left join of every transaction to (transaction_count, avg_transaction_amount)
    of its user's window. Output: the columns of ``tx`` + those two.

    A row without user or event time gets null statistics (it matches no group).

    Batch: one aggregate (map-side combined, so hot users shrink before the shuffle),
    then a join whose statistics side is broadcast only after its size is measured;
    beyond the limit it is a shuffle join in which (user, window) keys with more than
    ``hot_key_rows`` transactions are salted into several buckets (their counts are
    known exactly from the statistics).
    Stream: stream-stream left join on (user_id, window) with the timestamp carried
    as a plain number (a side may hold only one event-time column), and rows
    without event time routed around the join. ``stream_salt_buckets`` > 1 spreads
    each (user, window)'s buffered transactions over that many state partitions: the
    transaction gets a deterministic salt, the statistics row one copy per salt (a
    user holding a third of the stream does not sit in one state partition). With
    ``stream_hot_users`` only these users are spread and copied, all others keep salt 0;
    the list may grow between restarts of a checkpoint but not shrink.
    """
    if tx.isStreaming:
        return _enrich_stream(tx, window, ts, stream_salt_buckets, stream_hot_users)
    w = interval_seconds(window)
    keyed = tx.withColumn("_wsec", tumbling_start_sec(ts, w))
    stats = user_window_counts(tx, w, ts=ts, key="_wsec")
    joined = join_small_side(
        keyed, stats, ["user_id", "_wsec"], "left", max_rows=broadcast_max_rows, name="user-window-stats",
        count_col="transaction_count", hot_rows=hot_key_rows,
        salt_cols=[c for c in ("transaction_id", "amount", ts) if c in tx.columns],
    )
    return joined.select(*tx.columns, *STAT_COLUMNS)


def _enrich_stream(tx: DataFrame, window: str, ts: str, salt_buckets: int = 1, hot_users: Sequence[str] | None = None) -> DataFrame:
    stats = user_window_stats(tx, window, ts=ts).select("user_id", "window", *STAT_COLUMNS)
    timed = (
        tx.filter(F.col(ts).isNotNull())
        .withColumn("window", F.window(ts, window))
        .withColumn("_event_us", F.unix_micros(ts))
        .drop(ts)
    )
    keys = ["user_id", "window"]
    if salt_buckets > 1:
        salt_of = [c for c in ("transaction_id", "amount") if c in timed.columns] + ["_event_us"]
        # an empty list would be folded away, and the state's key with it; spreading one user more changes no result
        spread = F.lit(True) if hot_users is None else F.coalesce(F.col("user_id").isin(list(hot_users) or [""]), F.lit(False))
        salt = F.when(spread, F.pmod(F.xxhash64(*salt_of), F.lit(salt_buckets))).otherwise(0)
        last = F.when(spread, salt_buckets - 1).otherwise(0)
        timed = timed.withColumn("_salt", salt.cast("int"))
        stats = stats.select("*", F.explode(F.sequence(F.lit(0), last)).alias("_salt"))
        keys = keys + ["_salt"]
    joined = (
        timed.join(stats, keys, "left")
        .withColumn(ts, F.timestamp_micros("_event_us"))
        .select(*tx.columns, *STAT_COLUMNS)
    )
    untimed = tx.filter(F.col(ts).isNull()).select(
        *tx.columns,
        F.lit(None).cast("long").alias("transaction_count"),
        F.lit(None).cast("double").alias("avg_transaction_amount"),
    )
    return joined.unionByName(untimed)


def enrich_user_stats_rangejoin(
    tx: DataFrame,
    window: str = USER_WINDOW,
    ts: str = "transaction_timestamp",
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
) -> DataFrame:
    """Batch form written as the literal range join:
    ``t.user_id = s.user_id AND t.ts >= s.window.start AND t.ts < s.window.end``.

    The join also equates the window grid bin of ``t.ts`` with the window's start
    (the bin a window belongs to), so it runs as an equi-join on (user_id, bin) with
    the range kept as a residual condition -- never a pairing of a transaction with
    all windows of its user. Hot (user, bin) keys are salted as in :func:`enrich_user_stats`.
    """
    w = interval_seconds(window)
    stats = (
        user_window_stats(tx, window, ts=ts)
        .filter(F.col("user_id").isNotNull())
        .select("user_id", F.col("window").alias("_window"), *STAT_COLUMNS)
        .withColumn("_bin", F.unix_seconds(F.col("_window.start")))
    )
    joined = join_small_side(
        tx.withColumn("_bin", tumbling_start_sec(ts, w)), stats, ["user_id", "_bin"], "left",
        max_rows=broadcast_max_rows, name="user-window-stats-range",
        count_col="transaction_count", hot_rows=hot_key_rows,
        salt_cols=[c for c in ("transaction_id", "amount", ts) if c in tx.columns],
    )
    inside = (F.col(ts) >= F.col("_window.start")) & (F.col(ts) < F.col("_window.end"))
    return joined.select(*tx.columns, *[F.when(inside, F.col(c)).alias(c) for c in STAT_COLUMNS])


def with_reasons(
    enriched: DataFrame,
    multiplier: float = AMOUNT_THRESHOLD_MULTIPLIER,
    count_threshold: int = TRANSACTION_COUNT_THRESHOLD,
    no_stats_limit: float = NO_STATS_AMOUNT_LIMIT,
    international_limit: float = INTERNATIONAL_AMOUNT_LIMIT,
) -> DataFrame:
    """Add ``anomaly_reasons`` (array<string>, empty when no rule is hit)."""
    return enriched.withColumn(
        "anomaly_reasons",
        reasons_array(
            high_amount(multiplier, no_stats_limit),
            high_frequency(count_threshold),
            high_international(international_limit),
        ),
    )


def detect_anomalies(
    enriched: DataFrame,
    multiplier: float = AMOUNT_THRESHOLD_MULTIPLIER,
    count_threshold: int = TRANSACTION_COUNT_THRESHOLD,
    no_stats_limit: float = NO_STATS_AMOUNT_LIMIT,
    international_limit: float = INTERNATIONAL_AMOUNT_LIMIT,
    detected_at: bool = True,
) -> DataFrame:
    """Rows hitting at least one rule, with ``anomaly_reasons`` and ``detected_at``.

    The filter is the OR of the three rules (nulls count as no); the reasons array is
    built only for the rows that pass. All of it is plain comparisons and array
    concatenation, inside whole-stage codegen.
    """
    rules = (
        high_amount(multiplier, no_stats_limit),
        high_frequency(count_threshold),
        high_international(international_limit),
    )
    out = enriched.filter(any_rule(*rules)).withColumn("anomaly_reasons", reasons_array(*rules))
    if detected_at:
        out = out.withColumn("detected_at", F.current_timestamp())
    return out


def anomalies(tx: DataFrame, window: str = USER_WINDOW, **rule_params) -> DataFrame:
    """enrich -> rules: the anomaly relation of valid transactions."""
    return detect_anomalies(enrich_user_stats(tx, window), **rule_params)
