"""Windowed aggregates: per merchant over sliding windows, per user over tumbling windows.

Sums and averages are plain double sums and averages of the amounts, so NaN and infinite
amounts carry through and totals may differ in the last bits with the order of summation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlens.functions.columns import (
    epoch_seconds,
    interval_seconds,
    pane_start,
    tumbling_start_sec,
    window_starts_for_pane,
)
from txlens.schema import MERCHANT_AGG_COLUMNS, MERCHANT_SLIDE, MERCHANT_WINDOW, USER_WINDOW

#: Slides in a time range of the form by frames (about four hours of one-minute slides).
RANGE_SLIDES = 256


def _money(total: str, n_amount: str, out_total: str, out_avg: str) -> list[Column]:
    """The total and the average from a sum and the number of non-null amounts in it."""
    return [F.col(total).alias(out_total), F.try_divide(F.col(total), F.col(n_amount).cast("double")).alias(out_avg)]


def _parts() -> list[Column]:
    """The mergeable parts of the numeric aggregates."""
    return [
        F.count(F.lit(1)).alias("_n"),
        F.sum("amount").alias("_total"),
        F.count("amount").alias("_n_amount"),
        F.min("amount").alias("_min"),
        F.max("amount").alias("_max"),
    ]


def _merged() -> list[Column]:
    return [
        F.sum("_n").alias("total_transactions"),
        F.sum("_total").alias("_total"),
        F.sum("_n_amount").alias("_n_amount"),
        F.min("_min").alias("min_amount"),
        F.max("_max").alias("max_amount"),
    ]


def merchant_window_aggregates(
    tx: DataFrame,
    window: str = MERCHANT_WINDOW,
    slide: str = MERCHANT_SLIDE,
    exact_distinct: bool = True,
    ts: str = "transaction_timestamp",
) -> DataFrame:
    """Per (merchant, sliding window): count, total, average, min, max of amount,
    distinct users, sorted set of currencies. Columns as ``MERCHANT_AGG_COLUMNS``.

    Batch: pane pre-aggregation, pane = gcd(window, slide) seconds. Numeric parts and
    currencies are reduced to one row per (merchant, pane, currency) before they are
    expanded to the windows. Users are reduced to one row per (merchant, user, pane); by
    the pane before it, a row is expanded only to the windows that the user did not
    enter already, so every (merchant, window, user) arises once and a plain count with
    map-side combine is the number of distinct users. Stream: Spark's windowed state;
    distinct users as the size of the user set (streaming count-distinct is not
    supported) or, with ``exact_distinct=False``, a fixed-size HyperLogLog sketch. For
    merchants of very many users see :func:`merchant_window_buckets` and
    :func:`merchant_window_closed`.
    """
    if tx.isStreaming:
        return _merchant_stream(tx, window, slide, exact_distinct, ts)
    return _merchant_batch(tx, window, slide, exact_distinct, ts)


def _merchant_stream(tx: DataFrame, window: str, slide: str, exact_distinct: bool, ts: str) -> DataFrame:
    users = F.size(F.collect_set("user_id")) if exact_distinct else F.approx_count_distinct("user_id")
    g = tx.groupBy(F.col("merchant"), F.window(ts, window, slide).alias("window")).agg(
        *_parts(), users.cast("long").alias("unique_users"), F.sort_array(F.collect_set("currency")).alias("currencies_used")
    )
    return g.select(
        "merchant",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("_n").alias("total_transactions"),
        *_money("_total", "_n_amount", "total_amount", "average_amount"),
        F.col("_min").alias("min_amount"),
        F.col("_max").alias("max_amount"),
        "unique_users",
        "currencies_used",
    ).select(*MERCHANT_AGG_COLUMNS)


def merchant_window_buckets(
    tx: DataFrame,
    buckets: int,
    window: str = MERCHANT_WINDOW,
    slide: str = MERCHANT_SLIDE,
    ts: str = "transaction_timestamp",
) -> DataFrame:
    """The parts of the merchant aggregates per (merchant, window, bucket of users).

    One stateful aggregate, so update mode stays possible, but a merchant's users are
    spread over ``buckets`` state rows and partitions. A user is in one bucket only, so
    the parts of a window's buckets add up: see :func:`merge_buckets`.
    """
    bucket = F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int").alias("bucket")
    g = tx.groupBy(F.col("merchant"), F.window(ts, window, slide).alias("window"), bucket).agg(
        *_parts(), F.size(F.collect_set("user_id")).cast("long").alias("_users"), F.sort_array(F.collect_set("currency")).alias("_currencies")
    )
    return g.select(
        "merchant", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "bucket", "_n", "_total", "_n_amount", "_min", "_max", "_users", "_currencies",
    )


def merge_buckets(parts: DataFrame) -> DataFrame:
    """The merchant aggregates from the latest parts of each (merchant, window, bucket)."""
    g = parts.groupBy("merchant", "window_start", "window_end").agg(
        *_merged(), F.sum("_users").alias("unique_users"), F.collect_set("_currencies").alias("_sets")
    )
    return g.select(
        "merchant",
        "window_start",
        "window_end",
        "total_transactions",
        *_money("_total", "_n_amount", "total_amount", "average_amount"),
        "min_amount",
        "max_amount",
        "unique_users",
        F.sort_array(F.array_distinct(F.flatten("_sets"))).alias("currencies_used"),
    )


def merchant_window_closed(
    tx: DataFrame,
    window: str = MERCHANT_WINDOW,
    slide: str = MERCHANT_SLIDE,
    ts: str = "transaction_timestamp",
    readable_state: bool = False,
) -> DataFrame:
    """The merchant aggregates of closed windows, for append mode: each window once, when the
    watermark passes it. Two chained stateful aggregates: state keyed by (merchant,
    window, user), spread over partitions, holding that user's currency set; then per
    (merchant, window) sums, the user count and the distinct currency subsets.

    With ``readable_state`` the first state is keyed by (merchant, window, user, currency) and
    holds numbers only, so that the state data source can read the open windows
    (``streaming.state.open_merchant_windows``). A row goes in once for its user, with the amount, and
    once for its currency; so a window has a row for each user and one for each currency, and when
    it closes they are counted without going through the users again."""
    keys = [F.col("merchant"), F.window(ts, window, slide).alias("window"), F.col("user_id")]
    if readable_state:
        _, *amounts = _parts()
        rows = _user_and_currency_rows(tx, ts)
        return finish_merchant_parts(rows.groupBy(*keys, F.col("currency")).agg(F.count("_row").alias("_n"), *amounts))
    per_user = tx.groupBy(*keys).agg(*_parts(), F.sort_array(F.collect_set("currency")).alias("_currencies"))
    return _closed_merchants(per_user)


def _user_and_currency_rows(tx: DataFrame, ts: str) -> DataFrame:
    """Each row twice: with its user, amount and a mark (``_row``), and with its currency only."""
    kind = {c: tx.schema[c].dataType for c in ("user_id", "amount", "currency")} | {"_row": "int"}

    def one(**own: Column) -> Column:
        return F.struct(*[own.get(c, F.lit(None)).cast(t).alias(c) for c, t in kind.items()])

    both = F.array(one(user_id=F.col("user_id"), amount=F.col("amount"), _row=F.lit(1)), one(currency=F.col("currency")))
    return tx.select("merchant", ts, F.explode(both).alias("_side")).select("merchant", ts, "_side.*")


def finish_merchant_parts(parts: DataFrame) -> DataFrame:
    """The merchant aggregates, batch or stream, from parts per (merchant, window, user) without a currency and
    per (merchant, window, currency) without a user or numbers. Numbers only are aggregated first, so that all
    users of a merchant and window are one row before a shuffle; sets are made of what is left."""
    per_currency = parts.groupBy("merchant", "window", "currency").agg(
        F.sum("_n").alias("_n"),
        F.sum("_total").alias("_total"),
        F.sum("_n_amount").alias("_n_amount"),
        F.min("_min").alias("_min"),
        F.max("_max").alias("_max"),
        F.count("user_id").alias("_users"),
    )
    g = per_currency.groupBy("merchant", "window").agg(
        *_merged(), F.sum("_users").alias("unique_users"), F.sort_array(F.collect_set("currency")).alias("currencies_used")
    )
    return _merchant_columns(g, F.col("currencies_used"))


def _closed_merchants(per_user: DataFrame) -> DataFrame:
    g = per_user.groupBy("merchant", "window").agg(
        *_merged(), F.count("user_id").alias("unique_users"), F.collect_set("_currencies").alias("_sets")
    )
    return _merchant_columns(g, F.sort_array(F.array_distinct(F.flatten("_sets"))))


def _merchant_columns(g: DataFrame, currencies: Column) -> DataFrame:
    return g.select(
        "merchant",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "total_transactions",
        *_money("_total", "_n_amount", "total_amount", "average_amount"),
        "min_amount",
        "max_amount",
        "unique_users",
        currencies.alias("currencies_used"),
    )


def _merchant_batch(tx: DataFrame, window: str, slide: str, exact_distinct: bool, ts: str) -> DataFrame:
    w, s = interval_seconds(window), interval_seconds(slide)
    pane = math.gcd(w, s)
    timed = tx.filter(F.col(ts).isNotNull()).select(
        "merchant", "user_id", "currency", "amount", pane_start(epoch_seconds(ts), pane).alias("_pane")
    )
    starts = window_starts_for_pane(F.col("_pane"), w, s)
    sums = (
        timed.groupBy("merchant", "_pane", "currency")
        .agg(*_parts())
        .select("*", F.explode(starts).alias("_ws"))
        .groupBy("merchant", "_ws")
        .agg(*_merged(), F.sort_array(F.collect_set("currency")).alias("currencies_used"))
    )
    return _with_users(sums, timed, w, s, exact_distinct)


def _with_users(sums: DataFrame, timed: DataFrame, w: int, s: int, exact_distinct: bool) -> DataFrame:
    """The merchant aggregates from the numeric ones per (merchant, _ws) and the rows by pane, which give the users."""
    seen = timed.filter(F.col("user_id").isNotNull()).select("merchant", "user_id", "_pane").distinct()
    if exact_distinct:
        before = F.lag("_pane").over(Window.partitionBy("merchant", "user_id").orderBy("_pane"))
        entered = _starts_after(F.col("_pane"), F.col("_before"), w, s)
        users = seen.withColumn("_before", before).select("merchant", F.explode(entered).alias("_ws")).groupBy("merchant", "_ws").agg(F.count(F.lit(1)).alias("_users"))
    else:
        starts = window_starts_for_pane(F.col("_pane"), w, s)
        users = seen.select("merchant", "user_id", F.explode(starts).alias("_ws")).groupBy("merchant", "_ws").agg(F.approx_count_distinct("user_id").alias("_users"))
    u = users.withColumnsRenamed({"merchant": "_merchant", "_ws": "_start"})
    g = sums.join(u, F.col("merchant").eqNullSafe(F.col("_merchant")) & (F.col("_ws") == F.col("_start")), "left")
    return g.select(
        "merchant",
        F.timestamp_seconds("_ws").alias("window_start"),
        F.timestamp_seconds(F.col("_ws") + F.lit(w)).alias("window_end"),
        "total_transactions",
        *_money("_total", "_n_amount", "total_amount", "average_amount"),
        "min_amount",
        "max_amount",
        F.coalesce("_users", F.lit(0).cast("long")).alias("unique_users"),
        "currencies_used",
    )


def merchant_window_aggregates_by_frames(
    tx: DataFrame,
    window: str = MERCHANT_WINDOW,
    slide: str = MERCHANT_SLIDE,
    exact_distinct: bool = True,
    ts: str = "transaction_timestamp",
    range_slides: int = RANGE_SLIDES,
) -> DataFrame:
    """The batch merchant aggregates with the numeric part by ordered RANGE frames: same columns and rows as
    :func:`merchant_window_aggregates`.

    Rows are reduced to one per (merchant, pane). Time is cut into ranges of ``range_slides`` slides (at least a
    window), so a merchant is as many tasks as it has ranges; a range also holds the panes of its windows that lie in
    the next one, at most one window of them. A window belongs to the range of its start, and its values are the frame
    from its start to its last pane. Starts that have no pane of their own are put between the panes as empty rows, one
    for each window that will come out; the panes themselves are not copied to their windows.
    """
    w, s = interval_seconds(window), interval_seconds(slide)
    pane = math.gcd(w, s)
    width = max(range_slides, math.ceil(w / s)) * s
    timed = tx.filter(F.col(ts).isNotNull()).select(
        "merchant", "user_id", "currency", "amount", pane_start(epoch_seconds(ts), pane).alias("_pane")
    )
    # _at is the pane as an aggregate, so that the filter of the copies stays above the aggregation and both
    # branches of the union read the same shuffled rows
    panes = timed.groupBy("merchant", "_pane").agg(*_parts(), F.collect_set("currency").alias("_currencies"), F.max("_pane").alias("_at"))
    values = ["_n", "_total", "_n_amount", "_min", "_max", "_currencies"]
    first = F.col("_at") - F.pmod(F.col("_at"), F.lit(width))
    own = panes.select("merchant", first.alias("_range"), "_at", *values)
    ahead = panes.where(F.col("_at") - first < w - pane).select("merchant", (first - width).alias("_range"), "_at", *values)
    by_range = Window.partitionBy("merchant", "_range")
    placed = own.unionByName(ahead).withColumn("_before", F.lag("_at").over(by_range.orderBy("_at")))
    places = F.array_union(F.array("_at"), _starts_until(F.col("_at"), F.col("_before"), F.col("_range"), w, s, width))
    here = F.col("_ws") == F.col("_at")
    rows = placed.select("*", F.explode(places).alias("_ws")).select(
        "merchant", "_range", "_ws", *[F.when(here, F.col(c)).alias(c) for c in values]
    )
    frame = by_range.orderBy("_ws").rangeBetween(0, w - pane)
    sums = rows.select(
        "merchant",
        "_range",
        "_ws",
        F.sum("_n").over(frame).alias("total_transactions"),
        F.sum("_total").over(frame).alias("_total"),
        F.sum("_n_amount").over(frame).alias("_n_amount"),
        F.min("_min").over(frame).alias("min_amount"),
        F.max("_max").over(frame).alias("max_amount"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("_currencies").over(frame)))).alias("currencies_used"),
    )
    is_start = (F.pmod("_ws", F.lit(s)) == 0) & (F.col("_ws") < F.col("_range") + width) & F.col("total_transactions").isNotNull()
    return _with_users(sums.where(is_start).drop("_range"), timed, w, s, exact_distinct)


def _starts_until(pane: Column, before: Column, range_start: Column, window: int, slide: int, width: int) -> Column:
    """The window starts inside a range after the pane ``before`` (any, if that is null) whose windows hold ``pane``;
    an empty array if there is none."""
    low = F.greatest(pane - F.lit(window) + 1, before + 1, range_start)
    low = low + F.pmod(-low, F.lit(slide))
    last = F.least(pane - F.pmod(pane, F.lit(slide)), range_start + F.lit(width - slide))
    none = F.array().cast("array<bigint>")
    return F.when(low <= last, F.sequence(low, last, F.lit(slide).cast("long"))).otherwise(none)


def _starts_after(pane: Column, before: Column, window: int, slide: int) -> Column:
    """The window starts of ``pane`` that are not window starts of the earlier pane ``before``
    (all of them if that is null): those after the last start of ``before``."""
    last = before - F.pmod(before, F.lit(slide))
    base = pane - F.pmod(pane, F.lit(slide))
    d = base - pane + F.lit(window)
    low = base - (F.ceil(d / F.lit(slide)).cast("long") - 1) * F.lit(slide)
    low = F.when(before.isNull(), low).otherwise(F.greatest(low, last + F.lit(slide)))
    return F.when((d > 0) & (low <= base), F.sequence(low, base, F.lit(slide).cast("long")))


def user_window_stats(
    tx: DataFrame,
    window: str = USER_WINDOW,
    ts: str = "transaction_timestamp",
) -> DataFrame:
    """Per (user_id, tumbling window): transaction_count, total_spent,
    avg_transaction_amount, stddev_amount (sample; null for one row),
    max_amount_in_window. ``window`` is a struct<start, end> as made by ``F.window``.

    Every aggregate is algebraic, so a hot user is reduced map-side before the
    shuffle on (user_id, window).
    """
    aggs = [
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("amount").alias("total_spent"),
        F.avg("amount").alias("avg_transaction_amount"),
        F.stddev_samp("amount").alias("stddev_amount"),
        F.max("amount").alias("max_amount_in_window"),
    ]
    names = ["transaction_count", "total_spent", "avg_transaction_amount", "stddev_amount", "max_amount_in_window"]
    if tx.isStreaming:
        g = tx.groupBy(F.col("user_id"), F.window(ts, window).alias("window")).agg(*aggs)
        return g.select("user_id", "window", *names)
    w = interval_seconds(window)
    g = tx.filter(F.col(ts).isNotNull()).withColumn("_wsec", tumbling_start_sec(ts, w)).groupBy("user_id", "_wsec").agg(*aggs)
    win = F.struct(
        F.timestamp_seconds("_wsec").alias("start"),
        F.timestamp_seconds(F.col("_wsec") + F.lit(w)).alias("end"),
    )
    return g.select("user_id", win.alias("window"), *names)


def user_window_counts(
    tx: DataFrame,
    window_seconds: int,
    ts: str = "transaction_timestamp",
    key: str = "_wsec",
) -> DataFrame:
    """Batch helper for the enrichment: (user_id, window start second) ->
    transaction_count, avg_transaction_amount. Rows without user or time form no group."""
    return (
        tx.filter(F.col("user_id").isNotNull() & F.col(ts).isNotNull())
        .select("user_id", "amount", tumbling_start_sec(ts, window_seconds).alias(key))
        .groupBy("user_id", key)
        .agg(F.count(F.lit(1)).alias("transaction_count"), F.avg("amount").alias("avg_transaction_amount"))
    )
