"""Batch queries over the supplied tables, in a shape DuckDB can reproduce.

Each function takes (spark, sf_dir) and returns a DataFrame. Timestamps are shown as
epoch seconds and arrays as comma-joined text so the two engines' values compare
directly; the operators themselves return timestamps and arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txlens.functions.columns import interval_seconds, tumbling_start_sec, window_starts_for_pane
from txlens.functions.exact import exact_totals, limb_sums, merge_limb_sums
from txlens.operators import (
    detect_anomalies,
    encode_aggregates,
    encode_anomalies,
    enrich_user_stats,
    enrich_user_stats_rangejoin,
    merchant_window_aggregates,
    parse_transactions,
    record_size_profile,
    sliding_window_expand,
    throughput_by_worker,
    throughput_overall,
    user_window_stats,
    valid_transactions,
    with_event_time,
)
from txlens.operators.aggregates import _starts_after, merchant_window_aggregates_by_frames
from txlens.operators.anomalies import with_reasons
from txlens.operators.clean import prepare_transactions
from txlens.operators.deadletters import dead_letters
from txlens.operators.lateness import KLL_ERROR, delay_for_share, late_rows_by_batch, with_lateness
from txlens.operators.offsets import missing_offsets
from txlens.operators.sketches import LG_K, hll_error, merchant_pane_sketches, merchant_window_sketches, theta_error, window_user_changes
from txlens.operators.storage import storage_by_field
from txlens.schema import (
    ANOMALY_COLUMNS,
    MERCHANT_AGG_COLUMNS,
    MERCHANT_SLIDE,
    MERCHANT_WINDOW,
    TOPIC_PARTITIONS,
    TRANSACTION_FIELDS,
    TRANSACTION_SCHEMA,
    USER_WINDOW,
)
from txlens.session import scratch_path
from txlens.sources import fixtures
from txlens.sources.fixtures import FIXTURE_ORIGIN_MICROS
from txlens.sources.envelope import publish_transactions, read_envelope
from txlens.sources.generate import generate_transactions

TS = "transaction_timestamp"
# Fixed values of the log with late rows: micro-batches, seconds of event time in one.
LATE_SPLITS, LATE_SPLIT_SECONDS = 8, 2700
SHARES = (0.5, 0.9, 0.99, 0.999)
# Records that are gone from the lossy log (SQL over offset and partition).
LOST = "(offset % 37 BETWEEN 5 AND 7 OR (partition = 4 AND offset BETWEEN 100 AND 380) OR (partition = 7 AND offset % 64 = 0) OR (offset * 12 + partition) % 1009 = 3)"
# Fixed shift of the comparison views' rounding: ties of short decimals never meet it.
ROUNDING_SHIFT = 0.2718281828


def shown(c: str) -> Column:
    """A double as both engines show it, whatever the order of a summation: whole multiples of
    1e-4 (of 1e9 from there on); NaN as -1 and infinity as -2, which no amount or statistic is.
    Only the comparison views round; the operators return plain doubles."""
    x = F.col(c)
    small = F.floor(x * F.lit(1e4) + F.lit(ROUNDING_SHIFT)).cast("double") / F.lit(1e4)
    large = F.floor(x / F.lit(1e9) + F.lit(ROUNDING_SHIFT)).cast("double") * F.lit(1e9)
    return (
        F.when(F.isnan(x), F.lit(-1.0))
        .when(x == F.lit(float("inf")), F.lit(-2.0))
        .when(F.abs(x) < F.lit(1e9), small)
        .otherwise(large)
        .alias(c.split(".")[-1])
    )


def _sec(c: str = TS):
    return F.unix_seconds(c)


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine transaction fields derived from ``events``."""
    return fixtures.fixture_transactions(spark, sf_dir)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid transactions with event time and watermark (the shared input)."""
    return prepare_transactions(fields(spark, sf_dir))


def _envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.fixture_envelope(spark, sf_dir)


def _shown_fields() -> list:
    return [shown(f) if f == "amount" else F.col(f) for f in TRANSACTION_FIELDS]


def _merchant_view(agg: DataFrame, *extra: str) -> DataFrame:
    return agg.select(
        *extra,
        "merchant",
        F.unix_seconds("window_start").alias("window_start"),
        F.unix_seconds("window_end").alias("window_end"),
        "total_transactions",
        shown("total_amount"),
        shown("average_amount"),
        shown("min_amount"),
        shown("max_amount"),
        "unique_users",
        F.array_join("currencies_used", ",").alias("currencies_used"),
    )


def _user_view(stats: DataFrame) -> DataFrame:
    return stats.select(
        "user_id",
        F.unix_seconds("window.start").alias("window_start"),
        F.unix_seconds("window.end").alias("window_end"),
        "transaction_count",
        shown("total_spent"),
        shown("avg_transaction_amount"),
        shown("stddev_amount"),
        shown("max_amount_in_window"),
    )


def _enriched_view(df: DataFrame) -> DataFrame:
    return df.select(
        "transaction_id",
        "user_id",
        shown("amount"),
        _sec().alias("event_sec"),
        "transaction_count",
        shown("avg_transaction_amount"),
    )


def _anomaly_view(df: DataFrame) -> DataFrame:
    return df.select(
        "transaction_id",
        "user_id",
        shown("amount"),
        "merchant",
        _sec().alias("event_sec"),
        "is_international",
        "transaction_count",
        shown("avg_transaction_amount"),
        F.array_join("anomaly_reasons", ",").alias("anomaly_reasons"),
    )


# ---- scans and projections -------------------------------------------------

def envelope_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the transactions as keyed JSON records to a file log and scan it back: the record's
    own columns, and every field of its message."""
    path = scratch_path(spark, "envelope")
    tx = fixtures.fixture_transactions(spark, sf_dir, keep_id=True)
    publish_transactions(tx, path, offset="event_id")
    env = read_envelope(spark, path)
    message = F.from_json(F.col("value").cast("string"), TRANSACTION_SCHEMA)
    records = env.select(
        F.col("key").cast("string").alias("key"),
        "topic",
        "partition",
        "offset",
        F.unix_seconds("timestamp").alias("timestamp_sec"),
        "timestampType",
        message.alias("m"),
    )
    return records.select(
        "key",
        "topic",
        F.coalesce(F.col("partition").between(0, TOPIC_PARTITIONS - 1), F.col("key").isNull()).alias("partition_valid"),
        "offset",
        "timestamp_sec",
        "timestampType",
        *[shown("m.amount") if f == "amount" else F.col(f"m.{f}") for f in TRANSACTION_FIELDS],
    )


def q_parse_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_transactions(_envelope(spark, sf_dir), TRANSACTION_SCHEMA)
    return parsed.select(*_shown_fields(), F.unix_seconds("kafka_timestamp").alias("kafka_timestamp_sec"))


def q_normalize_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_time(fields(spark, sf_dir)).select(
        "transaction_id", "transaction_time", _sec().alias("event_sec")
    )


def q_valid_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_transactions(with_event_time(fields(spark, sf_dir))).select(*_shown_fields(), _sec().alias("event_sec"))


def q_sliding_window_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = sliding_window_expand(transactions(spark, sf_dir))
    return w.select(
        "transaction_id",
        F.unix_seconds("window.start").alias("window_start"),
        F.unix_seconds("window.end").alias("window_end"),
    )


# ---- aggregates --------------------------------------------------------------

def q_merchant_window_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merchant_view(merchant_window_aggregates(transactions(spark, sf_dir)))


def q_merchant_window_aggregates_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merchant_view(merchant_window_aggregates_by_frames(transactions(spark, sf_dir)))


def q_user_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_view(user_window_stats(transactions(spark, sf_dir)))


def q_user_window_exact_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total and mean per user and window that do not depend on the order of rows, bit for bit."""
    tx = transactions(spark, sf_dir).filter(F.col(TS).isNotNull()).select("user_id", tumbling_start_sec(TS, interval_seconds(USER_WINDOW)).alias("window_start"), "amount")
    return _exact_view(exact_totals(limb_sums(tx, ["user_id", "window_start"], "amount"), ["user_id", "window_start"]), "user_id")


def q_merchant_window_exact_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per merchant and sliding window, from the limb sums of one-minute panes."""
    window, slide = interval_seconds(MERCHANT_WINDOW), interval_seconds(MERCHANT_SLIDE)
    tx = transactions(spark, sf_dir).filter(F.col(TS).isNotNull()).select("merchant", tumbling_start_sec(TS, slide).alias("pane"), "amount")
    panes = limb_sums(tx, ["merchant", "pane"], "amount")
    windows = panes.select("*", F.explode(window_starts_for_pane(F.col("pane"), window, slide)).alias("window_start"))
    return _exact_view(exact_totals(merge_limb_sums(windows, ["merchant", "window_start"]), ["merchant", "window_start"]), "merchant")


def q_merchant_window_user_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users of merchant windows, and those that entered and left since the window before:
    the exact numbers, and whether the sketches of panes are within four standard errors of them."""
    tx = transactions(spark, sf_dir)
    return _sketch_view(tx, merchant_pane_sketches(tx))


def _sketch_view(tx: DataFrame, panes: DataFrame) -> DataFrame:
    w = interval_seconds(MERCHANT_WINDOW)
    found = window_user_changes(merchant_window_sketches(panes))
    exact = _exact_user_changes(tx, w).withColumnsRenamed({"merchant": "_m", "window_start": "_w"})
    both = exact.join(found, F.col("merchant").eqNullSafe(F.col("_m")) & (F.col("window_start") == F.col("_w")), "left")
    union = F.col("n_users") + F.col("n_left")
    small = union <= (1 << LG_K)  # a theta sketch that is not full counts exactly

    def within(estimate: str, truth: str) -> Column:
        off = F.abs(F.col(estimate) - F.col(truth))
        return F.coalesce(F.when(small, off == 0).otherwise(off <= 4 * theta_error() * union + 1), F.lit(False))

    hll = F.abs(F.col("users_by_hll") - F.col("n_users")) <= 4 * hll_error() * F.col("n_users") + 1
    return both.select(
        F.col("_m").alias("merchant"),
        F.col("_w").alias("window_start"),
        F.col("n_users").alias("unique_users"),
        F.col("n_entered").alias("users_entered"),
        F.col("n_left").alias("users_left"),
        F.coalesce(hll, F.lit(False)).alias("hll_within_bound"),
        (within("users_by_theta", "n_users") & within("entered", "n_entered") & within("left", "n_left")).alias("theta_within_bound"),
    )


def _exact_user_changes(tx: DataFrame, w: int) -> DataFrame:
    """Exact users, entered and left per merchant window (what the sketches save).

    A row per merchant, user and pane is the only large table. A user counts in the windows of a pane that are not
    windows of the pane before, and is in a window and in the one right before it where the window starts after a pane
    and not after the user's next one, both within a window of it; both counts are combined before the shuffle."""
    slide = interval_seconds(MERCHANT_SLIDE)
    panes = tx.filter(F.col(TS).isNotNull()).select("merchant", "user_id", tumbling_start_sec(TS, slide).alias("pane")).distinct()
    pane, before = F.col("pane"), F.col("before")
    panes = panes.withColumn("before", F.lag("pane").over(Window.partitionBy("merchant", "user_id").orderBy("pane")))
    low, high = F.greatest(before + slide, pane - w + slide), F.least(pane, before + w)
    stay = F.when(before.isNotNull() & (low <= high), F.sequence(low, high, F.lit(slide).cast("long")))
    none = F.array().cast("array<bigint>")
    here = F.transform(F.coalesce(_starts_after(pane, before, w, slide), none), lambda ws: F.struct(ws.alias("ws"), F.lit(0).alias("kind")))
    both = F.transform(F.coalesce(stay, none), lambda ws: F.struct(ws.alias("ws"), F.lit(1).alias("kind")))
    rows = panes.select("merchant", F.col("user_id").isNotNull().alias("known"), F.explode(F.concat(here, both)).alias("m")).select("merchant", "known", "m.*")
    counts = rows.groupBy("merchant", "ws").agg(
        F.max(F.col("kind") == 0).alias("some"),
        F.count_if(F.col("known") & (F.col("kind") == 0)).alias("here"),
        F.count_if(F.col("known") & (F.col("kind") == 1)).alias("both"),
    )
    zero = F.lit(0).cast("bigint")
    now = counts.select("merchant", "ws", "some", "here", "both", zero.alias("earlier"))
    then = counts.select("merchant", (F.col("ws") + w).alias("ws"), F.lit(False).alias("some"), zero.alias("here"), zero.alias("both"), F.col("here").alias("earlier"))
    g = now.unionByName(then).groupBy("merchant", F.col("ws").alias("window_start")).agg(
        F.max("some").alias("some"),
        F.sum("here").alias("n_users"),
        (F.sum("here") - F.sum("both")).alias("n_entered"),
        (F.sum("earlier") - F.sum("both")).alias("n_left"),
    )
    return g.where("some").drop("some")


def _exact_view(totals: DataFrame, key: str) -> DataFrame:
    """Totals and means bit for bit, not rounded; NaN as -1 and infinity as -2, which no amount is."""
    x = F.when(F.isnan("total"), F.lit(-1.0)).when(F.col("total") == float("inf"), F.lit(-2.0)).otherwise(F.col("total"))
    mean = F.when(x < 0, x).otherwise(F.try_divide(x, F.col("n_values").cast("double")))
    return totals.select(key, "window_start", x.alias("total"), "n_values", mean.alias("mean"))


# ---- enrichment and rules ----------------------------------------------------

def q_enrich_user_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched_view(enrich_user_stats(transactions(spark, sf_dir)))


def q_enrich_user_stats_rangejoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched_view(enrich_user_stats_rangejoin(transactions(spark, sf_dir)))


def _rule_hits(spark: SparkSession, sf_dir: str, reason: str) -> DataFrame:
    r = with_reasons(enrich_user_stats(transactions(spark, sf_dir)))
    return r.filter(F.array_contains("anomaly_reasons", reason)).select(
        "transaction_id", "user_id", shown("amount"), "is_international", "transaction_count", shown("avg_transaction_amount")
    )


def q_anomaly_high_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rule_hits(spark, sf_dir, "HIGH_AMOUNT")


def q_anomaly_high_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rule_hits(spark, sf_dir, "HIGH_FREQUENCY")


def q_anomaly_high_international(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rule_hits(spark, sf_dir, "HIGH_INTERNATIONAL")


def q_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _anomaly_view(detect_anomalies(enrich_user_stats(transactions(spark, sf_dir))))


# ---- encoders (checked on the parsed-back fields) -----------------------------

def q_encode_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    agg = merchant_window_aggregates(transactions(spark, sf_dir))
    back = encode_aggregates(agg).select("key", F.from_json("value", agg.select(*MERCHANT_AGG_COLUMNS).schema).alias("v")).select("key", "v.*")
    return _merchant_view(back, "key")


def q_encode_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_anomalies(enrich_user_stats(transactions(spark, sf_dir)))
    back = encode_anomalies(found).select("key", F.from_json("value", found.select(*ANOMALY_COLUMNS).schema).alias("v")).select("key", "v.*")
    return back.select(
        "key",
        "transaction_id",
        "user_id",
        shown("amount"),
        "merchant",
        _sec().alias("event_sec"),
        "is_international",
        "transaction_count",
        shown("avg_transaction_amount"),
        F.array_join("anomaly_reasons", ",").alias("anomaly_reasons"),
        F.col("detected_at").isNotNull().alias("has_detected_at"),
    )


# ---- late rows, lost offsets, dead letters --------------------------------------

def late_arrivals(rows: DataFrame, id_col: str, ts: str, splits: int = LATE_SPLITS) -> DataFrame:
    """Rows with the micro-batch they arrive in: by event time, but some come batches late."""
    sec = F.unix_seconds(ts)
    start = FIXTURE_ORIGIN_MICROS // 1_000_000
    on_time = F.floor((sec - start) / LATE_SPLIT_SECONDS)
    behind = F.when(F.col(id_col) % 23 == 5, 3).when(F.col(id_col) % 29 == 7, 1).otherwise(0)
    batch = F.least(F.greatest(on_time + behind, F.lit(0)), F.lit(splits - 1)).cast("int")
    return rows.withColumn("batch", F.coalesce(batch, F.pmod(F.col(id_col), F.lit(splits)).cast("int")))


def _late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = prepare_transactions(fixtures.fixture_transactions(spark, sf_dir, keep_id=True))
    return with_lateness(late_arrivals(tx, "event_id", TS), "batch")


def q_late_rows_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_rows_by_batch(_late_rows(spark, sf_dir), "batch")


def q_lateness_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delays chosen by a quantile sketch, and whether their exact rank is within the sketch's bound."""
    rows = _late_rows(spark, sf_dir).where("lateness IS NOT NULL")
    delays = delay_for_share(rows, SHARES)
    each = rows.select("lateness", F.explode(F.array(*[F.lit(q) for q in SHARES])).alias("share"))
    ranks = each.join(F.broadcast(delays), "share").groupBy("share").agg(  # four rows
        F.count_if(F.col("lateness") <= F.col("delay_seconds")).alias("below"),
        F.count_if(F.col("lateness") < F.col("delay_seconds")).alias("under"),
        F.count(F.lit(1)).alias("rows"),
    )
    within = (F.col("below") >= (F.col("share") - KLL_ERROR) * F.col("rows")) & (F.col("under") <= (F.col("share") + KLL_ERROR) * F.col("rows"))
    return ranks.select("share", "rows", within.alias("within_bound"))


def _lossy_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with dense offsets per partition, of which some records and whole stretches are gone."""
    log = fixtures.fixture_envelope(spark, sf_dir)
    dense = log.withColumn("offset", F.expr(f"offset div {TOPIC_PARTITIONS}"))
    return dense.where(~F.expr(LOST))


def q_missing_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_offsets(_lossy_log(spark, sf_dir), block=64).select("partition", "first_missing", "last_missing", "n_missing")


def q_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rejected message of a log with more kinds of bad messages."""
    return dead_letters(broken_log(spark, sf_dir)).select("offset", "reason", F.array_join("wrong", ",").alias("wrong"))


def broken_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fixtures.fixture_envelope(spark, sf_dir)
    text = F.col("value").cast("string")
    k = F.col("offset") % 211
    value = (
        F.when(k == 20, "[1, 2]").when(k == 21, F.regexp_replace(text, '"amount":[^,}]*', '"amount":"12.5"'))
        .when(k == 22, F.substring(text, 1, 40)).when(k == 23, "").when(k == 24, F.lit(None))
        .when(k == 25, F.regexp_replace(text, '"is_international":[^,}]*', '"is_international":"yes"')).when(k == 26, "null")
        .otherwise(text)
    )
    return log.withColumn("value", value.cast("binary"))


# ---- load reports --------------------------------------------------------------

def _load_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the log with its partition (each is filled by one writer), append second and
    whether the processor accepts its message."""
    log = fixtures.fixture_envelope(spark, sf_dir)
    sent = log.select(F.col("partition").cast("bigint").alias("worker"), "value", "timestamp")
    parsed = sent.select("worker", "timestamp", F.from_json(F.col("value").cast("string"), TRANSACTION_SCHEMA).alias("m"))
    ok = F.coalesce(F.col("m.transaction_id").isNotNull() & (F.col("m.amount") > 0), F.lit(False))
    return parsed.select("worker", F.unix_seconds("timestamp").alias("sec"), ok.alias("ok"))


def q_throughput_by_worker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return throughput_by_worker(_load_view(spark, sf_dir), "worker", "sec", "ok")


def q_throughput_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return throughput_overall(_load_view(spark, sf_dir), "worker", "sec", "ok")


def q_record_size_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_size_profile(fields(spark, sf_dir), include_json=True)


def q_storage_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions written as a table, and per field its raw bytes, what the files' footers say of values and nulls,
    and whether its stored bytes were measured. (The bytes depend on the writer: ``storage_by_field`` has them.)"""
    path = scratch_path(spark, "stored")
    fields(spark, sf_dir).write.parquet(path)
    found = storage_by_field(spark, path)
    return found.select("field", "records", "raw_bytes", "n_values", "n_nulls", (F.col("measured_compression") > 0).alias("measured"))


def q_generate_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated transaction per event id; profile per merchant and currency."""
    events = fixtures.load_table(spark, sf_dir, "events")
    gen = prepare_transactions(generate_transactions(ids=events, id_col="event_id"))
    return gen.groupBy("merchant", "currency").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.count_distinct("user_id").alias("users"),
        F.min(_sec()).alias("first_sec"),
        F.max(_sec()).alias("last_sec"),
    )
