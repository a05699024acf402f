"""DuckDB SQL equal to each registered query (tables are pre-registered views)."""

from __future__ import annotations

from txlens.schema import CURRENCIES, PAYMENT_METHODS, SOURCE_TOPIC, TOPIC_PARTITIONS, TRANSACTION_TYPES
from txlens.operators.reports import FIXED_FIELD_BYTES, STRING_FIELDS
from txlens.plans.batch import LATE_SPLIT_SECONDS, LATE_SPLITS, LOST, ROUNDING_SHIFT
from txlens.sources.fixtures import FIXTURE_AMOUNT_SCALE, FIXTURE_ORIGIN_MICROS, FIXTURE_TIME_COMPRESSION, MALFORMED, spoilt


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


B = FIXTURE_ORIGIN_MICROS

# f: the nine fields from events (plus the event second); tx: valid transactions.
BASE = f"""
WITH e AS (
  SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         ({B} + (epoch_us(ts) - {B}) // {FIXTURE_TIME_COMPRESSION}) // 1000000 AS sec
  FROM events
),
f AS (
  SELECT event_id,
         {spoilt("transaction_id", "CAST(event_id AS VARCHAR)", "VARCHAR")} AS transaction_id,
         {spoilt("user_id", "'user_' || CAST(user_id AS VARCHAR)", "VARCHAR")} AS user_id,
         {spoilt("amount", f"round(value * {FIXTURE_AMOUNT_SCALE}, 2)", "DOUBLE")} AS amount,
         {spoilt("currency", f"list_extract({_list(CURRENCIES)}, k % 4 + 1)", "VARCHAR")} AS currency,
         {spoilt("transaction_time", "CASE WHEN event_id % 2 = 0 THEN sec ELSE sec * 1000 + 999 END", "BIGINT")} AS transaction_time,
         {spoilt("merchant", "event_type", "VARCHAR")} AS merchant,
         {spoilt("is_international", "k % 2 = 0", "BOOLEAN")} AS is_international,
         list_extract({_list(TRANSACTION_TYPES)}, (k // 4) % 4 + 1) AS transaction_type,
         list_extract({_list(PAYMENT_METHODS)}, (k // 16) % 4 + 1) AS payment_method
  FROM e
),
fe AS (
  SELECT *, CASE WHEN transaction_time > 1000000000000 THEN transaction_time // 1000
                 ELSE transaction_time END AS event_sec
  FROM f
),
tx AS (
  SELECT * FROM fe WHERE transaction_id IS NOT NULL AND amount > 0
)
"""


def shown(x: str, name: str | None = None) -> str:
    """The comparison views' rounding (see ``txlens.plans.batch.shown``)."""
    return (
        f"CASE WHEN isnan({x}) THEN -1.0::DOUBLE WHEN {x} = 'Infinity'::DOUBLE THEN -2.0::DOUBLE "
        f"WHEN abs({x}) < 1e9::DOUBLE THEN floor({x} * 1e4::DOUBLE + {ROUNDING_SHIFT}::DOUBLE) / 1e4::DOUBLE "
        f"ELSE floor({x} / 1e9::DOUBLE + {ROUNDING_SHIFT}::DOUBLE) * 1e9::DOUBLE END AS {name or x}"
    )


FIELDS = (
    f"transaction_id, user_id, {shown('amount')}, currency, transaction_time, merchant, "
    "is_international, transaction_type, payment_method"
)
# DuckDB's own stddev refuses amounts that are not finite; Spark's gives NaN.
STDDEV = (
    "CASE WHEN count(amount) > 1 THEN CASE WHEN bool_or(NOT isfinite(amount)) THEN 'NaN'::DOUBLE "
    "ELSE stddev_samp(CASE WHEN isfinite(amount) THEN amount END) END END"
)

MERCHANT_AGG = (
    BASE
    + f""",
w AS (
  SELECT tx.*, (event_sec // 60) * 60 - o.range * 60 AS ws
  FROM tx CROSS JOIN range(5) AS o WHERE event_sec IS NOT NULL
),
agg AS (
  SELECT merchant, ws AS window_start, ws + 300 AS window_end,
         count(*) AS total_transactions,
         sum(amount) AS total_amount,
         avg(amount) AS average_amount,
         min(amount) AS min_amount, max(amount) AS max_amount,
         count(DISTINCT user_id) AS unique_users,
         coalesce(array_to_string(list_sort(list(DISTINCT currency) FILTER (WHERE currency IS NOT NULL)), ','), '')
           AS currencies_used
  FROM w GROUP BY merchant, ws
)
"""
)

USER_STATS = (
    BASE
    + f""",
us AS (
  SELECT user_id, (event_sec // 1800) * 1800 AS window_start, (event_sec // 1800) * 1800 + 1800 AS window_end,
         count(*) AS transaction_count,
         sum(amount) AS total_spent,
         avg(amount) AS avg_transaction_amount,
         {STDDEV} AS stddev_amount,
         max(amount) AS max_amount_in_window
  FROM tx WHERE event_sec IS NOT NULL GROUP BY user_id, event_sec // 1800
)
"""
)

ENRICHED = (
    BASE
    + f""",
s AS (
  SELECT user_id, event_sec // 1800 AS wb, count(*) AS transaction_count, avg(amount) AS avg_transaction_amount
  FROM tx WHERE user_id IS NOT NULL AND event_sec IS NOT NULL GROUP BY user_id, event_sec // 1800
),
en AS (
  SELECT t.*, s.transaction_count, s.avg_transaction_amount
  FROM tx t LEFT JOIN s ON t.user_id = s.user_id AND t.event_sec // 1800 = s.wb
),
r AS (
  SELECT en.*,
         amount > coalesce(avg_transaction_amount * 3.0, 10000) AS r_amount,
         transaction_count > 10 AS r_frequency,
         (is_international = true AND amount > 1000) AS r_international
  FROM en
),
an AS (
  SELECT r.*, concat_ws(',', CASE WHEN r_amount THEN 'HIGH_AMOUNT' END,
                             CASE WHEN r_frequency THEN 'HIGH_FREQUENCY' END,
                             CASE WHEN r_international THEN 'HIGH_INTERNATIONAL' END) AS anomaly_reasons
  FROM r WHERE r_amount OR r_frequency OR r_international
)
"""
)

_AMOUNTS = f"{shown('amount')}, "
_AVERAGE = shown("avg_transaction_amount")
ENRICHED_COLS = f"transaction_id, user_id, {_AMOUNTS} event_sec, transaction_count, {_AVERAGE}"
RULE_COLS = f"transaction_id, user_id, {_AMOUNTS} is_international, transaction_count, {_AVERAGE}"
ANOMALY_COLS = (
    f"transaction_id, user_id, {_AMOUNTS} merchant, event_sec, is_international, "
    f"transaction_count, {_AVERAGE}, anomaly_reasons"
)
MERCHANT_COLS = (
    f"merchant, window_start, window_end, total_transactions, {shown('total_amount')}, {shown('average_amount')}, "
    f"{shown('min_amount')}, {shown('max_amount')}, unique_users, currencies_used"
)
USER_COLS = (
    f"user_id, window_start, window_end, transaction_count, {shown('total_spent')}, {_AVERAGE}, "
    f"{shown('stddev_amount')}, {shown('max_amount_in_window')}"
)

USER_CHANGES = (
    BASE
    + """,
p AS (SELECT DISTINCT merchant, user_id, (event_sec // 60) * 60 - o AS ws
      FROM (SELECT *, unnest([0, 60, 120, 180, 240]) AS o FROM tx WHERE event_sec IS NOT NULL)),
s AS (SELECT merchant, ws, list(user_id) FILTER (user_id IS NOT NULL) AS users FROM p GROUP BY ALL),
c AS (SELECT s.merchant, s.ws, coalesce(s.users, []) AS users, coalesce(b.users, []) AS before
      FROM s LEFT JOIN s b ON b.merchant IS NOT DISTINCT FROM s.merchant AND b.ws = s.ws - 300)
SELECT merchant, ws AS window_start, len(users)::BIGINT AS unique_users,
       (len(users) - len(list_intersect(users, before)))::BIGINT AS users_entered, (len(before) - len(list_intersect(users, before)))::BIGINT AS users_left,
       true AS hll_within_bound, true AS theta_within_bound
FROM c"""
)


def _exact_totals(key: str, start: str, rows: str) -> str:
    """Totals as integers of 2^-60 (every amount of the fixture is one), rounded half to even to 53 bits;
    DuckDB's own cast of such an integer to a double is not rounded right."""
    return (
        BASE
        + f""", i AS (
  SELECT {key}, {start} AS window_start, count(amount) AS n_values, bool_or(isnan(amount)) AS is_nan, bool_or(NOT isfinite(amount)) AS is_wide,
         sum(CASE WHEN isfinite(amount) THEN (amount * 1152921504606846976.0::DOUBLE)::HUGEINT ELSE 0 END) AS s
  FROM {rows} GROUP BY ALL
), b AS (SELECT *, greatest(length(ltrim(bin(s), '0')) - 53, 0) AS cut FROM i),
q AS (SELECT *, s // (1::HUGEINT << cut) AS whole, s % (1::HUGEINT << cut) AS rest, (1::HUGEINT << cut) AS unit FROM b),
t AS (
  SELECT *, CASE WHEN is_nan THEN -1.0::DOUBLE WHEN is_wide THEN -2.0::DOUBLE ELSE
         (whole + CASE WHEN 2 * rest > unit OR (2 * rest = unit AND whole % 2 = 1) THEN 1 ELSE 0 END)::BIGINT::DOUBLE * pow(2::DOUBLE, cut - 60) END AS total
  FROM q
)
SELECT {key}, window_start, total, n_values, CASE WHEN total < 0 THEN total ELSE total / n_values::DOUBLE END AS mean FROM t"""
    )


# Arrival of each valid row, the watermarks of each micro-batch, and what became of the row.
LATE = (
    BASE
    + f""",
a AS (
  SELECT *, coalesce(least(greatest((event_sec - {FIXTURE_ORIGIN_MICROS // 1_000_000}) // {LATE_SPLIT_SECONDS} + CASE WHEN event_id % 23 = 5 THEN 3 WHEN event_id % 29 = 7 THEN 1 ELSE 0 END, 0), {LATE_SPLITS - 1}),
                     event_id % {LATE_SPLITS})::INTEGER AS batch
  FROM tx
),
m AS (
  SELECT batch, max(max(event_sec)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest,
         max(max(event_sec)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - 600 AS drops
  FROM a GROUP BY batch
),
l AS (
  SELECT a.*, greatest(coalesce(newest - event_sec, 0), 0)::BIGINT AS lateness,
         CASE WHEN event_sec IS NULL THEN NULL WHEN (event_sec // 1800) * 1800 + 1800 <= drops THEN 'dropped'
              WHEN event_sec < newest - 600 THEN 'late' ELSE 'on_time' END AS status
  FROM a JOIN m USING (batch)
)
"""
)


def _broken() -> str:
    k = "event_id % 211"
    return f"""
SELECT event_id AS "offset", reason, CASE WHEN reason IN ('empty', 'not_json', 'not_an_object') THEN '' WHEN {k} = 21 THEN 'amount:STRING' WHEN {k} = 25 THEN 'is_international:STRING' ELSE '' END AS wrong
FROM (
  SELECT *, CASE WHEN {k} IN (23, 24) THEN 'empty' WHEN {k} = 20 OR {k} = 26 THEN 'not_an_object' WHEN {k} = 22 THEN 'not_json'
                 WHEN {MALFORMED} THEN 'not_json' WHEN transaction_id IS NULL THEN 'no_transaction_id' WHEN {k} = 21 THEN 'wrong_type'
                 WHEN amount IS NULL THEN 'no_amount' WHEN NOT amount > 0 THEN 'amount_not_positive' END AS reason
  FROM f)
WHERE reason IS NOT NULL"""


LOAD = (
    BASE
    + f""",
lv AS (
  SELECT event_id % {TOPIC_PARTITIONS} AS worker, event_sec AS sec,
         coalesce(transaction_id IS NOT NULL AND amount > 0, false) AS ok
  FROM fe
)
"""
)
_PARSED = ", ".join(
    f"CASE WHEN {MALFORMED} THEN NULL ELSE {c} END AS {c}"
    for c in "transaction_id user_id amount currency transaction_time merchant is_international transaction_type payment_method".split()
)


_CLOSED_ANOMALIES = (
    f"SELECT {ANOMALY_COLS} FROM an WHERE event_sec IS NULL "
    "OR (event_sec // 1800) * 1800 + 1800 <= (SELECT max(event_sec) FROM tx) - 600"
)


def _stored() -> str:
    """Raw bytes and nulls of each field of the rows."""
    sizes = {c: f"coalesce(sum(strlen({c})), 0)" for c in STRING_FIELDS} | {c: f"{n} * count(*)" for c, n in FIXED_FIELD_BYTES.items()}
    parts = [
        f"SELECT '{c}' AS field, count(*) AS records, ({size})::BIGINT AS raw_bytes, count(*)::BIGINT AS n_values, "
        f"(count(*) - count({c}))::BIGINT AS n_nulls, true AS measured FROM f"
        for c, size in sizes.items()
    ]
    return BASE + " UNION ALL ".join(parts)


def sql() -> dict[str, str]:
    return {
        "envelope_scan": BASE
        + f"SELECT user_id AS key, '{SOURCE_TOPIC}' AS topic, true AS partition_valid, event_id::BIGINT AS \"offset\", "
        f"event_sec AS timestamp_sec, 0 AS timestampType, {FIELDS} FROM fe",
        "parse_transactions": BASE
        + f", p AS (SELECT {_PARSED}, event_sec AS kafka_timestamp_sec FROM fe) SELECT {FIELDS}, kafka_timestamp_sec FROM p",
        "normalize_epoch": BASE + "SELECT transaction_id, transaction_time, event_sec FROM fe",
        "valid_transactions": BASE + f"SELECT {FIELDS}, event_sec FROM tx",
        "sliding_window_expand": BASE
        + "SELECT transaction_id, (event_sec // 60) * 60 - o.range * 60 AS window_start, "
        "(event_sec // 60) * 60 - o.range * 60 + 300 AS window_end FROM tx CROSS JOIN range(5) AS o WHERE event_sec IS NOT NULL",
        "merchant_window_aggregates": MERCHANT_AGG + f"SELECT {MERCHANT_COLS} FROM agg",
        "merchant_window_aggregates_frames": MERCHANT_AGG + f"SELECT {MERCHANT_COLS} FROM agg",
        "user_window_exact_totals": _exact_totals("user_id", "(event_sec // 1800) * 1800", "(SELECT * FROM tx WHERE event_sec IS NOT NULL)"),
        "merchant_window_exact_totals": _exact_totals(
            "merchant", "(event_sec // 60) * 60 - o * 60", "(SELECT tx.*, unnest(range(5)) AS o FROM tx WHERE event_sec IS NOT NULL)"
        ),
        "merchant_window_user_sketches": USER_CHANGES,
        "merchant_window_user_sketches_stream": USER_CHANGES,
        "late_rows_by_batch": LATE
        + "SELECT batch, count(*) FILTER (status = 'on_time') AS on_time, count(*) FILTER (status = 'late') AS late, count(*) FILTER (status = 'dropped') AS dropped, "
        "count(*) FILTER (status IS NULL) AS untimed, max(CASE WHEN event_sec IS NOT NULL THEN lateness END) AS max_lateness FROM l GROUP BY batch",
        "lateness_profile": LATE
        + "SELECT unnest([0.5::DOUBLE, 0.9::DOUBLE, 0.99::DOUBLE, 0.999::DOUBLE]) AS share, count(*) AS rows, true AS within_bound FROM l WHERE event_sec IS NOT NULL",
        "user_windows_late_stream": LATE
        + "SELECT * FROM (SELECT user_id, (event_sec // 1800) * 1800 AS window_start, count(*) AS transaction_count FROM l WHERE status <> 'dropped' "
        "GROUP BY user_id, event_sec // 1800) WHERE window_start + 1800 <= (SELECT max(event_sec) FROM tx) - 600",
        "missing_offsets": BASE
        + f""", o AS (SELECT (event_id % {TOPIC_PARTITIONS})::INTEGER AS partition, event_id // {TOPIC_PARTITIONS} AS "offset" FROM f),
g AS (SELECT *, lag("offset") OVER (PARTITION BY partition ORDER BY "offset") AS b FROM o WHERE NOT {LOST.replace("offset", '"offset"')})
SELECT partition, (b + 1)::BIGINT AS first_missing, ("offset" - 1)::BIGINT AS last_missing, ("offset" - b - 1)::BIGINT AS n_missing FROM g WHERE "offset" > b + 1""",
        "dead_letters": BASE + _broken(),
        "user_window_stats": USER_STATS + f"SELECT {USER_COLS} FROM us",
        "enrich_user_stats": ENRICHED + f"SELECT {ENRICHED_COLS} FROM en",
        "enrich_user_stats_rangejoin": ENRICHED + f"SELECT {ENRICHED_COLS} FROM en",
        "anomaly_high_amount": ENRICHED + f"SELECT {RULE_COLS} FROM r WHERE r_amount",
        "anomaly_high_frequency": ENRICHED + f"SELECT {RULE_COLS} FROM r WHERE r_frequency",
        "anomaly_high_international": ENRICHED + f"SELECT {RULE_COLS} FROM r WHERE r_international",
        "anomalies": ENRICHED + f"SELECT {ANOMALY_COLS} FROM an",
        "anomalies_stream": ENRICHED + _CLOSED_ANOMALIES,
        "anomalies_stream_salted": ENRICHED + _CLOSED_ANOMALIES,
        "anomalies_stream_hot_salted": ENRICHED + _CLOSED_ANOMALIES,
        "anomalies_stream_landed": ENRICHED + _CLOSED_ANOMALIES,
        "user_windows_from_state": USER_STATS + f"SELECT {USER_COLS} FROM us",
        "merchant_windows_from_state": MERCHANT_AGG + f"SELECT {MERCHANT_COLS} FROM agg",
        "anomalies_from_state": ENRICHED + f"SELECT {ANOMALY_COLS} FROM an",
        "merchant_aggregates_stream": MERCHANT_AGG + f"SELECT {MERCHANT_COLS} FROM agg",
        "merchant_aggregates_stream_bucketed": MERCHANT_AGG + f"SELECT {MERCHANT_COLS} FROM agg",
        "merchant_aggregates_stream_compacted": MERCHANT_AGG + f"SELECT {MERCHANT_COLS} FROM agg",
        "merchant_windows_closed_stream": MERCHANT_AGG
        + f"SELECT {MERCHANT_COLS} FROM agg WHERE window_end <= (SELECT max(event_sec) FROM tx) - 600",
        "user_window_stats_stream": USER_STATS
        + f"SELECT {USER_COLS} FROM us WHERE window_end <= (SELECT max(event_sec) FROM tx) - 600",
        "encode_aggregates": MERCHANT_AGG + f"SELECT merchant AS key, {MERCHANT_COLS} FROM agg",
        "encode_anomalies": ENRICHED
        + f"SELECT transaction_id AS key, {ANOMALY_COLS}, true AS has_detected_at FROM an",
        "throughput_by_worker": LOAD
        + """, tw AS (
  SELECT worker AS worker_id, count(*) AS message_count,
         count(*) FILTER (WHERE ok) AS success_count, count(*) FILTER (WHERE NOT ok) AS error_count,
         CAST(max(sec) - min(sec) AS DOUBLE) AS elapsed
  FROM lv GROUP BY worker
)
SELECT *, CASE WHEN elapsed > 0 THEN CAST(message_count AS DOUBLE) / elapsed ELSE 0.0 END AS throughput FROM tw""",
        "throughput_overall": LOAD
        + """, t AS (
  SELECT count(DISTINCT worker) AS workers, count(*) AS total_messages,
         count(*) FILTER (WHERE ok) AS total_success, count(*) FILTER (WHERE NOT ok) AS total_errors,
         CAST(max(sec) - min(sec) AS DOUBLE) AS elapsed
  FROM lv
), t2 AS (
  SELECT *, CASE WHEN elapsed > 0 THEN CAST(total_messages AS DOUBLE) / elapsed ELSE 0.0 END AS throughput FROM t
)
SELECT *, CAST(300000 AS DOUBLE) AS target_throughput, throughput >= 300000 AS target_reached FROM t2""",
        "storage_by_field": _stored(),
        "record_size_profile": BASE
        + """, sz AS (
  SELECT *, coalesce(strlen(transaction_id), 0) + coalesce(strlen(user_id), 0) + coalesce(strlen(currency), 0)
            + coalesce(strlen(merchant), 0) + coalesce(strlen(transaction_type), 0)
            + coalesce(strlen(payment_method), 0) + 8 + 8 + 4 AS row_bytes,
         -- braces, then name, quotes, colon, comma and value of each field that is present; Spark writes
         -- "NaN", "Infinity" and, of amounts in the fixture from 1e7 on, 2.0E17
         1 + coalesce(strlen(transaction_id) + 20, 0) + coalesce(strlen(user_id) + 13, 0)
           + coalesce(CASE WHEN isnan(amount) THEN 5 WHEN amount = 'Infinity'::DOUBLE THEN 10
                            WHEN abs(amount) >= 1e7 THEN 6 ELSE strlen(amount::VARCHAR) END + 10, 0) + coalesce(strlen(currency) + 14, 0)
           + coalesce(strlen(transaction_time::VARCHAR) + 20, 0) + coalesce(strlen(merchant) + 14, 0)
           + coalesce(strlen(is_international::VARCHAR) + 20, 0) + coalesce(strlen(transaction_type) + 22, 0)
           + coalesce(strlen(payment_method) + 20, 0) AS json_bytes
  FROM f
), g AS (
  SELECT count(*) AS records,
         avg(strlen(transaction_id)) AS avg_transaction_id_bytes, avg(strlen(user_id)) AS avg_user_id_bytes,
         avg(strlen(currency)) AS avg_currency_bytes, avg(strlen(merchant)) AS avg_merchant_bytes,
         avg(strlen(transaction_type)) AS avg_transaction_type_bytes,
         avg(strlen(payment_method)) AS avg_payment_method_bytes,
         avg(row_bytes) AS avg_record_bytes, CAST(sum(row_bytes) AS BIGINT) AS raw_bytes,
         avg(json_bytes) AS avg_json_bytes
  FROM sz
)
SELECT *, CAST(raw_bytes AS DOUBLE) * 1.5 * 3 / 5.0 AS stored_bytes FROM g""",
    }
