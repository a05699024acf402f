"""The processor: one parsed transaction stream feeding the two continuous queries.

``python -m txlens.streaming.app --source-format kafka --bootstrap-servers HOST:PORT``
runs like the original job (earliest offsets, keyed JSON to the two output topics, one
checkpoint folder per query); ``--max-offsets-per-trigger 10000`` adds its cap on a micro-batch. ``--source-format
parquet --source-path DIR --sink-format parquet --sink-root DIR`` runs the same
queries over a file log.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from txlens.operators.clean import clean_transactions
from txlens.schema import AGGREGATES_TOPIC, ANOMALIES_TOPIC, SOURCE_TOPIC, STATE_SHUFFLE_PARTITIONS
from txlens.session import build_session, size_session
from txlens.sources.envelope import file_source_options, kafka_source_options, read_envelope
from txlens.streaming.hot import HOT_SHARE, HotUsers, start_hot_users
from txlens.streaming.queries import (
    await_any_then_stop,
    read_landed,
    start_anomaly_detection,
    start_closed_merchant_windows,
    start_landing,
    start_merchant_aggregates,
    start_merchant_aggregates_bucketed,
)

#: Buckets that hot users and merchants are spread over by default.
DEFAULT_BUCKETS = 8


def start_processor(
    spark: SparkSession,
    source_format: str = "kafka",
    source_path: str | None = None,
    source_options: dict[str, str] | None = None,
    sink_format: str = "kafka",
    sink_root: str | None = None,
    sink_options: dict[str, str] | None = None,
    checkpoint_root: str | None = None,
    trigger: dict | None = None,
    state_partitions: int | None = STATE_SHUFFLE_PARTITIONS,
    exact_distinct: bool = True,
    landing: bool = True,
    landing_path: str | None = None,
    salt_buckets: int = DEFAULT_BUCKETS,
    user_buckets: int = DEFAULT_BUCKETS,
    closed_windows: bool = False,
    hot_share: float | None = HOT_SHARE,
    track_hot_users: bool = False,
) -> list[StreamingQuery]:
    """Start MerchantAggregates (update) and AnomalyDetection (append) on one source.

    ``checkpoint_root`` is required: it belongs to this source and these sinks, and a
    restart goes on from it. By default a third query, LandTransactions, parses each
    message once into a columnar table (``landing_path``, or a folder of the checkpoint
    root) that the two queries read; with ``landing=False`` each parses the log itself, the
    anomaly query once per plan branch. With an ``availableNow`` trigger the landing
    finishes before the two queries start.

    ``salt_buckets`` spreads a user's buffered transactions, ``user_buckets`` a merchant's
    users over so many state rows, so that a hot key does not sit in one partition (1: no
    spreading). Only users with a ``hot_share`` of the rows are spread (None: all), as the summary of
    earlier runs names them; ``track_hot_users`` adds the query that keeps this summary (in the
    checkpoint root) for the next start. ``closed_windows`` adds the query that emits each merchant window once.
    """
    if not checkpoint_root:
        raise ValueError("the processor needs a checkpoint_root of its own, shared by all machines")
    root = checkpoint_root.rstrip("/")
    if landing and not landing_path:
        landing_path = f"{root}/landed"
    env = read_envelope(spark, source_path, source_format, streaming=True, options=source_options)
    started: list[StreamingQuery] = []
    if landing:
        q0 = start_landing(env, landing_path, f"{root}/landing", trigger=trigger)
        started.append(q0)
        if trigger and trigger.get("availableNow"):
            q0.awaitTermination()
        # same admission cap downstream: the landing writes about one file per task
        caps = source_options or {}
        files, nbytes = caps.get("maxFilesPerTrigger"), caps.get("maxBytesPerTrigger")
        tx = read_landed(
            spark, landing_path,
            max_files_per_trigger=int(files) if files else None,
            max_bytes_per_trigger=int(nbytes) if nbytes else None,
        )
    else:
        tx = clean_transactions(env)
    agg_path = f"{sink_root.rstrip('/')}/aggregates" if sink_root else None
    anom_path = f"{sink_root.rstrip('/')}/anomalies" if sink_root else None
    if user_buckets > 1 and exact_distinct:
        q1 = start_merchant_aggregates_bucketed(
            tx, f"{root}/aggregates", f"{root}/aggregate-parts", user_buckets, sink_format, agg_path, sink_options,
            trigger=trigger, state_partitions=state_partitions,
        )
    else:
        q1 = start_merchant_aggregates(
            tx, f"{root}/aggregates", sink_format, agg_path, sink_options, trigger=trigger,
            state_partitions=state_partitions, exact_distinct=exact_distinct,
        )
    started.append(q1)
    if closed_windows:
        closed_path = f"{sink_root.rstrip('/')}/closed" if sink_root else None
        started.append(
            start_closed_merchant_windows(
                tx, f"{root}/closed", sink_format, closed_path, sink_options, trigger=trigger, state_partitions=state_partitions
            )
        )
    hot = None if hot_share is None else HotUsers(spark, f"{root}/hot-users").grown(hot_share)
    if track_hot_users:
        started.append(start_hot_users(tx, f"{root}/hot-users-checkpoint", f"{root}/hot-users", trigger=trigger))
    q2 = start_anomaly_detection(
        tx, f"{root}/anomalies", sink_format, anom_path, sink_options, trigger=trigger,
        state_partitions=state_partitions, salt_buckets=salt_buckets, hot_users=hot,
    )
    return started + [q2]


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="transaction stream processor")
    p.add_argument("--source-format", default="kafka")
    p.add_argument("--source-path")
    p.add_argument("--bootstrap-servers")
    p.add_argument("--source-topic", default=SOURCE_TOPIC)
    p.add_argument("--max-files-per-trigger", type=int)
    p.add_argument("--max-bytes-per-trigger", type=int)
    p.add_argument("--min-partitions", type=int, help="split large topic partitions over at least this many tasks")
    p.add_argument("--sink-format", default="kafka")
    p.add_argument("--sink-root")
    p.add_argument("--checkpoint-root", required=True, help="folder shared by all machines; a restart goes on from it")
    p.add_argument("--starting-offsets", default="earliest")
    p.add_argument("--max-offsets-per-trigger", type=int, help="cap on the records of a micro-batch (unset: none)")
    p.add_argument("--landing-path", help="columnar table that messages are parsed into once (default: in the checkpoint root)")
    p.add_argument("--no-landing", action="store_true", help="both queries parse the log themselves")
    p.add_argument("--salt-buckets", type=int, default=DEFAULT_BUCKETS,
                   help="spread each (user, window) of the anomaly join state over this many partitions")
    p.add_argument("--hot-share", type=float, default=HOT_SHARE, help="share of all rows from which a user is spread; 0: all users")
    p.add_argument("--track-hot-users", action="store_true", help="keep the summary of frequent users for the next start")
    p.add_argument("--user-buckets", type=int, default=DEFAULT_BUCKETS,
                   help="spread the users of each merchant window over this many state rows")
    p.add_argument("--state-partitions", type=int, default=STATE_SHUFFLE_PARTITIONS)
    p.add_argument("--approx-distinct", action="store_true")
    p.add_argument("--closed-windows", action="store_true",
                   help="also emit each merchant window once, when it is closed")
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--timeout", type=float)
    a = p.parse_args(argv)

    spark = build_session(master=None, app_name="txlens-processor")
    size_session(spark)
    if a.source_format == "kafka":
        src_opts = kafka_source_options(
            a.bootstrap_servers, a.source_topic, a.starting_offsets,
            max_offsets_per_trigger=a.max_offsets_per_trigger, min_partitions=a.min_partitions,
        )
        sink_opts = {"kafka.bootstrap.servers": a.bootstrap_servers}
    else:
        src_opts = file_source_options(a.max_files_per_trigger, max_bytes_per_trigger=a.max_bytes_per_trigger)
        sink_opts = None
    queries = start_processor(
        spark, a.source_format, a.source_path, src_opts, a.sink_format, a.sink_root, sink_opts,
        a.checkpoint_root, {"availableNow": True} if a.available_now else None, a.state_partitions,
        not a.approx_distinct, not a.no_landing, a.landing_path, a.salt_buckets, a.user_buckets, a.closed_windows,
        a.hot_share or None, a.track_hot_users,
    )
    for q in queries:
        print(f"started {q.name} id={q.id}")
    print(f"topics: {AGGREGATES_TOPIC}, {ANOMALIES_TOPIC}" if a.sink_format == "kafka" else f"output: {a.sink_root}")
    if a.available_now:
        for q in queries:
            q.awaitTermination()
    else:
        await_any_then_stop(spark, queries, a.timeout)
    spark.stop()


if __name__ == "__main__":
    main()
