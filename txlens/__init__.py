"""txlens: transaction stream analytics written as Spark DataFrame transformations.

Every operator is a ``DataFrame -> DataFrame`` function that serves batch tables and
Structured Streaming alike; where Spark's streaming engine forbids the batch plan the
function switches on ``df.isStreaming``.

Main entry points::

    from txlens.session import build_session, cluster_conf
    from txlens.sources import read_envelope, kafka_source_options, publish_transactions
    from txlens.sources import generate_transactions
    from txlens.operators.clean import clean_transactions, land_transactions
    from txlens.operators import (
        merchant_window_aggregates, user_window_stats,
        enrich_user_stats, enrich_user_stats_rangejoin, detect_anomalies,
        encode_aggregates, encode_anomalies,
        throughput_by_worker, throughput_overall, record_size_profile,
    )
    from txlens.streaming.app import start_processor   # both continuous queries
    from txlens.streaming import progress_summary

A batch run: ``tx = clean_transactions(read_envelope(spark, path))`` then
``merchant_window_aggregates(tx)`` and ``detect_anomalies(enrich_user_stats(tx))``.
The same calls on ``read_envelope(spark, path, streaming=True)`` give the streams.
"""

__version__ = "0.1.0"
