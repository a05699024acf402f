"""Structured Streaming: the two continuous queries, their sinks and run control."""

from txlens.streaming.queries import (  # noqa: F401
    anomalies_output,
    await_any_then_stop,
    merchant_aggregates_output,
    start_anomaly_detection,
    start_merchant_aggregates,
)
from txlens.streaming.monitor import ProgressTotals  # noqa: F401
from txlens.streaming.sinks import (  # noqa: F401
    kafka_sink_options,
    latest_per_key,
    start_stream,
)
