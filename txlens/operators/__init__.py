"""DataFrame -> DataFrame operators of the transaction processor."""

from txlens.operators.aggregates import merchant_window_aggregates, user_window_stats  # noqa: F401
from txlens.operators.anomalies import (  # noqa: F401
    detect_anomalies,
    enrich_user_stats,
    enrich_user_stats_rangejoin,
)
from txlens.operators.clean import (  # noqa: F401
    parse_transactions,
    valid_transactions,
    with_event_time,
    with_watermark,
)
from txlens.operators.encode import encode_aggregates, encode_anomalies  # noqa: F401
from txlens.operators.reports import (  # noqa: F401
    record_size_profile,
    throughput_by_worker,
    throughput_overall,
)
from txlens.operators.windows import sliding_window_expand  # noqa: F401
