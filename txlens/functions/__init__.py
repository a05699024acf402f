"""Column expressions (all built-in Spark functions; no Python UDFs)."""

from txlens.functions.columns import (  # noqa: F401
    tumbling_start_sec,
    window_starts_for_pane,
    epoch_seconds,
    interval_seconds,
    ms_or_seconds_to_timestamp,
    ntz_epoch_micros,
    pane_start,
)
from txlens.functions.json import encode_json, parse_json  # noqa: F401
from txlens.functions.rules import (  # noqa: F401
    any_rule,
    high_amount,
    high_frequency,
    high_international,
    reasons_array,
)
