"""Sources: message-log envelopes (Kafka or files), fixture views, the generator."""

from txlens.sources.envelope import (  # noqa: F401
    kafka_source_options,
    publish_transactions,
    read_envelope,
    to_envelope,
    write_envelope_splits,
)
from txlens.sources.fixtures import load_table, transactions_from_events  # noqa: F401
from txlens.sources.generate import generate_transactions  # noqa: F401
