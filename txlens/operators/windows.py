"""Event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.schema import MERCHANT_SLIDE, MERCHANT_WINDOW


def sliding_window_expand(
    df: DataFrame,
    ts: str = "transaction_timestamp",
    window: str = MERCHANT_WINDOW,
    slide: str = MERCHANT_SLIDE,
    out: str = "window",
) -> DataFrame:
    """One row per (row, window containing it): windows ``[start, start+window)`` whose
    starts are multiples of ``slide`` since the epoch. A 5-minute window sliding by
    1 minute puts each row in 5 windows. Rows without event time have no window."""
    return df.withColumn(out, F.window(ts, window, slide))
