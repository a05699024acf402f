"""Scalar column helpers: epoch handling, window arithmetic."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlens.schema import MILLIS_THRESHOLD

# Largest |seconds| accepted as event time; beyond it the time is null. It is the bound
# of the timestamp type (microseconds in a bigint) less one week, the longest window
# in use and the watermark, so that window ends (start + window) never overflow.
MAX_EPOCH_SECONDS = (2**63 - 1) // 1_000_000 - 7 * 86_400
_MAX_EPOCH_SECONDS = MAX_EPOCH_SECONDS

_UNITS = {
    "second": 1, "seconds": 1, "sec": 1, "secs": 1, "s": 1,
    "minute": 60, "minutes": 60, "min": 60, "mins": 60, "m": 60,
    "hour": 3600, "hours": 3600, "h": 3600,
    "day": 86400, "days": 86400, "d": 86400,
    "week": 604800, "weeks": 604800,
}


def interval_seconds(text: str) -> int:
    """'5 minutes' -> 300. Accepts the duration strings used for windows and watermarks."""
    total = 0
    parts = re.findall(r"(\d+)\s*([a-zA-Z]+)", text.strip())
    if not parts:
        raise ValueError(f"not a duration: {text!r}")
    for num, unit in parts:
        u = unit.lower()
        if u not in _UNITS:
            raise ValueError(f"unknown unit {unit!r} in {text!r}")
        total += int(num) * _UNITS[u]
    return total


def ms_or_seconds_to_timestamp(col: Column | str, threshold: int = MILLIS_THRESHOLD) -> Column:
    """Epoch number to timestamp: above ``threshold`` it is milliseconds, else seconds.

    The fraction of a second is cut toward zero (whole seconds), as a seconds
    formatter would. Values whose microseconds overflow a bigint give null
    instead of failing the query under ANSI mode.
    """
    c = (F.col(col) if isinstance(col, str) else col).cast("long")
    # Integer division toward zero: subtract the remainder, then divide exactly.
    secs = F.when(c > F.lit(threshold), ((c - c % F.lit(1000)) / F.lit(1000)).cast("long")).otherwise(c)
    # a two-sided range, not abs(): abs of the smallest bigint overflows under ANSI mode
    in_range = (secs >= F.lit(-_MAX_EPOCH_SECONDS)) & (secs <= F.lit(_MAX_EPOCH_SECONDS))
    return F.when(in_range, F.timestamp_seconds(secs))


def epoch_seconds(col: Column | str) -> Column:
    """Timestamp to whole epoch seconds (bigint), floor for pre-1970 times."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_seconds(c)


def ntz_epoch_micros(col: Column | str) -> Column:
    """TIMESTAMP_NTZ wall clock read as UTC, to epoch microseconds, independent of the session zone."""
    c = F.col(col) if isinstance(col, str) else col
    # NTZ - NTZ is a zone-free day-time interval; as whole seconds with a 6-digit
    # fraction it converts to microseconds without consulting any time zone.
    since_epoch = (c - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second")
    return (since_epoch.cast("decimal(24,6)") * F.lit(1000000)).cast("long")


def pane_start(sec: Column, width: int, offset: int = 0) -> Column:
    """Start second of the ``width``-second pane holding ``sec`` (aligned to epoch + offset)."""
    return sec - F.pmod(sec - F.lit(offset), F.lit(width))


def tumbling_start_sec(ts: Column | str, width: int, offset: int = 0) -> Column:
    """Start (epoch seconds) of the ``width``-second tumbling window holding ``ts``; null stays null."""
    sec = epoch_seconds(ts)
    return pane_start(sec, width, offset)


def window_starts_for_pane(pane: Column, window: int, slide: int, offset: int = 0) -> Column:
    """array<bigint> of the sliding-window starts ([start, start+window), start = offset mod
    slide) that contain the whole pane beginning at ``pane`` (pane width divides both).

    Closed form, no lambda (higher-order functions run outside whole-stage codegen):
    the starts are base - j*slide for j >= 0 with base - j*slide + window > pane, i.e.
    j*slide < d = base - pane + window, so they run from base - (ceil(d/slide)-1)*slide
    up to base. No window contains the pane when d <= 0 (windows shorter than slide).
    """
    base = pane - F.pmod(pane - F.lit(offset), F.lit(slide))
    d = base - pane + F.lit(window)
    lo = base - (F.ceil(d / F.lit(slide)).cast("long") - 1) * F.lit(slide)
    return F.when(d > 0, F.sequence(lo, base, F.lit(slide).cast("long")))
