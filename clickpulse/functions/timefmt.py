"""Epoch-millisecond helpers (C4, C5). Text forms follow the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_HOUR = 3_600_000
MS_PER_MINUTE = 60_000


def ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def day_string(ms: Column) -> Column:
    """C4: epoch ms -> ``yyyy-MM-dd``."""
    return F.date_format(ms_to_ts(ms), "yyyy-MM-dd")


def hour_minute(ms: Column) -> Column:
    """Epoch ms -> ``HH:mm``."""
    return F.date_format(ms_to_ts(ms), "HH:mm")


def slot(ms: Column, width_ms: int) -> Column:
    """Index of the ``width_ms`` slice holding ``ms`` (a micro-batch stand-in)."""
    return F.floor(ms / F.lit(width_ms)).cast("long")
