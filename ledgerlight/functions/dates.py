"""Date and time column helpers (JVM-side expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def add_days(ts: Column | str, days: int) -> Column:
    """Shift a timestamp by whole days keeping the time of day.

    ``date_add`` on a timestamp drops the time, which would move a lookback
    window's edge to midnight.
    """
    col = F.col(ts) if isinstance(ts, str) else ts
    return col + F.expr(f"INTERVAL '{int(days)}' DAY")


def epoch_seconds(c: Column | str, dtype=None) -> Column:
    """Whole seconds since the epoch, floored, independent of the session zone.

    For TIMESTAMP_NTZ the wall clock is read as UTC; for TIMESTAMP the instant
    is used.
    """
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, TimestampNTZType):
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col)
    else:
        micros = F.unix_micros(col)
    # Integer floor division (pmod keeps it right before 1970).
    return ((micros - F.pmod(micros, F.lit(1_000_000))) / F.lit(1_000_000)).cast("long")


def seconds_between(start: Column | str, end: Column | str, dtype=None) -> Column:
    """Number of second boundaries crossed from ``start`` to ``end``.

    0.9 s to 2.1 s counts 2, like a calendar-unit difference; whole elapsed
    seconds would count 1.
    """
    return epoch_seconds(end, dtype) - epoch_seconds(start, dtype)
