"""Time functions."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def epoch_ms(local: Column) -> Column:
    """Milliseconds since 1970 of a time without zone, read as UTC.

    Does not depend on the time zone of the session.
    """
    since = local - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    seconds = since.cast("interval second").cast("decimal(20, 6)")
    return F.floor(seconds * 1000).cast("long")


def recent(time_ms: Column, as_of_ms: int, days: int) -> Column:
    """Within the last ``days`` before ``as_of_ms``."""
    return time_ms > F.lit(as_of_ms - days * DAY_MS)


def recent_times(local: Column, as_of_ms: int, days: int) -> Column:
    """``recent`` for a time without zone, read as UTC.

    The column is compared as it is stored, so that the filter reaches the scan.  Times
    are cut to milliseconds, so the first that counts is one millisecond later.
    """
    start = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=as_of_ms - days * DAY_MS + 1)
    return local >= F.expr(f"TIMESTAMP_NTZ '{start:%Y-%m-%d %H:%M:%S.%f}'")


def elapsed_seconds(time_ms: Column, as_of_ms: int) -> Column:
    """Seconds from a time to ``as_of_ms``."""
    return (F.lit(as_of_ms) - time_ms) / F.lit(1000.0)
