"""Time expressions.  The session time zone is UTC (see ``session``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import EVENT_TIME_FORMAT


MOST_MILLIS = (2**63 - 1) // 1000


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_seconds_to_text(col) -> Column:
    """Epoch seconds -> ``yyyy-MM-dd HH:mm:ss.SSS`` in UTC."""
    return F.date_format(F.timestamp_seconds(_c(col)), EVENT_TIME_FORMAT)


def parse_event_time(col) -> Column:
    """Event-time text -> TIMESTAMP; text that does not parse gives null."""
    return F.try_to_timestamp(_c(col), F.lit(EVENT_TIME_FORMAT))


def time_auto(col) -> Column:
    """A time given either as ISO-8601 text or as epoch milliseconds
    (digits only) -> TIMESTAMP.  Anything else gives null."""
    c = _c(col).cast("string")
    millis = c.try_cast("bigint")
    # Beyond this, microseconds don't fit in a timestamp.
    fits = millis.between(-MOST_MILLIS, MOST_MILLIS)
    return F.when(
        c.rlike(r"^-?[0-9]+$"), F.timestamp_millis(F.when(fits, millis))
    ).otherwise(F.try_to_timestamp(c))


def to_utc_timestamp_type(col) -> Column:
    """Watermarks need TIMESTAMP (D1): NTZ wall-clock values read as UTC."""
    return _c(col).cast("timestamp")


def to_ntz(col) -> Column:
    """Back to wall-clock TIMESTAMP_NTZ for output that is compared by value."""
    return _c(col).cast("timestamp_ntz")


def unix_millis_of(col) -> Column:
    """Record timestamp -> epoch milliseconds (truncating)."""
    return F.unix_millis(_c(col).cast("timestamp"))
