"""Event time to and from ISO-8601 text (in a UTC session)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_event_time(text: Column) -> Column:
    """Instant of an ISO-8601 text, NULL where it is none."""
    return F.try_to_timestamp(text)


def has_window(event_time: Column, length: str) -> Column:
    """Whether the tumbling window around a time, and the one before and after, can be represented."""
    margin = 2 * F.unix_micros(F.timestamp_micros(F.lit(0)) + F.lit(length).cast("interval"))
    micros = F.unix_micros(event_time)
    return (micros >= margin - (2**63 - 1)) & (micros <= F.lit(2**63 - 1) - margin)


def render_event_time(event_time: Column) -> Column:
    """ISO-8601 in UTC; whole seconds are written without a fraction."""
    fraction = F.date_format(event_time, ".SSSSSS")
    return F.concat(
        F.date_format(event_time, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == ".000000", "").otherwise(fraction),
        F.lit("+00:00"),
    )
