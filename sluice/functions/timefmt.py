"""Timestamp text conversions. The session time zone is UTC (see session.ensure_utc)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.schema import RFC3339_PATTERN, RFC3339_SECONDS

# Instants representable as year 0001..9999 (the range RFC 3339 text can hold).
MIN_EPOCH_MS = -62135596800000
MAX_EPOCH_MS = 253402300799999


def parse_rfc3339(text: Column) -> Column:
    """RFC 3339 text to TIMESTAMP; null when the text is not RFC 3339."""
    return F.try_to_timestamp(text, F.lit(RFC3339_PATTERN))


def rfc3339_to_epoch_ms(text: Column) -> Column:
    """RFC 3339 text to epoch milliseconds as text; null when not RFC 3339.

    Sub-millisecond parts are cut toward zero (integer division), so an
    instant 0.5 ms before 1970 gives 0, not -1 as flooring would.
    """
    return F.call_function("div", F.unix_micros(parse_rfc3339(text)), F.lit(1000)).cast("string")


def epoch_ms_in_range(ms: Column) -> Column:
    return ms.between(F.lit(MIN_EPOCH_MS), F.lit(MAX_EPOCH_MS))


def epoch_ms_to_rfc3339(ms: Column) -> Column:
    """Epoch milliseconds to RFC 3339 with whole seconds; null when out of range."""
    return F.when(epoch_ms_in_range(ms), F.date_format(F.timestamp_millis(ms), RFC3339_SECONDS))


def now_epoch_seconds() -> Column:
    """X11: current UTC time in epoch seconds (fixed per query, so all rows agree)."""
    return F.unix_seconds(F.current_timestamp())


def event_time(text: Column) -> Column:
    """The instant a raw ``timestamp`` names: RFC 3339 if it parses, else whole epoch
    seconds (digits only, years 0001 to 9999), else null. The raw text stays the record field."""
    secs = F.when(text.rlike(r"^-?[0-9]+\z"), text.try_cast("bigint"))
    in_range = secs.between(F.lit(MIN_EPOCH_MS // 1000), F.lit(MAX_EPOCH_MS // 1000))
    return F.coalesce(parse_rfc3339(text), F.timestamp_seconds(F.when(in_range, secs)))
