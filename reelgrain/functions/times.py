"""Timestamp, duration and interval expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two time formats found in metadata and file names.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"
COMPACT_FORMAT = "yyyyMMdd'T'HHmmssX"
COMPACT_PATTERN = "[0-9]{8}T[0-9]{6}Z"


def parse_timestamp(text: Column) -> Column:
    """ISO or compact text to a timestamp; null where neither fits."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(ISO_FORMAT)),
        F.try_to_timestamp(text, F.lit(COMPACT_FORMAT)),
    )


def format_iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def clock_seconds(text: Column) -> Column:
    """`HH:MM:SS.cc` to seconds."""
    pattern = "^([0-9]+):([0-9]{2}):([0-9]{2}(?:\\.[0-9]+)?)$"
    part = [F.nullif(F.regexp_extract(text, pattern, i), F.lit("")).cast("double") for i in (1, 2, 3)]
    return part[0] * 3600 + part[1] * 60 + part[2]


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, for timestamps with or without zone."""
    return F.unix_micros(ts.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(1e6)


def older_than(ts: Column, now: Column, days: Column) -> Column:
    """Strictly older than a number of days."""
    return micros(ts) < micros(now) - days.cast("long") * F.lit(86_400_000_000)
