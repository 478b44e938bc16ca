"""Event time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CLOCK = r"\A[0-9]{4}\z"
_MINUTE = 60_000_000
_DAY = 24 * 60 * _MINUTE
_DATE_FIRST = r"\A\s*[0-9]{4}-[0-9]{2}-[0-9]{2}"


def parse_iso(text: Column) -> Column:
    """ISO text to timestamp; no zone means UTC (the session's zone)."""
    return F.when(text.rlike(_DATE_FIRST), F.try_to_timestamp(text))


def event_start(begin_text: Column, fallback: Column) -> Column:
    """The time in the record, else the time of the envelope."""
    return F.coalesce(parse_iso(begin_text), fallback)


def clock_after(text: Column, start: Column) -> Column:
    """Four digits are a clock time, other text is ISO.

    A clock time means its first occurrence at or after ``start``, in UTC: on
    the same day, or on the next one if it lies before the start.
    """
    hour = F.substring(text, 1, 2).try_cast("int")
    minute = F.substring(text, 3, 2).try_cast("int")
    clock = (hour * 60 + minute).cast("bigint") * _MINUTE
    begin = F.unix_micros(start)
    occurrence = F.timestamp_micros(begin + F.pmod(clock - begin, F.lit(_DAY)))
    return F.when(text.rlike(_CLOCK), F.when((hour < 24) & (minute < 60), occurrence)).otherwise(
        parse_iso(text)
    )
