"""Flare classes, scores and report lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from obsflow.schemas import CLASS_SCORES

_WHITESPACE = " \t\r\n\x0b\x0c"
_LARGEST_INT = 2_147_483_647

# A class letter followed by its magnitude.
_CLASS_PATTERN = r"^([ABCMX])(\d+(?:\.\d+)?)"

# A lone class letter, then a lone number of one to three digits (magnitude times ten).
_REPORT_CLASS = r"(?:^| )([ABCMX]) ([0-9]{1,3})(?= |$)"
_FOUR_DIGITS = r"\A[0-9]{4}\z"


def class_letter(xray_class: Column) -> Column:
    """The class letter, or empty text when the class does not match."""
    return F.regexp_extract(xray_class, _CLASS_PATTERN, 1)


def class_magnitude(xray_class: Column) -> Column:
    """The magnitude behind the letter, or null."""
    return F.regexp_extract(xray_class, _CLASS_PATTERN, 2).try_cast("double")


def severity(letter: Column, magnitude: Column) -> Column:
    """Base score of the letter plus magnitude, cut to an int; not capped at 100."""
    base = F.lit(0)
    for name, score in CLASS_SCORES.items():
        base = F.when(letter == name, F.lit(score)).otherwise(base)
    total = base + F.coalesce(magnitude, F.lit(0.0))
    return F.least(total, F.lit(float(_LARGEST_INT))).cast("int")


def strip_line(line: Column) -> Column:
    """A report line without white space around it."""
    return F.btrim(line, F.lit(_WHITESPACE))


def is_report_data(line: Column) -> Column:
    """Whether a stripped report line is more than a blank, ``#`` or ``:`` line."""
    return ~line.rlike(r"\A(?:[#:]|\z)")


def report_fields(line: Column, year: Column) -> Column:
    """One stripped report line to a struct, null where the line is rejected.

    Fields: event_time, begin_time, end_time, max_time, xray_class, raw_line.
    """
    two_digit_year = F.substring(line, 6, 2).try_cast("int")
    full_year = two_digit_year + F.when(two_digit_year < 70, 2000).otherwise(1900)

    tokens = F.split(strip_line(F.substr(line, F.lit(12))), r"\s+")
    begin, end, peak = (F.get(tokens, i) for i in range(3))
    event_time = F.try_make_timestamp(
        full_year,
        F.substring(line, 8, 2).try_cast("int"),
        F.substring(line, 10, 2).try_cast("int"),
        F.substring(begin, 1, 2).try_cast("int"),
        F.substring(begin, 3, 2).try_cast("int"),
        F.lit(0),
    )

    tail = F.array_join(F.slice(tokens, F.lit(4), F.greatest(F.size(tokens), F.lit(0))), " ")
    letter = F.regexp_extract(tail, _REPORT_CLASS, 1)
    tenths = F.regexp_extract(tail, _REPORT_CLASS, 2).try_cast("int")
    xray_class = F.concat(letter, (tenths / 10).cast("decimal(4,1)").cast("string"))

    accepted = (
        (F.length(line) >= 27)
        & line.rlike(r"\A[0-9]{11}")
        & (full_year == year)
        & (F.size(tokens) >= 5)
        & begin.rlike(_FOUR_DIGITS)
        & event_time.isNotNull()
        & (letter != "")
    )
    return F.when(
        accepted,
        F.struct(
            event_time.alias("event_time"),
            F.date_format(event_time, "yyyy-MM-dd'T'HH:mm:ssxxx").alias("begin_time"),
            F.when(end.rlike(_FOUR_DIGITS), end).alias("end_time"),
            F.when(peak.rlike(_FOUR_DIGITS), peak).alias("max_time"),
            xray_class.alias("xray_class"),
            line.alias("raw_line"),
        ),
    )


def record_json(*fields: Column) -> Column:
    """Fields to one JSON text, nulls kept."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
