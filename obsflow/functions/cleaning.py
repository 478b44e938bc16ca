"""Tolerant typing of text columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds since 1970 of the first and last instant that prints with a four-digit year.
_FIRST_SECOND = -62_135_596_800
_LAST_SECOND = 253_402_300_799

# Modified Julian Date of 1970-01-01.
_EPOCH_MJD = 40587.0


def blank_to_null(col: Column) -> Column:
    """Null for empty or space-only text, else the text as it stands."""
    return F.when(F.trim(col) != "", col)


def to_double(col: Column) -> Column:
    """Text to double, null where it does not parse."""
    return blank_to_null(col).try_cast("double")


def to_int(col: Column) -> Column:
    """Text to int by way of double, so ``2.9`` gives 2."""
    return to_double(col).try_cast("int")


def mjd_to_timestamp(col: Column) -> Column:
    """Modified Julian Date text to a timestamp in whole seconds.

    Dates that fall outside years 1 to 9999 give null instead of failing the job.
    """
    seconds = ((to_double(col) - _EPOCH_MJD) * 86400.0).try_cast("bigint")
    return F.when(
        seconds.between(_FIRST_SECOND, _LAST_SECOND), F.timestamp_seconds(seconds)
    )


def split_list(col: Column, delimiter: str = ";") -> Column:
    """P5: delimited text to an array; blank text gives a null array."""
    # Quoted, so that a delimiter such as "|" is not read as a pattern.
    return F.split(blank_to_null(col), rf"\Q{delimiter}\E", -1)


def relabel(col: Column, labels: Mapping[str, str], default: str) -> Column:
    """Replace known values by labels, everything else (and null) by ``default``."""
    result = F.lit(default)
    for value, label in labels.items():
        result = F.when(col == value, F.lit(label)).otherwise(result)
    return result
