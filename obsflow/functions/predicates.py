"""Row filters as Columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from obsflow.schemas import EARLIEST_EVENT, LATEST_EVENT


def all_present(*cols: str) -> Column:
    """Every named column is not null."""
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in cols))


def one_of(col: Column, values: Iterable[str]) -> Column:
    """Membership in a literal list."""
    return col.isin(*values)


def one_of_upper(col: Column, values: Iterable[str]) -> Column:
    """Membership after upper-casing the column; the values are upper case already."""
    return F.upper(col).isin(*values)


def plausible(col: Column, first: str = EARLIEST_EVENT, last: str = LATEST_EVENT) -> Column:
    """P10: between two dates at midnight, both included."""
    return col.between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp"))


def positive(col: Column) -> Column:
    """A number above zero; null and NaN fail."""
    return (col > 0) & ~F.isnan(col)


def non_empty(col: Column) -> Column:
    """Text that is neither null nor empty."""
    return col != ""


def in_range(col: Column, first: str | None, last: str | None, type_name: str) -> Column:
    """Closed range where a missing or empty bound sets no condition.

    A date as upper bound of a timestamp means its midnight.
    """
    condition = F.lit(True)
    if first:
        condition = condition & (col >= F.lit(first).cast(type_name))
    if last:
        condition = condition & (col <= F.lit(last).cast(type_name))
    return condition
