"""Monthly means and their change over a year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def monthly_mean(df: DataFrame, key: str, time: str, value: str, mean: str) -> DataFrame:
    """A3: mean of ``value`` per key and calendar month, as ``year_month`` (a date).

    A null key is a group of its own.
    """
    month = F.trunc(F.col(time), "month").alias("year_month")
    return df.groupBy(key, month).agg(F.avg(value).alias(mean))


def lag_difference(
    df: DataFrame, key: str, order: Sequence[str], value: str, rows: int, name: str
) -> DataFrame:
    """Value minus the value ``rows`` rows earlier in the key's order.

    Counts rows, so a missing month shifts the comparison. Meant for aggregated
    input, where a key has as many rows as there are months.
    """
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(name, F.col(value) - F.lag(value, rows).over(window))


def calendar_difference(
    df: DataFrame, key: str, month: str, value: str, months: int, name: str
) -> DataFrame:
    """W3 by the calendar: value minus that of the same key ``months`` months before."""
    earlier = df.select(
        F.col(key).alias("_key"),
        F.add_months(F.col(month), months).alias("_month"),
        F.col(value).alias("_value"),
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(month) == F.col("_month"))
    return (
        df.join(earlier, same, "left")
        .withColumn(name, F.col(value) - F.col("_value"))
        .select(*df.columns, name)
    )
