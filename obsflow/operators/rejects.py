"""Valid rows and rejected rows of one layer (K7)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def with_reason(df: DataFrame, reasons: Mapping[str, Column]) -> DataFrame:
    """Add the first reason whose condition holds; null marks a valid row.

    A condition that evaluates to null does not hold.
    """
    result = F.lit(None).cast("string")
    for reason, condition in reversed(list(reasons.items())):
        result = F.when(condition, F.lit(reason)).otherwise(result)
    return df.withColumn(REASON, result)


def valid(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNotNull())
