"""Union and best-row-per-key selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    Spark cuts each map task to one row per key before the shuffle
    (WindowGroupLimit), so a key that holds a third of all rows does not land
    in one task. Give a total order for a repeatable result.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The row with the greatest ``time`` per key; ``ties`` decide among equals."""
    order = [F.col(c).desc_nulls_last() for c in (time, *ties)]
    return best_per_key(df, keys, order)


def latest_per_key_agg(
    df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The same result as an aggregate, which also runs on a stream."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(time, *ties)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def merge_latest(
    existing: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    time: str,
    ties: Sequence[str] = (),
) -> DataFrame:
    """U1 + W1: union by name, then the latest row per key."""
    return latest_per_key(existing.unionByName(new), keys, time, ties)
