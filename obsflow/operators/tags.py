"""Exploded tags matched with a reference table and counted."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def reference_table(
    spark: SparkSession, pairs: Iterable[tuple[str, str]], names: tuple[str, str]
) -> DataFrame:
    """Literal pairs as a table, for broadcast since the driver holds them anyway."""
    rows = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, pair))) for pair in pairs]
    return F.broadcast(spark.range(1).select(F.inline(F.array(*rows))))


def explode_tags(df: DataFrame, array: str, name: str, keep: Sequence[str]) -> DataFrame:
    """G1: one row per array element; null and empty arrays give none."""
    return df.select(*keep, F.explode(array).alias(name))


def with_reference(tags: DataFrame, reference: DataFrame, on: str) -> DataFrame:
    """Inner equi-join with a reference table."""
    return tags.join(reference, on)


def count_by(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """A1: rows per composite key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
