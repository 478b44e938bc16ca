"""Parquet writers (K1, K2, K5)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from obsflow import paths
from obsflow.session import scratch_path

# Keeps files near a gigabyte for the row widths at hand.
ROWS_PER_FILE = 10_000_000


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """K5: the same rows with a row counter that is filled by the write itself."""
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, so that later steps read files instead of computing them again.

    Every executor reaches that folder: a lost one costs its running tasks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_parquet(df: DataFrame, path: str, by: Sequence[str] = ()) -> int:
    """K1, K5: overwrite a path that ``df`` does not read; gives the rows written."""
    rows, observation = counted(df)
    (
        rows.write.mode("overwrite")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*by)
        .parquet(path)
    )
    return observation.get["rows"]


def replace_parquet(df: DataFrame, path: str, by: Sequence[str] = ()) -> int:
    """K2: replace a path that ``df`` may read from.

    The new files are complete in a sibling folder before the old ones move
    aside, so neither a failed job nor a lost executor costs the old rows. A
    reader that comes between the two renames gets an error, no empty table
    (see ``read_or_empty``). A table has one writer at a time.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    recover(spark, path)
    run = uuid.uuid4().hex[:12]
    staged, previous = f"{path}.staged-{run}", f"{path}.previous-{run}"
    rows = write_parquet(df, staged, by)
    replaces = paths.path_exists(spark, path)
    if replaces:
        paths.rename(spark, path, previous)
    paths.rename(spark, staged, path)
    if replaces:
        paths.delete(spark, previous)
    spark.catalog.refreshByPath(path)
    return rows


def recover(spark: SparkSession, path: str) -> None:
    """Puts the old rows back where a replacement broke off, and clears what it left behind."""
    path = path.rstrip("/")
    for previous in paths.siblings(spark, path, ".previous-*"):
        if paths.path_exists(spark, path):
            paths.delete(spark, previous)
        else:
            paths.rename(spark, previous, path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> int:
    """K2: replace only the partitions that occur in ``df``, which may read from ``path``.

    Spark moves the new partitions in after all tasks have finished. The
    rebalance hint splits a partition that holds most of the rows over several
    tasks and merges the small ones.
    """
    rows, observation = counted(df.hint("rebalance", *by))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*by)
        .parquet(path)
    )
    df.sparkSession.catalog.refreshByPath(path)
    return observation.get["rows"]
