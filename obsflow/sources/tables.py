"""Parquet and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from obsflow.paths import path_exists, siblings


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet with a fixed schema; an absent path is an empty table.

    A table that is just being replaced, or whose replacement broke off, is not
    absent: its old rows lie in a sibling folder, and reading it is an error.
    """
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    if siblings(spark, path, ".previous-*"):
        raise FileNotFoundError(f"{path} is being replaced; its rows are in {siblings(spark, path, '.previous-*')[0]}")
    return spark.createDataFrame([], schema)


def read_required(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S4 for a table that an earlier job has to have written, with or without rows."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"{path} has not been written yet")
    return read_or_empty(spark, path, schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with the schema of its footers."""
    return spark.read.parquet(path)


def has_rows(df: DataFrame) -> bool:
    """Whether a load target is populated already."""
    return not df.isEmpty()


def catalog_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The table over existing Parquet files, created on first use.

    A table without partitions follows ``path`` when that names another folder than before.
    """
    ensure_database(spark, name)
    exists = spark.catalog.tableExists(name)
    if not exists:
        spark.catalog.createTable(name, path=path, source="parquet")
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    elif exists:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    return read_table(spark, name)


def ensure_database(spark: SparkSession, table: str) -> None:
    database = table.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A whole catalog table."""
    return spark.table(name)
