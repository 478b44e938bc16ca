"""Catalog tables over written files (K3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from obsflow import versions
from obsflow.sources.tables import ensure_database


def publish(df: DataFrame, table: str, path: str) -> int:
    """K1, K3, K5: write the next version of the table at ``path`` and have ``table`` show it.

    The table is dropped and made again only when its columns changed; on a
    plain refresh the catalog moves it from version to version in one step, so
    readers do not meet a gap.
    """
    spark = df.sparkSession
    rows = versions.write_version(df, path)
    register(spark, table, versions.resolve(spark, path))
    return rows


def register(spark: SparkSession, table: str, path: str) -> None:
    ensure_database(spark, table)
    written = spark.read.parquet(path).schema
    if spark.catalog.tableExists(table):
        if spark.table(table).schema == written:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=path, source="parquet")


def register_view(spark: SparkSession, table: str, path: str, columns: Sequence[str]) -> None:
    """K3 for files that hold more than their readers are shown: a view of some columns, which lists the files anew each time."""
    ensure_database(spark, table)
    shown = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {shown} FROM parquet.`{path}`")
