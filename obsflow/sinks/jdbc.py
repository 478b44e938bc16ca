"""Serving tables in a relational database (K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from obsflow.sinks.files import counted
from obsflow.sources.jdbc import connection


def write_database(df: DataFrame, dsn: str, table: str, connections: int = 8) -> int:
    """K4, K5: overwrite a table, keeping its indexes and grants; gives the rows written.

    ``connections`` bounds the tasks that write at the same time.
    """
    url, properties = connection(dsn)
    rows, observation = counted(df)
    (
        rows.write.option("truncate", True)
        .option("numPartitions", connections)
        .jdbc(url, table, mode="overwrite", properties=properties)
    )
    return observation.get["rows"]
