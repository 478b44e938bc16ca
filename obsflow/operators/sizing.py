"""Broadcast only what was measured to be small; deal anew only what was measured to lie in few tasks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side of up to this many bytes, as measured, is broadcast; a driver of default memory holds it.
BROADCAST_LIMIT = 64 * 1024 * 1024

#: A scan task of up to so many rows is left as it is, however uneven the scan.
EVEN_ROWS = 250_000

# Bytes per row of a hashed relation beyond its text.
_ROW_BYTES = 48
_COLUMN_BYTES = 16


def row_bytes(df: DataFrame) -> Column:
    """About the bytes one row takes in memory; text counts by its length."""
    fixed = F.lit(_ROW_BYTES + _COLUMN_BYTES * len(df.columns)).cast("bigint")
    flat = (T.NumericType, T.DatetimeType, T.BooleanType)
    variable = [
        F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0))
        for f in df.schema.fields
        if not isinstance(f.dataType, flat)
    ]
    return reduce(lambda a, b: a + b, variable, fixed)


def spread(scan: DataFrame) -> DataFrame:
    """The rows of a plain scan, dealt over the cores where one of its tasks has over twice its share.

    Spark cuts a Parquet file at row groups only, so that a file with one of them is one task, however large,
    and so is all that follows up to the first shuffle. The rows per task come from the footers.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    tasks = scan.select(F.spark_partition_id().alias("_task")).groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    largest, rows = tasks.agg(F.max("_n"), F.sum("_n")).first()
    if not rows or largest <= max(EVEN_ROWS, 2 * rows // cores):
        return scan
    return scan.repartition(max(cores, -(-rows // EVEN_ROWS)))
