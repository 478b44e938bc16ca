"""Helpers that several of the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.session import scratch_path

# Words are maximal runs of anything but the space and the five ASCII controls
# from tab to carriage return; ``bytes.split()`` splits at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"


#: Texts are long, so what a Python worker gets at a time is bounded in bytes, not in rows.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session to 8 MB; a worker's memory is a multiple of that."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows as a table in the shared folder: later jobs read files, not lineage.

    Every executor can read them again, so a lost executor costs its running
    tasks only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_map(
    df: DataFrame,
    step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    bound_batches(df.sparkSession)
    return df.mapInArrow(step, schema)


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


def int64(column: pa.Array, null: int = 0) -> np.ndarray:
    return column.fill_null(null).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit integers scrambled (the finalizer of SplitMix64), so that order and bits look random."""
    with np.errstate(over="ignore"):
        z = values.astype(np.uint64, copy=True)
        z ^= z >> np.uint64(30)
        z *= np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(27)
        z *= np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return z


def groups_of(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes add up to about ``limit``, one item at least."""
    begin = held = 0
    at = -1
    for at, size in enumerate(sizes):
        if held and held + size > limit:
            yield begin, at
            begin, held = at, 0
        held += size
    if at >= begin:
        yield begin, at + 1


def hash_share(column: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the value and the seed alone: 52 bits of MD5."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(column.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)
