"""Keep-latest as a stateful aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from obsflow.operators.latest import latest_per_key, latest_per_key_agg
from obsflow.streaming.batches import RETAIN, commit_batch, compact, read_batches


def start_latest(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    path: str,
    checkpoint: str,
    ties: Sequence[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the keys that changed in a batch, committed by query and batch (``commit_batch``).

    The state holds one row per key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        commit_batch(batch, path, batch_id)

    return (
        latest_per_key_agg(stream, keys, time, ties)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_latest(
    spark: SparkSession, path: str, keys: Sequence[str], time: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The table behind T2: per key its latest row.

    Rows are compared by time and ties, as the state compares them; the numbers
    of batches start anew with a new checkpoint.
    """
    return latest_per_key(read_batches(spark, path), keys, time, ties)


def compact_latest(
    spark: SparkSession, path: str, keys: Sequence[str], time: str, ties: Sequence[str] = (), retain: float = RETAIN
) -> int:
    """Fold the batches of T2 into the latest row per key of each query; gives the folders left (``compact``)."""
    return compact(spark, path, lambda rows: latest_per_key(rows, keys, time, ties), keys, retain)
