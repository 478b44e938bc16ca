"""Landed payloads into the bronze table as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from obsflow.plans.jobs import Layout, merge_payloads, refresh_changed_flares, refresh_contaminated


def start_bronze(
    payloads: DataFrame,
    layout: Layout,
    checkpoint: str,
    trigger: dict | None = None,
    after_batch: Callable[[int], object] | None = None,
) -> StreamingQuery:
    """Merge every batch of a payload stream into bronze.

    A batch that is run again after a failure rewrites the same keys, so it
    adds no row (T5). Without a trigger the payloads at hand are taken in and
    the query ends.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        merge_payloads(batch.sparkSession, layout, batch)
        if after_batch:
            after_batch(batch_id)

    return (
        payloads.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_refresh(
    payloads: DataFrame,
    layout: Layout,
    checkpoint: str,
    trigger: dict | None = None,
    after_gold: Callable[[str], object] | None = None,
) -> StreamingQuery:
    """As T1, and after every batch silver flares and contaminated observations."""
    spark = payloads.sparkSession

    def rebuild(_: int) -> None:
        refresh_changed_flares(spark, layout)
        refresh_contaminated(spark, layout)
        if after_gold:
            after_gold("contaminated_obs")

    return start_bronze(payloads, layout, checkpoint, trigger, rebuild)
