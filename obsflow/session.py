"""Session building and the shared folder for intermediate files."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution.

    Sizing (executors, memory, shuffle partitions) is left to spark-submit or
    to ``conf``, whose keys use ``__`` for a dot.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # State of streams on local disk, not on the heap; checkpoints stay in the shared folder.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session without that setting gets a temporary folder, since
    there driver and executors are one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="obsflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
