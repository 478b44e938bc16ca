"""Tables of immutable versions.

A version is a folder that is never changed once it is complete. An empty marker
with its number makes it the current one, in one step on any file system, object
stores among them: nothing is renamed or overwritten. A reader looks the marker
up once and reads one folder, so it meets no gap and no mix of two versions.
Superseded versions stay for a while for readers that still read them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from obsflow import paths
from obsflow.sinks.files import write_parquet

# Underscores keep both from whoever reads the table's own path as Parquet.
_DATA, _MARKERS = "_data", "_versions"

#: Seconds for which a version stays once it is superseded; longer than any job that reads it.
RETAIN = 24 * 3600


def committed(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder) of the versions at hand, oldest first."""
    markers = (m.rpartition("/")[2].split(".") for m in paths.siblings(spark, path, f"/{_MARKERS}/*"))
    return sorted((int(number), folder) for number, folder in markers)


def resolve(spark: SparkSession, path: str) -> str | None:
    """The folder that holds the table's rows now; None if it was never written.

    A table from before it had versions lies at its path itself.
    """
    versions = committed(spark, path)
    if versions:
        return _folder(path, versions[-1][1])
    return path if paths.path_exists(spark, path) and _plain(spark, path) else None


def write_version(df: DataFrame, path: str, by: Sequence[str] = (), retain: float = RETAIN) -> int:
    """K2, K5: make ``df``, which may read from the table, its next version; gives the rows written.

    A run that breaks off leaves a folder without a marker, which nobody reads
    and a later run deletes. A table has one writer at a time; of two, one
    version wins as a whole.
    """
    spark = df.sparkSession
    folder = uuid.uuid4().hex
    rows = write_parquet(df, _folder(path, folder), by)
    newest = max((number for number, _ in committed(spark, path)), default=0)
    paths.make(spark, _marker(path, newest + 1, folder))
    retire(spark, path, retain)
    return rows


def retire(spark: SparkSession, path: str, retain: float = RETAIN) -> None:
    """Delete what was superseded, or left behind by a broken run, more than ``retain`` seconds ago."""
    before = time.time() - retain
    versions = committed(spark, path)
    if not versions:
        return
    kept = {versions[-1][1]}
    # A version is as long superseded as the one behind it is current.
    for (number, folder), successor in zip(versions, versions[1:]):
        if paths.modified(spark, _marker(path, *successor)) > before:
            kept.add(folder)
        else:
            paths.delete(spark, _marker(path, number, folder))
    for data in paths.siblings(spark, path, f"/{_DATA}/*"):
        if data.rpartition("/")[2] not in kept and paths.modified(spark, data) <= before:
            paths.delete(spark, data)
    if paths.modified(spark, _marker(path, *versions[0])) <= before:
        for old in _plain(spark, path):
            paths.delete(spark, old)


def _plain(spark: SparkSession, path: str) -> list[str]:
    """What lies in the table's path beside its versions."""
    return [p for p in paths.siblings(spark, path, "/*") if p.rpartition("/")[2] not in (_DATA, _MARKERS)]


def _folder(path: str, folder: str) -> str:
    return f"{path.rstrip('/')}/{_DATA}/{folder}"


def _marker(path: str, number: int, folder: str) -> str:
    return f"{path.rstrip('/')}/{_MARKERS}/{number}.{folder}"
