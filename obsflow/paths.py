"""Paths on whatever file system they name."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _on_file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = _on_file_system(spark, path)
    return system.exists(target)


def make(spark: SparkSession, path: str) -> None:
    system, target = _on_file_system(spark, path)
    system.mkdirs(target)


def rename(spark: SparkSession, old: str, new: str) -> None:
    system, source = _on_file_system(spark, old)
    _, target = _on_file_system(spark, new)
    if not system.rename(source, target):
        raise OSError(f"cannot rename {old} to {new}")


def modified(spark: SparkSession, path: str) -> float:
    """When a path was last modified, in seconds since 1970; 0 if it is gone."""
    system, target = _on_file_system(spark, path)
    return system.getFileStatus(target).getModificationTime() / 1000 if system.exists(target) else 0.0


def delete(spark: SparkSession, path: str) -> None:
    system, target = _on_file_system(spark, path)
    system.delete(target, True)


def siblings(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Paths beside this one whose names go on with the suffix, a glob pattern."""
    system, pattern = _on_file_system(spark, path.rstrip("/") + suffix)
    return [status.getPath().toString() for status in system.globStatus(pattern) or []]
