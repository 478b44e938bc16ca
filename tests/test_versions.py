"""Tables of immutable versions."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from obsflow import versions
from obsflow.sinks import catalog
from obsflow.sources import tables
from tests.conftest import rows


def read(spark, path):
    return spark.read.parquet(versions.resolve(spark, path))


def test_a_version_may_be_made_of_the_one_before(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.resolve(spark, path) is None
    assert versions.write_version(spark.range(5), path) == 5
    assert versions.write_version(read(spark, path).union(spark.range(5, 8)), path) == 8
    assert sorted(r[0] for r in rows(read(spark, path))) == list(range(8))
    assert [n for n, _ in versions.committed(spark, path)] == [1, 2]


def test_a_reader_never_fails_and_never_sees_a_mix(spark, tmp_path):
    """Every version holds its number in 20 rows over several files; a reader loops during 50 swaps."""
    path, seen, errors, done = str(tmp_path / "t"), [], [], threading.Event()

    def version(number):
        return spark.range(20, numPartitions=2).select(F.lit(number).alias("version"), "id")

    versions.write_version(version(0), path)

    def reader():
        while not done.is_set():
            try:
                seen.append(rows(read(spark, path).groupBy("version").count()))
            except Exception as error:  # noqa: BLE001
                errors.append(error)

    thread = threading.Thread(target=reader)
    thread.start()
    for number in range(1, 51):
        versions.write_version(version(number), path)
    done.set()
    thread.join()
    assert not errors and len(seen) > 5
    assert all(len(found) == 1 and found[0][1] == 20 for found in seen)
    order = [found[0][0] for found in seen]
    assert order == sorted(order) and len(set(order)) > 2


def test_a_broken_run_changes_nothing_and_is_cleared_away(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write_version(spark.range(5), path)
    with pytest.raises(Exception, match="broken"):
        versions.write_version(read(spark, path).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert read(spark, path).count() == 5
    os.makedirs(f"{path}/_data/left-behind")
    versions.write_version(spark.range(6), path)
    assert "left-behind" in os.listdir(f"{path}/_data")
    versions.retire(spark, path, retain=-60)
    assert os.listdir(f"{path}/_data") == [versions.committed(spark, path)[-1][1]]


def test_superseded_versions_stay_for_their_time(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 4):
        versions.write_version(spark.range(n), path)
    assert len(os.listdir(f"{path}/_data")) == 3
    versions.write_version(spark.range(9), path, retain=-60)
    assert [n for n, _ in versions.committed(spark, path)] == [4]
    assert len(os.listdir(f"{path}/_data")) == 1 and read(spark, path).count() == 9


def test_plain_files_are_the_version_before_the_first(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4).write.parquet(path)
    assert versions.resolve(spark, path) == path and read(spark, path).count() == 4
    before = read(spark, path)
    versions.write_version(before.union(spark.range(4, 6)), path)
    assert read(spark, path).count() == 6 and before.count() == 4
    versions.retire(spark, path, retain=-60)
    assert sorted(os.listdir(path)) == ["_data", "_versions"] and read(spark, path).count() == 6


def test_partitions_and_empty_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write_version(spark.range(6).selectExpr("id", "id % 3 AS p"), path, by=["p"])
    assert rows(read(spark, path).filter("p = 1"), "id") == [(1, 1), (4, 1)]
    versions.write_version(spark.range(0).selectExpr("id"), path)
    assert read(spark, path).count() == 0


def test_the_catalog_follows_the_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (4, 9):
        catalog.publish(spark.range(n), "lake.versioned", path)
        assert tables.read_table(spark, "lake.versioned").count() == n
    other = str(tmp_path / "s")
    for n in (3, 5):
        versions.write_version(spark.range(n), other)
        assert tables.catalog_table(spark, "lake.resolved", versions.resolve(spark, other)).count() == n
