"""Scans that lie in few tasks are dealt anew, and no others."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from obsflow.operators import sizing
from verification import inputs


@pytest.fixture
def one_group(spark, tmp_path):
    """A file of one row group."""
    path = str(tmp_path / "lineitem.parquet")
    row = {
        "l_orderkey": "id", "l_partkey": "id % 300", "l_suppkey": "id % 40", "l_linenumber": "int(id % 7 + 1)",
        "l_quantity": "double(id % 50)", "l_extendedprice": "id / 1e2", "l_discount": "5e-2", "l_tax": "2e-2",
        "l_returnflag": "'R'", "l_linestatus": "'O'", "l_shipdate": "timestamp_ntz'1996-03-04'",
    }
    rows = spark.range(2000).union(spark.range(2000)).coalesce(1)
    rows.selectExpr(*(f"{value} AS {name}" for name, value in row.items())).write.parquet(path)
    return path


def _tasks(df) -> int:
    return df.select(F.spark_partition_id()).distinct().count()


def test_one_row_group_is_dealt_over_the_cores(spark, one_group, monkeypatch):
    monkeypatch.setattr(sizing, "EVEN_ROWS", 100)
    scan = spark.read.parquet(one_group)
    raw = inputs.raw_observations(spark, one_group.rsplit("/", 1)[0])
    assert _tasks(scan) == 1
    assert _tasks(raw) > 1
    dealt = sizing.spread(scan)
    assert dealt.exceptAll(scan).isEmpty() and scan.exceptAll(dealt).isEmpty()


def test_small_even_and_empty_scans_stay(spark, one_group, monkeypatch):
    scan = spark.read.parquet(one_group)
    assert sizing.spread(scan) is scan
    monkeypatch.setattr(sizing, "EVEN_ROWS", 100)
    even = scan.repartition(2 * spark.sparkContext.defaultParallelism)
    assert sizing.spread(even) is even
    none = scan.filter("l_orderkey < 0")
    assert sizing.spread(none) is none
