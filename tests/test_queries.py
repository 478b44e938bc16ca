"""Every registered query against its SQL in DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from verification import REGISTRY

QUERIES = {name: query.build for name, query in REGISTRY.items()}
SQL = {name: query.sql for name, query in REGISTRY.items()}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def printed(value):
    if isinstance(value, float):
        return f"{value:.4f}"
    return "NULL" if value is None else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(printed(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert expected, "the SQL gives no rows, so it shows nothing"
    assert table(df.columns, df.collect()) == table(columns, expected)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
