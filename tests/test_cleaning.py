"""P1-P6, P15 and the filters P7-P14."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from obsflow.functions import cleaning, predicates
from tests.conftest import rows


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in rows(df.select("i", function(F.col("v"))), "i")]


def test_p1_blank_to_null(spark):
    values = [None, "", "  ", "\t", " x ", "x"]
    assert apply(spark, cleaning.blank_to_null, values) == [None, None, None, "\t", " x ", "x"]


def test_p2_to_double(spark):
    values = ["abc", " 1.5 ", "1e3", "1d", "", None, "Infinity", "-0.5"]
    expected = [None, 1.5, 1000.0, 1.0, None, None, math.inf, -0.5]
    assert apply(spark, cleaning.to_double, values) == expected
    assert math.isnan(apply(spark, cleaning.to_double, ["NaN"])[0])


def test_p3_to_int(spark):
    values = ["3.0", "2.9", "-2.9", "x", "", "9e18"]
    assert apply(spark, cleaning.to_int, values) == [3, 2, -2, None, None, None]


def test_p4_mjd(spark):
    values = ["40587", "58849.5", "58849.123456", "40586.99999", "", "x", "NaN", "1e13", "1e300"]
    expected = [
        datetime(1970, 1, 1),
        datetime(2020, 1, 1, 12),
        datetime(2020, 1, 1, 2, 57, 46),
        datetime(1970, 1, 1),
        None, None, None, None, None,
    ]
    text = apply(
        spark, lambda c: cleaning.mjd_to_timestamp(c).cast("timestamp_ntz"), values
    )
    assert text == expected


def test_p5_split(spark):
    values = ["a;;b;", "a", " a; b", "", " ", None]
    expected = [["a", "", "b", ""], ["a"], [" a", " b"], None, None, None]
    assert apply(spark, cleaning.split_list, values) == expected
    assert apply(spark, lambda c: cleaning.split_list(c, "|"), ["a|b"]) == [["a", "b"]]


def test_p15_relabel(spark):
    got = apply(spark, lambda c: cleaning.relabel(c, {"a": "A"}, "other"), ["a", "b", None])
    assert got == ["A", "other", "other"]


def test_p9_upper_membership(spark):
    got = apply(spark, lambda c: predicates.one_of_upper(c, ["DARK"]), ["dark", "Dark", "dark ", None])
    assert got == [True, True, False, None]


def test_p10_plausible(spark):
    values = ["1989-12-31 23:59:59", "1990-01-01", "2030-12-31 00:00:00", "2030-12-31 00:01:00"]
    got = apply(spark, lambda c: predicates.plausible(c.cast("timestamp")), values)
    assert got == [False, True, True, False]


def test_p11_positive(spark):
    got = apply(spark, lambda c: predicates.positive(c.cast("double")), ["1", "0", "-1", "NaN", None])
    assert [bool(v) for v in got] == [True, False, False, False, False]


def test_p12_non_empty(spark):
    got = apply(spark, predicates.non_empty, ["a", "", " ", None])
    assert [bool(v) for v in got] == [True, False, True, False]


@pytest.mark.parametrize(
    "first,last,expected",
    [
        (None, None, [0, 1, 2, 3]),
        ("", "", [0, 1, 2, 3]),
        ("2015-01-01", None, [1, 2, 3]),
        (None, "2015-12-31", [0, 1, 2]),
        ("2015-01-01", "2015-12-31", [1, 2]),
    ],
)
def test_p14_range(spark, first, last, expected):
    times = ["2014-12-31 23:59:59", "2015-01-01", "2015-12-31", "2015-12-31 00:00:01"]
    df = spark.createDataFrame(list(enumerate(times)), "i int, v string")
    kept = df.filter(predicates.in_range(F.col("v").cast("timestamp"), first, last, "timestamp"))
    assert [r[0] for r in rows(kept, "i")] == expected
