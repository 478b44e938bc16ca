"""W1-W3, U1, G1, J2, A1-A3, R1-R7, K7."""

import math
from datetime import date

from pyspark.sql import functions as F

from obsflow.operators import grid, kpis, latest, rejects, sizing, tags, trends
from tests.conftest import rows


def test_w1_latest(spark):
    data = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "n"), ("b", 0, "m"), (None, 5, "q")]
    df = spark.createDataFrame(data, "k string, t int, v string")
    expected = [(None, 5, "q"), ("a", 3, "z"), ("b", 0, "m")]
    assert rows(latest.latest_per_key(df, ["k"], "t", ["v"]), "k") == expected
    assert rows(latest.latest_per_key_agg(df, ["k"], "t", ["v"]), "k") == expected


def test_w1_merge_twice_adds_nothing(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "k string, t int, v string")
    new = spark.createDataFrame([("y", 2, "a"), ("z", 0, "b")], "v string, t int, k string")
    once = latest.merge_latest(old, new, ["k"], "t", ["v"])
    twice = latest.merge_latest(once, new, ["k"], "t", ["v"])
    assert rows(once, "k") == rows(twice, "k") == [("a", 2, "y"), ("b", 1, "x")]


def test_w2_cuts_groups_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 AS k", "id AS v")
    plan = latest.best_per_key(df, ["k"], [F.col("v").desc()])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_a2_grid(spark):
    data = [(-0.5, 0.0, 1.0), (-1.0, 0.9, None), (2.0, 1.0, None), (None, 1.0, 5.0), (1.0, None, 5.0),
            (math.nan, 0.0, 1.0)]
    df = spark.createDataFrame(data, "x double, y double, w double")
    assert rows(grid.grid_aggregate(df, "x", "y", "w"), "ra_bin") == [
        (-1.0, 0.0, 2, 1.0), (2.0, 1.0, 1, 0.0),
    ]
    wide = grid.grid_aggregate(df, "x", "y", "w", 10.0)
    assert rows(wide, "ra_bin") == [(-10.0, 0.0, 2, 1.0), (0.0, 0.0, 1, 0.0)]


def test_r6_empty_and_busy_cells(spark):
    cells = spark.createDataFrame(
        [(0.0, -1.0, 5, 1.0), (1.0, 0.0, 9, 1.0), (0.0, 0.0, 5, 1.0)],
        "ra_bin double, dec_bin double, nb_obs long, total_exptime double",
    )
    empty = grid.empty_cells(cells, "ra_bin", "dec_bin", (0, 3), (-1, 1))
    assert rows(empty, "ra_bin", "dec_bin") == [(1.0, -1.0), (2.0, -1.0), (2.0, 0.0)]
    assert [r[:2] for r in rows(grid.busiest_cells(cells, 2))] == [(1.0, 0.0), (0.0, -1.0)]


def monthly(spark, months):
    data = [("i", date(2000 + m // 12, m % 12 + 1, 1), float(m * m)) for m in months]
    return spark.createDataFrame(data, "k string, year_month date, v double")


def test_a3_monthly_mean(spark):
    data = [("i", "2020-01-01", 1.0), ("i", "2020-01-31 23:59:59", 3.0), ("i", "2020-02-01", 5.0),
            (None, "2020-02-01", 7.0), (None, "2020-02-02", 9.0)]
    df = spark.createDataFrame(data, "k string, t string, v double").withColumn("t", F.col("t").cast("timestamp"))
    assert rows(trends.monthly_mean(df, "k", "t", "v", "m"), "k", "year_month") == [
        (None, date(2020, 2, 1), 8.0), ("i", date(2020, 1, 1), 2.0), ("i", date(2020, 2, 1), 5.0),
    ]


def test_w3_lag_counts_rows(spark):
    full = trends.lag_difference(monthly(spark, range(14)), "k", ["year_month"], "v", 12, "d")
    assert [r[3] for r in rows(full, "year_month")] == [None] * 12 + [144.0, 168.0]
    # Without month 3, month 13 is compared with month 0.
    gap = monthly(spark, [m for m in range(14) if m != 3])
    by_row = trends.lag_difference(gap, "k", ["year_month"], "v", 12, "d")
    assert rows(by_row, "year_month")[-1][3] == 169.0
    by_month = trends.calendar_difference(gap, "k", "year_month", "v", 12, "d")
    assert rows(by_month, "year_month")[-1][3] == 168.0
    short = trends.lag_difference(monthly(spark, range(5)), "k", ["year_month"], "v", 12, "d")
    assert {r[3] for r in rows(short)} == {None}


def test_w3_calendar_keeps_a_null_key(spark):
    df = monthly(spark, [0, 12]).withColumn("k", F.lit(None).cast("string"))
    got = trends.calendar_difference(df, "k", "year_month", "v", 12, "d")
    assert [r[3] for r in rows(got, "year_month")] == [None, 144.0]


def test_g1_j2_a1(spark):
    data = [("t", ["F656N", "F656N", "none"]), ("t", None), ("t", []), ("u", ["F502N"])]
    df = spark.createDataFrame(data, "target string, filters array<string>")
    lines = tags.reference_table(spark, [("F656N", "Halpha"), ("F502N", "OIII")], ("f", "line"))
    joined = tags.with_reference(tags.explode_tags(df, "filters", "f", ["target"]), lines, "f")
    assert rows(tags.count_by(joined, ["target", "f", "line"], "n"), "target") == [
        ("t", "F656N", "Halpha", 2), ("u", "F502N", "OIII", 1),
    ]


def test_sizing(spark):
    df = spark.range(100).selectExpr("id", "repeat('x', 1000) AS s")
    size = df.agg(F.sum(sizing.row_bytes(df))).first()[0]
    assert 100_000 < size < 120_000


def test_r1_to_r5(spark):
    sky = spark.createDataFrame(
        [(0.0, 1.0, 2, 3.0), (0.0, 2.0, 2, 4.5)],
        "ra_bin double, dec_bin double, nb_obs long, total_exptime double",
    )
    assert rows(kpis.sky_kpis(sky)) == [(1, 7.5)]
    targets = spark.createDataFrame(
        [("a", "F2", "x", 3), ("b", "F1", "y", 2), ("c", "F1", "y", 1), ("a", "F1", "y", 0)],
        "target_name string, filter string, emission_line string, nb_obs long",
    )
    assert rows(kpis.narrow_band_kpis(targets)) == [(3, "F1", 3)]
    assert rows(kpis.narrow_band_kpis(targets.limit(0))) == [(0, None, None)]
    matrix = kpis.target_line_matrix(targets, ["x", "y"])
    assert rows(matrix, "target_name") == [("a", 3, 0), ("b", None, 2), ("c", None, 1)]
    risks = spark.createDataFrame([(80,), (81,), (108,), (9,), (0,)], "risk_score int")
    assert rows(kpis.risk_kpis(risks)) == [(5, 2)]
    assert rows(kpis.risk_histogram(risks), "risk_from") == [(0, 2), (80, 2), (100, 1)]


def test_r7(spark):
    data = [("a", date(2020, 1, 1), 1.0, None), ("a", date(2021, 1, 1), 3.0, 2.0),
            ("b", date(2021, 1, 1), 1.0, 5.0), ("b", date(2021, 2, 1), 1.0, -4.0)]
    df = spark.createDataFrame(data, "instrument string, year_month date, avg_calib_time double, trend_12m double")
    assert rows(kpis.strongest_drift(df)) == [("a", 2.0)]
    assert rows(kpis.yearly_drift(df), "instrument", "year") == [
        ("a", 2020, 1.0, None), ("a", 2021, 3.0, 2.0), ("b", 2021, 1.0, 0.5),
    ]


def test_k7_first_reason_wins(spark):
    df = spark.createDataFrame([(1, None), (None, None), (5, 5)], "a int, b int")
    marked = rejects.with_reason(df, {"no a": F.col("a").isNull(), "small a": F.col("a") < 3})
    assert rows(rejects.valid(marked)) == [(5, 5)]
    assert sorted(r[2] for r in rows(rejects.rejected(marked))) == ["no a", "small a"]


def test_r6_blind_spots_of_a_tenth_of_a_degree(spark):
    points = spark.createDataFrame([(0.35, 0.15, 1.0)], "x double, y double, w double")
    cells = grid.grid_aggregate(points, "x", "y", "w", 0.1)
    empty = grid.empty_cells(cells, "ra_bin", "dec_bin", (0.0, 2.0), (-0.5, 0.5), 0.1)
    assert empty.count() == 199
