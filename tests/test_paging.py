"""O1-O5 and K6."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from obsflow.operators import paging
from obsflow.operators.paging import Page, gold_json_page, gold_page, json_page, json_rows
from tests.conftest import rows


@pytest.mark.parametrize(
    "limit,offset,expected",
    [
        (None, None, (100, 0)), ("0", "0", (1, 0)), ("99999", "5", (10000, 5)),
        ("abc", "abc", (100, 0)), ("50", "-3", (50, 0)), (20, 7, (20, 7)), ("", "", (100, 0)),
        ("-5", "2", (1, 2)), ("1.5", "1.5", (100, 0)),
    ],
)
def test_o1_page(limit, offset, expected):
    page = Page.of(limit, offset)
    assert (page.limit, page.offset) == expected


@pytest.fixture(scope="module")
def contaminated(spark):
    data = [(f"o{i}", datetime(2015, 1, 1 + i // 2), datetime(2015, 1, 2), "M1.0", 61) for i in range(8)]
    return spark.createDataFrame(
        data, "obs_id string, t_start timestamp, t_end timestamp, flare_class string, risk_score int"
    )


def test_o2_contaminated(contaminated):
    ids = [r[0] for r in rows(gold_page(contaminated, "contaminated_obs", Page(3, 1)))]
    assert ids == ["o1", "o2", "o3"]
    part = gold_page(contaminated, "contaminated_obs", Page(9, 0), "2015-01-02", "2015-01-03")
    assert [r[0] for r in rows(part)] == ["o2", "o3", "o4", "o5"]
    plan = gold_page(contaminated, "contaminated_obs", Page(3, 1))._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan


def test_o3_o5_most_first(spark):
    bands = spark.createDataFrame(
        [("b", "f", "l", 2), ("a", "f", "l", 2), ("c", "f", "l", 9)],
        "target_name string, filter string, emission_line string, nb_obs long",
    )
    assert [r[0] for r in rows(gold_page(bands, "narrow_band_targets", Page(2, 0)))] == ["c", "a"]
    sky = spark.createDataFrame(
        [(2.0, 0.0, 1, 0.0), (1.0, 0.0, 1, 0.0), (1.0, -1.0, 1, 0.0)],
        "ra_bin double, dec_bin double, nb_obs long, total_exptime double",
    )
    assert [r[:2] for r in rows(gold_page(sky, "sky_coverage", Page(2, 0)))] == [(1.0, -1.0), (1.0, 0.0)]


def test_o4_missing_instrument_last(spark):
    data = [(None, date(2010, 1, 1), 1.0, None), ("b", date(2010, 2, 1), 1.0, None),
            ("b", date(2010, 1, 1), 1.0, None), ("a", date(2020, 12, 31), 1.0, None)]
    df = spark.createDataFrame(data, "instrument string, year_month date, avg_calib_time double, trend_12m double")
    got = rows(gold_page(df, "instrument_calibration", Page(10, 0), "2010-01-01", "2020-12-31"))
    assert [(r[0], r[1].isoformat()) for r in got] == [
        ("a", "2020-12-31"), ("b", "2010-01-01"), ("b", "2010-02-01"), (None, "2010-01-01"),
    ]


def test_k6_rows(spark):
    df = spark.createDataFrame(
        [(datetime(2015, 1, 1, 2, 3, 4), datetime(2015, 1, 1, 0, 0, 0, 50), date(2015, 1, 1),
          Decimal("1.50"), None, 'a"b')],
        "t timestamp, u timestamp, d date, m decimal(5,2), n int, s string",
    )
    text = json_rows(df).first()["row"]
    assert json.loads(text) == {
        "t": "2015-01-01T02:03:04", "u": "2015-01-01T00:00:00.000050", "d": "2015-01-01", "m": 1.5, "n": None, "s": 'a"b',
    }


def test_k6_page(contaminated):
    page = json.loads(gold_json_page(contaminated, "contaminated_obs", Page(3, 4)).first()["page"])
    assert {k: page[k] for k in ("count", "limit", "offset")} == {"count": 3, "limit": 3, "offset": 4}
    assert [r["obs_id"] for r in page["rows"]] == ["o4", "o5", "o6"]
    past = json.loads(json_page(contaminated, [F.col("obs_id")], Page(3, 40)).first()["page"])
    assert past == {"count": 0, "limit": 3, "offset": 40, "rows": []}


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("nulls_last", [False, True])
def test_o2_pages_by_key_are_the_pages_by_offset(spark, descending, nulls_last):
    values = [(v, w) for v in (None, 3, 1, 2, 3) for w in ("b", None, "a")]
    made = [(v, w, i) for i, (v, w) in enumerate(values)]
    df = spark.createDataFrame(made, "v int, w string, i int")
    keys = [paging.Key("v", descending, nulls_last), paging.Key("w", not descending, nulls_last), paging.Key("i")]
    want = [tuple(r) for r in df.orderBy(*(k.order() for k in keys)).collect()]
    got, last = [], None
    while page := paging.page_after(df, keys, last, 4).collect():
        got, last = got + [tuple(r) for r in page], page[-1].asDict()
    assert got == want
