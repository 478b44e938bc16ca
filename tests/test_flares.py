"""Report lines, feeds and flare expressions."""

import json

from pyspark.sql import functions as F

from obsflow.functions import flares, times
from obsflow.plans import silver
from obsflow.sources import feeds, reports
from tests.conftest import rows
from tests.test_cleaning import apply

def at():
    return F.lit("2024-05-01 00:00:00").cast("timestamp")



def parse(spark, lines, year=2015):
    df = spark.createDataFrame([(i, year, l) for i, l in enumerate(lines)], "i int, year int, line string")
    parsed = df.withColumn("f", flares.report_fields(flares.strip_line(F.col("line")), F.col("year")))
    return rows(parsed.select("i", "f.begin_time", "f.end_time", "f.max_time", "f.xray_class"), "i")


GOOD = "31777150101  0936 0945 0941 N08W23 C 19    GOES 1.2E-03 2253"


LINES = [
        (GOOD, ("2015-01-01T09:36:00+00:00", "0945", "0941", "C1.9")),
        ("  " + GOOD + "\t", ("2015-01-01T09:36:00+00:00", "0945", "0941", "C1.9")),
        ("31777150101  2350 0010 2358        X 280   GOES 9.9E-01",
         ("2015-01-01T23:50:00+00:00", "0010", "2358", "X28.0")),
        ("31777150102  0100 //// 0104        M 5     GOES 1.0E-03",
         ("2015-01-02T01:00:00+00:00", None, "0104", "M0.5")),
        # A letter without a number behind it is passed over.
        ("31777150102  0100 0101 0104  C M 5     GOES",
         ("2015-01-02T01:00:00+00:00", "0101", "0104", "M0.5")),
        ("31777150102  0100 0101 0104  B C 10 X 20", 
         ("2015-01-02T01:00:00+00:00", "0101", "0104", "C1.0")),
        ("31777150102  0100 0101 0104  AB C 1000 B 7 9",
         ("2015-01-02T01:00:00+00:00", "0101", "0104", "B0.7")),
        # The end of the class search: the number may be the last token.
        ("31777150102  0100 0101 0104  B 12", ("2015-01-02T01:00:00+00:00", "0101", "0104", "B1.2")),
        # Rejected: short, no digits in front, other year, no such time, no such day.
        ("31777150101 0936 0945 0941", None),
        ("3177715010x  0936 0945 0941 C 19  GOES", None),
        ("31777140101  0936 0945 0941 C 19  GOES", None),
        ("31777150101  2400 0945 0941 C 19  GOES", None),
        ("31777150230  0936 0945 0941 C 19  GOES", None),
        ("31777150101  0936U 0945 0941 C 19 GOES", None),
        ("31777150101  0936 0945 0941 C 1900 GOES", None),
        ("31777150101  0936 0945 0941 N08W23 GOES", None),
        ("31777150101  0936 0945 0941 N08W23 GOES C", None),
        # Fewer than five tokens.
        ("31777150101      0936 0945     0941 C", None),
        # The class letter is looked for behind the three times only.
        ("31777150101  0936 C 19 0941 GOES 1.0", None),
]


def test_x1_report_line(spark):
    got = parse(spark, [line for line, _ in LINES])
    for (line, expected), found in zip(LINES, got):
        assert found[1:] == (expected or (None, None, None, None)), line


def test_x1_two_digit_year(spark):
    line = "31777{}0101  0936 0945 0941 N08W23 C 19    GOES"
    assert parse(spark, [line.format(69)], 2069)[0][1] is not None
    assert parse(spark, [line.format(70)], 1970)[0][1] is not None
    assert parse(spark, [line.format(70)], 2070)[0][1] is None


def test_s7_report_files(spark, tmp_path):
    folder = tmp_path / "reports"
    folder.mkdir()
    (folder / "xrs-report_2015.txt").write_text(f"# c\n:Header\n\n{GOOD}\nnot a data line\n  # c\n")
    (folder / "xrs-report_2016.txt").write_text(GOOD.replace("77715", "77716") + "\n")
    (folder / "xrs-report_2018.txt").write_text(GOOD.replace("77715", "77718") + "\n")
    lines = reports.read_reports(spark, str(folder), 2010, 2017)
    parsed = reports.parse_reports(lines)
    assert rows(reports.report_counts(parsed), "year") == [(2015, 1, 1), (2016, 1, 0)]
    events = reports.report_events(parsed, at()).orderBy("event_time").collect()
    assert [e["endpoint"] for e in events] == ["solar_flares_archive"] * 2
    record = json.loads(events[0]["record"])
    assert record == {
        "begin_time": "2015-01-01T09:36:00+00:00", "end_time": "0945", "max_time": "0941",
        "xray_class": "C1.9", "raw_line": GOOD,
    }


def test_x8_nulls_stay_in_the_record(spark, tmp_path):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    got = df.select(flares.record_json(F.col("x"), F.col("y"))).first()[0]
    assert json.loads(got) == {"x": "a", "y": None}


def test_s6_payload_events(spark):
    payloads = [
        ("solar_flares", json.dumps([
            {"begin_time": "2024-05-01T10:00:00Z", "max_class": "M1.0", "nested": {"a": [1, 2]}},
            {"begin_time": None}, {"begin_time": "soon"}, {"other": 1}, 7,
        ])),
        ("kp_index", json.dumps([{"time_tag": "2024-05-01T10:00:00", "kp": 3}])),
        ("xray_flux", "<html>error</html>"),
        ("solar_wind", "[]"),
        ("unknown", json.dumps([{"time_tag": "2024-05-01T10:00:00"}])),
    ]
    df = spark.createDataFrame(payloads, "endpoint string, value string")
    events = feeds.payload_events(df, at()).orderBy("endpoint").collect()
    assert [e["endpoint"] for e in events] == ["kp_index", "solar_flares"]
    assert json.loads(events[0]["record"]) == {"time_tag": "2024-05-01T10:00:00", "kp": 3}
    assert json.loads(events[1]["record"])["nested"] == {"a": [1, 2]}


def test_s6_landing_folder_names_the_feed(spark, tmp_path):
    for feed, value in (("kp_index", 1), ("solar_wind", 2)):
        (tmp_path / feed).mkdir()
        body = json.dumps([{"time_tag": "2024-05-01T10:00:00", "v": value}], indent=2)
        (tmp_path / feed / "0001.json").write_text(body)
    events = feeds.payload_events(feeds.read_payloads(spark, str(tmp_path)), at())
    got = {e["endpoint"]: json.loads(e["record"])["v"] for e in events.collect()}
    assert got == {"kp_index": 1, "solar_wind": 2}


def test_x6_iso(spark):
    values = ["2024-05-01T10:00:00Z", "2024-05-01T10:00:00", "2024-05-01", "2024", "x", "", None]
    got = apply(spark, lambda c: times.parse_iso(c).cast("string"), values)
    assert got == ["2024-05-01 10:00:00", "2024-05-01 10:00:00", "2024-05-01 00:00:00", None, None, None, None]


CLOCKS = [
        ("0945", "2015-01-01 09:45:00"),
        ("0936", "2015-01-01 09:36:00"),
        ("0010", "2015-01-02 00:10:00"),
        ("2460", None),
        ("2400", None),
        ("1260", None),
        ("2015-01-03T00:00:00Z", "2015-01-03 00:00:00"),
        ("////", None),
        ("", None),
        (None, None),
        ("123", None),
        ("01234", None),
]


def test_x4_clock(spark):
    start = F.lit("2015-01-01 09:36:00").cast("timestamp")
    texts = [text for text, _ in CLOCKS]
    got = apply(spark, lambda c: times.clock_after(c, start).cast("string"), texts)
    assert got == [expected for _, expected in CLOCKS]


def test_x5_x7_class_and_score(spark):
    values = ["M5", "X28.0", "C9.9", "N/A", "A1.0", "B2.5", "m5", "X", "M5.", "X99999999999"]
    got = apply(
        spark,
        lambda c: F.struct(
            flares.class_letter(c), flares.class_magnitude(c),
            flares.severity(flares.class_letter(c), flares.class_magnitude(c)),
        ),
        values,
    )
    assert [tuple(g) for g in got] == [
        ("M", 5.0, 65), ("X", 28.0, 108), ("C", 9.9, 49), ("", None, 0), ("A", 1.0, 1),
        ("B", 2.5, 22), ("", None, 0), ("", None, 0), ("M", 5.0, 65), ("X", 99999999999.0, 2147483647),
    ]


def envelope(spark, records):
    """(endpoint, event_time, record, ingested_at) with times as text."""
    df = spark.createDataFrame(records, "endpoint string, t string, record string, i string")
    return df.select(
        "endpoint", F.col("t").cast("timestamp").alias("event_time"), "record",
        F.col("i").cast("timestamp").alias("ingested_at"),
    )


def test_b5_silver_flares(spark):
    flare = '{"begin_time":"%s","end_time":"0010","max_time":null,"xray_class":"%s"}'
    events = envelope(spark, [
        ("solar_flares_archive", "2015-01-01 23:50:00", flare % ("2015-01-01T23:50:00+00:00", "M1.0"), "2024-01-01"),
        ("solar_flares", "2015-01-01 23:50:00", flare % ("2015-01-01T23:50:00Z", "M1.0"), "2024-01-02"),
        ("solar_flares", "2015-02-01 00:00:00", '{"xray_class":"C1.0"}', "2024-01-02"),
        ("solar_flares", "2015-02-01 00:00:00", "not json", "2024-01-02"),
        ("solar_flares", "1989-02-01 00:00:00", '{"xray_class":"C1.0"}', "2024-01-02"),
        ("kp_index", "2015-02-01 00:00:00", '{"xray_class":"C1.0"}', "2024-01-02"),
    ])
    got = rows(silver.flares(events).select(
        "source", F.col("event_start").cast("string"), F.col("event_end").cast("string"),
        "event_max", "xray_class", "xray_class_letter", "xray_class_magnitude"), "event_start")
    assert got == [
        ("live", "2015-01-01 23:50:00", "2015-01-02 00:10:00", None, "M1.0", "M", 1.0),
        ("live", "2015-02-01 00:00:00", None, None, "C1.0", "C", 1.0),
    ]
    reasons = [r["reject_reason"] for r in silver.typed_flares(events).collect() if r["reject_reason"]]
    assert sorted(reasons) == ["implausible event_start", "missing xray_class"]


def test_b5_other_class_keys(spark):
    events = envelope(spark, [("solar_flares", "2015-02-01", '{"max_class":"C1.0"}', "2024-01-02")])
    assert silver.flares(events).count() == 0
    got = silver.flares(events, class_keys=("xray_class", "max_class")).first()
    assert got["xray_class"] == "C1.0"
