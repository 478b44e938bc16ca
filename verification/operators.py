"""Single operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.functions import cleaning, flares, predicates, times
from obsflow.operators import grid, intervals, latest, tags, trends
from obsflow.operators.paging import Page, page_of
from obsflow.schemas import FLARE_RECORD
from obsflow.sources import feeds, reports
from verification import query
from verification.inputs import pick, plain, rounded, table

# ---------------------------------------------------------------- cleaning

_BLANKED = """CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 5 = 1 THEN '   '
  WHEN o_orderkey % 5 = 2 THEN ' ' || o_orderpriority || ' ' ELSE o_orderpriority END"""


@query(
    "blank_to_null",
    f"""SELECT o_orderkey, CASE WHEN trim(t, ' ') = '' THEN NULL ELSE t END AS cleaned
    FROM (SELECT o_orderkey, {_BLANKED} AS t FROM orders)""",
)
def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1."""
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", cleaning.blank_to_null(F.expr(_BLANKED)).alias("cleaned"))


_NUMBER_TEXT = """CASE l_linenumber % 6 WHEN 0 THEN ' ' || CAST(l_extendedprice AS STRING) || ' '
  WHEN 1 THEN '-' || CAST(l_quantity AS STRING) WHEN 2 THEN l_returnflag
  WHEN 3 THEN CAST(l_partkey AS STRING) || 'e2' WHEN 4 THEN '' ELSE CAST(l_discount AS STRING) END"""


@query(
    "tolerant_numeric",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {rounded('v', 4)} AS as_double,
      CAST(trunc(v) AS INT) AS as_int
    FROM (SELECT *, TRY_CAST(trim({_NUMBER_TEXT}) AS DOUBLE) AS v FROM lineitem)""",
)
def tolerant_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2, P3."""
    text = F.expr(_NUMBER_TEXT)
    return plain(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            cleaning.to_double(text).alias("as_double"), cleaning.to_int(text).alias("as_int"),
        )
    )


_MJD_TEXT = "CASE WHEN event_id % 11 = 0 THEN '' ELSE CAST(5.8849e4 + event_id / 1e3 AS STRING) END"


@query(
    "mjd_timestamp",
    f"""SELECT event_id, make_timestamp(CAST(trunc((TRY_CAST({_MJD_TEXT} AS DOUBLE) - 4.0587e4) * 8.64e4)
      AS BIGINT) * 1000000) AS at FROM events""",
)
def mjd_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4."""
    events = table(spark, sf_dir, "events")
    return plain(events.select("event_id", cleaning.mjd_to_timestamp(F.expr(_MJD_TEXT)).alias("at")))


_LIST_TEXT = "CASE WHEN p_partkey % 9 = 0 THEN '  ' ELSE replace(p_name, ' ', ';') || ';;' || p_type END"


@query(
    "split_explode",
    f"""SELECT piece, count(*) AS n FROM (
      SELECT unnest(string_split(CASE WHEN trim(t, ' ') = '' THEN NULL ELSE t END, ';')) AS piece
      FROM (SELECT {_LIST_TEXT} AS t FROM part)) GROUP BY piece""",
)
def split_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5, G1, A1."""
    parts = table(spark, sf_dir, "part").select(cleaning.split_list(F.expr(_LIST_TEXT)).alias("pieces"))
    return tags.count_by(tags.explode_tags(parts, "pieces", "piece", keep=[]), ["piece"], "n")


_WORDS = (("small", "size"), ("large", "size"), ("red", "colour"), ("blue", "colour"))


@query(
    "split_explode_dim",
    f"""SELECT p_brand, word, kind, count(*) AS n
    FROM (SELECT p_brand, unnest(string_split(p_name, ' ')) AS word FROM part WHERE p_brand <> '') AS w
    JOIN (VALUES {", ".join(map(str, _WORDS))}) AS d(word, kind) USING (word) GROUP BY ALL""",
)
def split_explode_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5, P12, G1, S9, J2, A1."""
    parts = table(spark, sf_dir, "part").filter(predicates.non_empty(F.col("p_brand")))
    words = parts.select("p_brand", cleaning.split_list(F.col("p_name"), " ").alias("words"))
    kinds = tags.reference_table(spark, _WORDS, ("word", "kind"))
    exploded = tags.explode_tags(words, "words", "word", keep=["p_brand"])
    return tags.count_by(
        tags.with_reference(exploded, kinds, "word"), ["p_brand", "word", "kind"], "n"
    )


@query(
    "relabel",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN 'fault' ELSE 'usage' END AS source FROM events",
)
def relabel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P15."""
    label = cleaning.relabel(F.col("event_type"), {"error": "fault"}, "usage")
    return table(spark, sf_dir, "events").select("event_id", label.alias("source"))


# ---------------------------------------------------------------- filters


@query(
    "upper_membership",
    """SELECT o_orderkey, o_orderpriority FROM orders
    WHERE upper(o_orderpriority) IN ('1-URGENT', '5-LOW') AND o_totalprice > 0""",
)
def upper_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9, P11."""
    mixed = F.when(F.expr("o_orderkey % 2 = 0"), F.lower("o_orderpriority")).otherwise(
        F.col("o_orderpriority")
    )
    kept = table(spark, sf_dir, "orders").filter(
        predicates.one_of_upper(mixed, ["1-URGENT", "5-LOW"]) & predicates.positive(F.col("o_totalprice"))
    )
    return kept.select("o_orderkey", "o_orderpriority")


@query("isin_filter", "SELECT event_id, event_type FROM events WHERE event_type IN ('view', 'signup')")
def isin_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8."""
    events = table(spark, sf_dir, "events")
    kept = events.filter(predicates.one_of(F.col("event_type"), ["view", "signup"]))
    return kept.select("event_id", "event_type")


@query(
    "range_filter",
    """SELECT event_id, ts FROM events
    WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20'""",
)
def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P14."""
    events = table(spark, sf_dir, "events")
    kept = events.filter(predicates.in_range(F.col("ts"), "2024-01-05", "2024-01-20", "timestamp"))
    return plain(kept.select("event_id", "ts"))


@query(
    "range_filter_open",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-25'",
)
def range_filter_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P14 with an empty upper bound."""
    events = table(spark, sf_dir, "events")
    kept = events.filter(predicates.in_range(F.col("ts"), "2024-01-25", "", "timestamp"))
    return plain(kept.select("event_id", "ts"))


@query(
    "plausible_range",
    """SELECT o_orderkey, happened FROM (
      SELECT o_orderkey, o_orderdate + to_days(CAST(o_custkey * 17 AS INT)) AS happened FROM orders)
    WHERE happened BETWEEN TIMESTAMP '1990-01-01' AND TIMESTAMP '2030-12-31'""",
)
def plausible_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10."""
    happened = F.col("o_orderdate") + F.expr("make_dt_interval(int(o_custkey * 17))")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", happened.alias("happened"))
    return plain(orders.filter(predicates.plausible(F.col("happened"))))


@query(
    "mandatory_keys",
    """SELECT count(*) AS n FROM (SELECT CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS a,
      CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END AS b FROM events) WHERE a IS NOT NULL AND b IS NOT NULL""",
)
def mandatory_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7, P13, A4."""
    events = table(spark, sf_dir, "events").select(
        F.expr("CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS a"),
        F.expr("CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END AS b"),
    )
    return events.filter(predicates.all_present("a", "b")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- events

_ISO = """CASE event_id % 4 WHEN 0 THEN iso || 'Z' WHEN 1 THEN iso WHEN 2 THEN 'at ' || iso ELSE '' END"""


@query(
    "iso_time",
    """SELECT event_id, CASE WHEN event_id % 4 < 2 THEN date_trunc('second', ts) END AS at FROM events""",
)
def iso_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso")
    texts = table(spark, sf_dir, "events").select("event_id", iso).withColumn("t", F.expr(_ISO))
    return plain(texts.select("event_id", times.parse_iso(F.col("t")).alias("at")))


@query(
    "json_subset",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) + INTERVAL 1 DAY ELSE ts END AS start,
      CASE event_id % 3 WHEN 2 THEN NULL ELSE 'C' || (CAST(json_extract_string(props, '$.k') AS INT) % 10) || '.0' END
        AS xray_class
    FROM events""",
)
def json_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record without a begin, and text that is not JSON."""
    k = F.get_json_object("props", "$.k").cast("int")
    later = F.date_format(F.col("ts") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss")
    record = flares.record_json(
        F.when(F.expr("event_id % 3 = 0"), later).alias("begin_time"),
        F.concat(F.lit("C"), (k % 10).cast("string"), F.lit(".0")).alias("xray_class"),
        k.alias("unknown"),
    )
    text = F.when(F.expr("event_id % 3 = 2"), F.lit("{broken")).otherwise(record)
    parsed = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.from_json(text, FLARE_RECORD).alias("rec")
    )
    start = times.event_start(F.col("rec.begin_time"), F.col("ts"))
    return plain(parsed.select("event_id", start.alias("start"), "rec.xray_class"))


@query(
    "record_json",
    """SELECT event_id, '{"kind":"' || event_type || '","props":"' || replace(props, '"', '\\"')
      || '","user":' || user_id || ',"none":null}' AS record FROM events""",
)
def record_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X8."""
    record = flares.record_json(
        F.col("event_type").alias("kind"), F.col("props"), F.col("user_id").alias("user"),
        F.lit(None).cast("string").alias("none"),
    )
    return table(spark, sf_dir, "events").select("event_id", record.alias("record"))


_HHMM = "lpad(CAST(event_id * 37 % 2600 AS STRING), 4, '0')"


@query(
    "hhmm_rollover",
    f"""SELECT event_id, CASE WHEN h > 23 OR m > 59 THEN NULL
        WHEN date_trunc('day', ts) + to_hours(h) + to_minutes(m) < ts
          THEN date_trunc('day', ts) + to_hours(h) + to_minutes(m) + INTERVAL 1 DAY
        ELSE date_trunc('day', ts) + to_hours(h) + to_minutes(m) END AS at
    FROM (SELECT *, CAST(substr({_HHMM}, 1, 2) AS INT) AS h, CAST(substr({_HHMM}, 3, 2) AS INT) AS m FROM events)""",
)
def hhmm_rollover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4."""
    events = table(spark, sf_dir, "events")
    return plain(events.select("event_id", times.clock_after(F.expr(_HHMM), F.col("ts")).alias("at")))


_CLASS_TEXT = f"""CASE WHEN event_id % 13 = 0 THEN 'N/A' ELSE {pick("event_id % 6", "ABCMXZ")}
  || CAST(user_id % 30 AS STRING) || CASE WHEN event_id % 2 = 0 THEN '.' || CAST(event_id % 10 AS STRING) ELSE '' END END"""
_CLASS_REGEX = r"'^([ABCMX])(\d+(?:\.\d+)?)'"


@query(
    "class_split",
    f"""SELECT event_id, regexp_extract(c, {_CLASS_REGEX}, 1) AS letter,
      TRY_CAST(regexp_extract(c, {_CLASS_REGEX}, 2) AS DOUBLE) AS magnitude
    FROM (SELECT event_id, {_CLASS_TEXT} AS c FROM events)""",
)
def class_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5."""
    classes = table(spark, sf_dir, "events").select("event_id", F.expr(_CLASS_TEXT).alias("c"))
    return classes.select(
        "event_id", flares.class_letter(F.col("c")).alias("letter"),
        flares.class_magnitude(F.col("c")).alias("magnitude"),
    )


@query(
    "severity_score",
    f"""SELECT event_id, CAST(trunc(CASE letter WHEN 'A' THEN 0 WHEN 'B' THEN 20 WHEN 'C' THEN 40
      WHEN 'M' THEN 60 WHEN 'X' THEN 80 ELSE 0 END + coalesce(magnitude, 0)) AS INT) AS risk_score
    FROM (SELECT event_id, regexp_extract(c, {_CLASS_REGEX}, 1) AS letter,
        TRY_CAST(regexp_extract(c, {_CLASS_REGEX}, 2) AS DOUBLE) AS magnitude
      FROM (SELECT event_id, {_CLASS_TEXT} AS c FROM events))""",
)
def severity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7."""
    split = class_split(spark, sf_dir)
    score = flares.severity(F.col("letter"), F.col("magnitude"))
    return split.select("event_id", score.alias("risk_score"))


# Report lines over events: some with a bad head, year, time or class.
_LINE = f"""CASE event_id % 17 WHEN 0 THEN '# comment' WHEN 1 THEN '' ELSE
  CASE WHEN event_id % 19 = 0 THEN '3177x' ELSE '31777' END || ymd || '  ' || hhmm || ' '
  || CASE WHEN event_id % 7 = 0 THEN '////' ELSE lpad(CAST(user_id * 11 % 2400 AS STRING), 4, '0') END || ' '
  || hhmm || CASE WHEN event_id % 3 = 0 THEN '  N08W23' ELSE '        ' END
  || ' ' || {pick("event_id % 6", "ABCMXZ")} || ' ' || CAST(user_id * 9 % 1100 AS STRING) || '    GOES 1.0E-03' END"""
_KEPT = "event_id % 17 > 1"


@query(
    "report_line_parse",
    f"""SELECT event_id, date_trunc('minute', ts) AS event_time,
      strftime(ts, '%Y-%m-%dT%H:%M:00+00:00') AS begin_time,
      CASE WHEN event_id % 7 > 0 THEN lpad(CAST(user_id * 11 % 2400 AS STRING), 4, '0') END AS end_time,
      strftime(ts, '%H%M') AS max_time,
      {pick("event_id % 6", "ABCMXZ")} || (user_id * 9 % 1100 // 10) || '.' || (user_id * 9 % 1100 % 10) AS xray_class
    FROM events WHERE {_KEPT} AND event_id % 19 > 0 AND event_id % 6 < 5 AND user_id * 9 % 1100 < 1000""",
)
def report_line_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every data line, rejected ones left out."""
    parsed = reports.parse_reports(report_lines(spark, sf_dir), keep=["event_id"])
    fields = [f"fields.{n}" for n in ("event_time", "begin_time", "end_time", "max_time", "xray_class")]
    return plain(parsed.filter("fields is not null").select("event_id", *fields))


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.year("ts").alias("year"),
        F.date_format("ts", "yyMMdd").alias("ymd"), F.date_format("ts", "HHmm").alias("hhmm"),
    )
    return events.select("event_id", "year", F.expr(_LINE).alias("line"))


@query(
    "report_counts",
    f"""SELECT CAST(year(ts) AS INT) AS year,
      count(*) FILTER (event_id % 19 > 0 AND event_id % 6 < 5 AND user_id * 9 % 1100 < 1000) AS parsed,
      count(*) FILTER (NOT (event_id % 19 > 0 AND event_id % 6 < 5 AND user_id * 9 % 1100 < 1000)) AS skipped
    FROM events WHERE {_KEPT} GROUP BY ALL""",
)
def report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed and skipped lines per year."""
    return reports.report_counts(reports.parse_reports(report_lines(spark, sf_dir)))


@query(
    "payload_explode",
    """SELECT CASE WHEN event_id % 2 = 0 THEN 'kp_index' ELSE 'solar_flares' END AS endpoint,
      date_trunc('second', ts) + to_days(n) AS event_time, event_id, n, TIMESTAMP '2024-06-01' AS ingested_at
    FROM events, (VALUES (0), (1)) AS copies(n) WHERE event_id % 10 <> 3""",
)
def payload_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload per event with two good elements and three without a time."""
    at = F.lit("2024-06-01").cast("timestamp")
    events = feeds.payload_events(_payloads(spark, sf_dir), at)
    number = {n: F.get_json_object("record", f"$.{n}").cast("bigint") for n in ("event_id", "n")}
    return plain(
        events.select(
            "endpoint", "event_time", number["event_id"].alias("event_id"),
            number["n"].cast("int").alias("n"), "ingested_at",
        )
    )


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    def element(n: int) -> F.Column:
        shifted = F.col("ts") + F.expr(f"INTERVAL {n} DAY")
        iso = F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        named = F.create_map(
            F.expr("CASE WHEN event_id % 2 = 0 THEN 'time_tag' ELSE 'begin_time' END"), iso,
            F.lit("event_id"), F.col("event_id").cast("string"), F.lit("n"), F.lit(str(n)),
        )
        return F.to_json(named)

    parts = [element(0), element(1), F.lit("{}"), F.lit('{"time_tag":"x","begin_time":""}'), F.lit("7")]
    array = F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))
    return table(spark, sf_dir, "events").select(
        F.expr("CASE WHEN event_id % 2 = 0 THEN 'kp_index' ELSE 'solar_flares' END AS endpoint"),
        F.when(F.expr("event_id % 10 = 3"), F.lit("<html>")).otherwise(array).alias("value"),
    )


# ---------------------------------------------------------------- joins and keys

_SPANS = """views AS (SELECT event_id AS view_id, ts AS view_start,
    ts + to_microseconds(CAST(round(value * 60 * 1000000) AS BIGINT)) AS view_end
  FROM events WHERE event_type = 'view'),
errors AS (SELECT event_id AS error_id, ts AS error_start, ts + INTERVAL 1 HOUR AS error_end, value AS weight
  FROM events WHERE event_type = 'error')"""


def spans(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Views lasting ``value`` minutes, and errors lasting an hour."""
    events = table(spark, sf_dir, "events")
    length = F.round(F.col("value") * 60 * 1_000_000).cast("bigint")
    views = events.filter("event_type = 'view'").select(
        F.col("event_id").alias("view_id"), F.col("ts").alias("view_start"),
        F.timestamp_micros(F.unix_micros("ts") + length).alias("view_end"),
    )
    errors = events.filter("event_type = 'error'").select(
        F.col("event_id").alias("error_id"), F.col("ts").alias("error_start"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("error_end"), F.col("value").alias("weight"),
    )
    return views, errors


VIEW_SPAN, ERROR_SPAN = ("view_start", "view_end"), ("error_start", "error_end")


@query(
    "interval_join",
    f"""WITH {_SPANS} SELECT view_id, error_id FROM views JOIN errors
    ON error_start <= view_end AND error_end >= view_start""",
)
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1."""
    pairs = intervals.interval_join(*spans(spark, sf_dir), VIEW_SPAN, ERROR_SPAN)
    return pairs.select("view_id", "error_id")


@query(
    "interval_join_best",
    f"""WITH {_SPANS} SELECT view_id, view_start, view_end, error_id, weight
    FROM views JOIN errors ON error_start <= view_end AND error_end >= view_start
    QUALIFY row_number() OVER (PARTITION BY view_id ORDER BY weight DESC, error_id) = 1""",
)
def interval_join_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + W2."""
    best = intervals.best_overlap(
        *spans(spark, sf_dir), VIEW_SPAN, ERROR_SPAN, keys=["view_id"],
        order=[F.col("weight").desc(), F.col("error_id")],
    )
    return plain(best.select("view_id", "view_start", "view_end", "error_id", "weight"))


def event_slices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two overlapping slices of events; columns in another order in the second."""
    events = table(spark, sf_dir, "events")
    columns = ["event_type", "user_id", "ts", "event_id", "value"]
    old = events.filter("ts < TIMESTAMP '2024-01-20'").select(*columns)
    return old, events.filter("ts >= TIMESTAMP '2024-01-10'").select(*reversed(columns))


_SLICES = """slices AS (SELECT event_type, user_id, ts, event_id, value FROM events WHERE ts < TIMESTAMP '2024-01-20'
  UNION ALL SELECT event_type, user_id, ts, event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-10')"""


@query("union_by_name", f"WITH {_SLICES} SELECT * FROM slices")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1."""
    old, new = event_slices(spark, sf_dir)
    return plain(old.unionByName(new))


LATEST_SQL = f"""WITH {_SLICES} SELECT * FROM slices
    QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1"""


@query("keep_latest", LATEST_SQL)
def keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1, W1."""
    keys = ["event_type", "user_id"]
    return plain(latest.merge_latest(*event_slices(spark, sf_dir), keys, "ts", ["event_id"]))


@query("keep_latest_agg", LATEST_SQL)
def keep_latest_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 as an aggregate."""
    old, new = event_slices(spark, sf_dir)
    keys = ["event_type", "user_id"]
    return plain(latest.latest_per_key_agg(old.unionByName(new), keys, "ts", ["event_id"]))


@query(
    "best_per_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) = 1""",
)
def best_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2."""
    order = [F.col("l_extendedprice").desc(), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return plain(latest.best_per_key(lines, ["l_orderkey"], order).drop("l_suppkey"))


# ---------------------------------------------------------------- aggregates

_GRID = """cells AS (SELECT floor(c_acctbal / 100) * 100 AS x_bin, floor(c_nationkey / 1e2) * 100 AS y_bin,
    count(*) AS n, sum(c_acctbal) AS total FROM customer GROUP BY ALL)"""


@query("grid_aggregate", f"WITH {_GRID} SELECT x_bin, y_bin, n, {rounded('total', 2)} AS total FROM cells")
def grid_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 with another cell size, and negative coordinates."""
    customers = table(spark, sf_dir, "customer")
    cells = grid.grid_aggregate(
        customers, "c_acctbal", "c_nationkey", "c_acctbal", 100.0, ("x_bin", "y_bin", "n", "total")
    )
    return plain(cells, digits=2)


@query(
    "monthly_mean",
    f"""SELECT l_returnflag, CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR) AS year_month,
      {rounded('avg(l_quantity)', 4)} AS mean_qty FROM lineitem GROUP BY ALL""",
)
def monthly_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3."""
    lines = table(spark, sf_dir, "lineitem")
    return plain(trends.monthly_mean(lines, "l_returnflag", "l_shipdate", "l_quantity", "mean_qty"))


# Parts are not shipped every month, so rows and calendar differ.
_GAPS = """monthly AS (SELECT l_partkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS m,
    avg(l_quantity) AS mean_qty FROM lineitem
  GROUP BY ALL)"""


def _monthly_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return trends.monthly_mean(lines, "l_partkey", "l_shipdate", "l_quantity", "mean_qty")


@query(
    "monthly_lag",
    f"""WITH {_GAPS} SELECT l_partkey, CAST(m AS VARCHAR) AS year_month, {rounded('mean_qty', 4)} AS mean_qty,
      {rounded('mean_qty - lag(mean_qty, 12) OVER (PARTITION BY l_partkey ORDER BY m)', 4)} AS trend FROM monthly""",
)
def monthly_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve rows back."""
    monthly = _monthly_with_gaps(spark, sf_dir)
    return plain(
        trends.lag_difference(monthly, "l_partkey", ["year_month"], "mean_qty", 12, "trend")
    )


@query(
    "monthly_lag_calendar",
    f"""WITH {_GAPS} SELECT a.l_partkey, CAST(a.m AS VARCHAR) AS year_month, {rounded('a.mean_qty', 4)} AS mean_qty,
      {rounded('a.mean_qty - b.mean_qty', 4)} AS trend
    FROM monthly a LEFT JOIN monthly b ON a.l_partkey = b.l_partkey AND b.m = a.m - INTERVAL 12 MONTH""",
)
def monthly_lag_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 by the calendar: twelve months back."""
    monthly = _monthly_with_gaps(spark, sf_dir)
    return plain(
        trends.calendar_difference(monthly, "l_partkey", "year_month", "mean_qty", 12, "trend")
    )


@query("page_events", "SELECT event_id, ts, value FROM events ORDER BY value DESC, event_id LIMIT 100 OFFSET 40")
def page_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: a bad limit falls back to the default."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    page = Page.of("many", "40")
    return plain(page_of(events, [F.col("value").desc(), F.col("event_id")], page))


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4."""
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))
