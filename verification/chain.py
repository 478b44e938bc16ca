"""The jobs end to end: exports, report files and payload files made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow import paths
from obsflow.plans import jobs
from obsflow.schemas import RAW_OBSERVATION_COLUMNS
from obsflow.session import scratch_path
from verification import query
from verification.inputs import OBSERVATIONS_SQL, RAW_SQL, pick, plain, raw_observations, table
from verification.io import _FEED
from verification.operators import _KEPT, report_lines


def _layout(spark: SparkSession) -> jobs.Layout:
    return jobs.Layout(scratch_path(spark, "lake"))


_MARKED = "CASE WHEN obs_collection = 'CR' THEN '#' || dataproduct_type ELSE dataproduct_type END"


@query(
    "load_raw",
    f"""WITH {RAW_SQL} SELECT {_MARKED} AS dataproduct_type, calib_level, count(*) AS n,
      count(*) FILTER (target_name = '') AS empty_names, count(*) FILTER (target_name IS NULL) AS no_names,
      (SELECT count(*) FROM raw) AS written, 0 AS written_again FROM raw GROUP BY ALL""",
)
def load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export of four files or more, each with a comment block, a header and ``#`` records."""
    raw = raw_observations(spark, sf_dir).withColumn("dataproduct_type", F.expr(_MARKED))
    export, layout = scratch_path(spark, "export"), _layout(spark)
    _export(raw, export, max(4, -(-raw.count() // _EXPORT_ROWS)))
    written, again = (jobs.load_raw(spark, layout, export, embedded_newlines=False) for _ in range(2))
    return (
        spark.read.parquet(layout.raw)
        .groupBy("dataproduct_type", "calib_level")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("target_name") == "").alias("empty_names"),
            F.count_if(F.col("target_name").isNull()).alias("no_names"),
        )
        .withColumns({"written": F.lit(written).cast("bigint"), "written_again": F.lit(again)})
    )


#: Rows of a file of the export, about; a task writes a few files at most.
_EXPORT_ROWS = 200_000
#: An export of up to so many files is plain text; larger ones are compressed, as archives of that size are.
_PLAIN_FILES = 16


def _export(raw: DataFrame, path: str, files: int) -> None:
    """Raw rows as about ``files`` files of an export, each with its head.

    Every task cuts its own rows into files of one length, so nothing is shuffled or sorted.
    """
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    text = F.to_csv(F.struct(*RAW_OBSERVATION_COLUMNS), kept)
    head = ["# an export", "#,with a comment", ",".join(RAW_OBSERVATION_COLUMNS)]
    rows = max(1, -(-raw.count() // files))
    # The lower 33 bits of such an id count the rows of a task.
    number = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    lines = raw.select(text.alias("value"), (number % rows == 0).alias("first"))
    headed = F.when(F.col("first"), F.array(*map(F.lit, head), "value")).otherwise(F.array("value"))
    spark, made = raw.sparkSession, scratch_path(raw.sparkSession, "export-lines")
    lines.select(F.explode(headed).alias("value")).write.option("maxRecordsPerFile", rows + len(head)).text(
        made, compression="gzip" if files > _PLAIN_FILES else "none"
    )
    for part, file in enumerate(paths.siblings(spark, made, "/part-*")):
        paths.make(spark, f"{path}/part={part}")
        paths.rename(spark, file, f"{path}/part={part}/{file.rpartition('/')[2]}")


def _backfilled(spark: SparkSession, sf_dir: str) -> jobs.Layout:
    layout = _layout(spark)
    lines = report_lines(spark, sf_dir).withColumn("part", F.col("event_id") % 3)
    folder = _reports(lines)
    jobs.backfill(spark, layout, folder, 2000, 2100, F.lit("2024-06-01").cast("timestamp"))
    return layout


def _reports(lines: DataFrame) -> str:
    """Report files of (year, part, line) whose names end in the year."""
    spark = lines.sparkSession
    made, folder = scratch_path(spark, "lines"), scratch_path(spark, "reports")
    lines.select("line", "year", "part").repartition("year", "part").write.partitionBy("year", "part").text(made)
    paths.make(spark, folder)
    for number, path in enumerate(paths.siblings(spark, made, "/year=*/part=*/part-*")):
        year = path.partition("/year=")[2][:4]
        paths.rename(spark, path, f"{folder}/report-{number}-{year}.txt")
    return folder


_PARSED = "event_id % 19 > 0 AND event_id % 6 < 5 AND user_id * 9 % 1100 < 1000"


@query(
    "backfill",
    f"""SELECT DISTINCT 'solar_flares_archive' AS endpoint, date_trunc('minute', ts) AS event_time,
      TIMESTAMP '2024-06-01' AS ingested_at FROM events WHERE {_KEPT} AND {_PARSED}""",
)
def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report files by year into bronze; lines of one minute are versions of one event."""
    events = jobs.read_events(spark, _backfilled(spark, sf_dir))
    return plain(events.select("endpoint", "event_time", "ingested_at"))


@query(
    "backfill_counts",
    f"""SELECT CAST(year(ts) AS INT) AS year, count(*) FILTER ({_PARSED}) AS parsed,
      count(*) FILTER (NOT ({_PARSED})) AS skipped, count(*) FILTER (NOT ({_PARSED})) AS rejects
    FROM events WHERE {_KEPT} GROUP BY ALL""",
)
def backfill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7, B2: the counts and the rejected lines that the backfill leaves."""
    layout = _backfilled(spark, sf_dir)
    rejects = spark.read.parquet(layout.report_rejects).groupBy("year").agg(F.count(F.lit(1)).alias("rejects"))
    counts = spark.read.parquet(layout.report_counts).select("year", "parsed", "skipped")
    return counts.join(rejects, "year", "left")


def _land(elements: DataFrame, landing: str, by: Column) -> None:
    """A payload file per feed and value of ``by``, of (endpoint, element)."""
    payloads = elements.groupBy("endpoint", by.alias("by")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("element"), ","), F.lit("]")).alias("value")
    )
    for feed in ("kp_index", "solar_flares"):
        one_per_file = payloads.filter(F.col("endpoint") == feed).select("value").write.option("maxRecordsPerFile", 1)
        one_per_file.mode("append").text(f"{landing}/{feed}")


@query(
    "ingest_live",
    f"""SELECT endpoint, event_time, event_id, note FROM (
      SELECT {_FEED} AS endpoint, date_trunc('minute', ts) AS event_time, event_id, poll,
        CASE poll WHEN 0 THEN 'z' ELSE 'a' END AS note
      FROM events, (VALUES (0), (1)) AS polls(poll) WHERE poll = 0 OR event_id % 3 = 0)
    QUALIFY row_number() OVER (PARTITION BY endpoint, event_time ORDER BY poll DESC, event_id DESC) = 1""",
)
def ingest_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two polls of payload files; the later one wins though its text sorts lower."""
    layout, landing = _layout(spark), scratch_path(spark, "landing")
    events = table(spark, sf_dir, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:00'Z'")
    padded = F.lpad(F.col("event_id").cast("string"), 20, "0")
    for note, part in (("z", events), ("a", events.filter("event_id % 3 = 0"))):
        element = F.to_json(
            F.struct(F.lit(note).alias("note"), padded.alias("event_id"), iso.alias("time_tag"), iso.alias("begin_time"))
        )
        _land(part.select(F.expr(_FEED).alias("endpoint"), element.alias("element"), "ts"), landing, F.to_date("ts"))
        jobs.ingest_landed(spark, layout, landing)
    number = F.get_json_object("record", "$.event_id").cast("bigint").alias("event_id")
    note = F.get_json_object("record", "$.note").alias("note")
    return plain(jobs.read_events(spark, layout).select("endpoint", "event_time", number, note))


@query(
    "feed_rejects",
    """SELECT 'no time' AS reject_reason, 'kp_index' AS endpoint, count(*) AS n FROM events WHERE event_id % 2 = 0
    UNION ALL SELECT 'no JSON array', 'solar_flares', count(DISTINCT CAST(ts AS DATE)) FROM events""",
)
def feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7, T5: elements without a time and payloads that are no array, taken in twice."""
    layout, landing = _layout(spark), scratch_path(spark, "landing")
    events = table(spark, sf_dir, "events")
    timeless = F.to_json(F.struct("event_id", F.lit("?").alias("time_tag")))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    timed = F.to_json(F.struct("event_id", iso.alias("time_tag")))
    element = F.when(F.col("event_id") % 2 == 0, timeless).otherwise(timed)
    _land(events.select(F.lit("kp_index").alias("endpoint"), element.alias("element"), "ts"), landing, F.to_date("ts"))
    days = events.select(F.concat(F.lit("no payload of "), F.to_date("ts").cast("string")).alias("value")).distinct()
    days.write.option("maxRecordsPerFile", 1).mode("append").text(f"{landing}/solar_flares")
    for _ in range(2):
        jobs.ingest_live(spark, layout, landing)
    refused = spark.read.parquet(layout.feed_rejects)
    return refused.groupBy("reject_reason", "endpoint").agg(F.count(F.lit(1)).alias("n"))


_CLASS = f"""CASE WHEN o_orderkey % 23 > 0 THEN {pick("o_custkey % 5", "ABCMX")}
    || CAST(o_orderkey % 30 AS STRING) || '.' || CAST(o_custkey % 10 AS STRING) END"""
_WORST = """contaminated AS (
  SELECT obs_id, t_start, t_end, flare_class, risk_score FROM obs JOIN (
    SELECT flare_start, flare_end, flare_class, CAST(trunc(CASE flare_class[1] WHEN 'A' THEN 0 WHEN 'B' THEN 20
      WHEN 'C' THEN 40 WHEN 'M' THEN 60 ELSE 80 END + CAST(flare_class[2:] AS DOUBLE)) AS INT) AS risk_score
    FROM flares) ON flare_start <= t_end AND flare_end >= t_start
  QUALIFY row_number() OVER (PARTITION BY obs_id
    ORDER BY risk_score DESC, flare_start, flare_class, t_start, t_end) = 1
)"""


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with a start on the first day of its month, so that many compete for each start."""
    half_hours = F.expr("make_dt_interval(0, int((o_orderkey % 48) div 2), int((o_orderkey % 2) * 30))")
    return table(spark, sf_dir, "orders").withColumn("begin", F.date_trunc("month", "o_orderdate") + half_hours)


@query(
    "refresh_incremental",
    f"""WITH {OBSERVATIONS_SQL}, bronze AS (
      SELECT date_trunc('month', o_orderdate) + to_minutes(CAST((o_orderkey % 48) * 30 AS INT)) AS flare_start, o_custkey % 300 AS lasts,
        o_orderkey, {_CLASS} AS flare_class FROM orders
      QUALIFY row_number() OVER (PARTITION BY flare_start ORDER BY o_custkey % 2 DESC, o_orderkey DESC) = 1
    ), flares AS (
      SELECT flare_start, flare_class, flare_start + CASE WHEN o_orderkey % 5 = 0 THEN INTERVAL 1 HOUR
        ELSE to_minutes(CAST(lasts AS INT)) END AS flare_end FROM bronze WHERE flare_class IS NOT NULL
    ), {_WORST} SELECT * FROM contaminated""",
)
def refresh_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ticks of flare payloads; the second one adds, corrects and withdraws flares."""
    layout, landing = _layout(spark), scratch_path(spark, "landing")
    jobs.refresh_observations(spark, layout, raw_observations(spark, sf_dir))
    orders = _dated_orders(spark, sf_dir)
    end = F.col("begin") + F.expr("make_dt_interval(0, 0, int(o_custkey % 300))")
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    element = F.to_json(
        F.struct(
            F.lpad(F.col("o_orderkey").cast("string"), 20, "0").alias("order"),
            F.date_format("begin", iso).alias("begin_time"),
            F.when(F.col("o_orderkey") % 5 > 0, F.date_format(end, iso)).alias("end_time"),
            F.expr(_CLASS).alias("xray_class"),
        )
    )
    flares = orders.select(F.lit("solar_flares").alias("endpoint"), element.alias("element"), "begin", "o_custkey")
    for tick in range(2):
        _land(flares.filter(F.col("o_custkey") % 2 == tick), landing, F.trunc("begin", "month"))
        jobs.refresh_incremental(spark, layout, landing)
    return plain(jobs.read_gold(spark, layout, "contaminated_obs"))


@query(
    "refresh_all",
    f"""WITH {OBSERVATIONS_SQL}, flares AS (
      SELECT date_trunc('month', o_orderdate) + to_minutes(CAST((o_orderkey % 48) * 30 AS INT)) AS flare_start,
        flare_start + INTERVAL 40 MINUTE AS flare_end,
        max({pick("o_custkey % 5", "ABCMX")} || (o_custkey * 9 % 1000 // 10) || '.' || (o_custkey * 9 % 1000 % 10))
          AS flare_class FROM orders GROUP BY ALL
    ), {_WORST} SELECT * FROM contaminated""",
)
def refresh_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report files of several years and the raw table through to gold."""
    clock = F.date_format(F.col("begin") + F.expr("INTERVAL 40 MINUTE"), "HHmm")
    line = F.concat(
        F.lit("31777"), F.date_format("begin", "yyMMdd"), F.lit("  "), F.date_format("begin", "HHmm"), F.lit(" "),
        clock, F.lit(" "), clock, F.lit("  N08W23 "), F.expr(pick("o_custkey % 5", "ABCMX")), F.lit(" "),
        (F.col("o_custkey") * 9 % 1000).cast("string"), F.lit("    GOES 1.0E-03"),
    )
    orders = _dated_orders(spark, sf_dir)
    reports = _reports(orders.select(F.year("begin").alias("year"), F.lit(0).alias("part"), line.alias("line")))
    layout = _layout(spark)
    jobs.refresh_all(spark, layout, reports, 1900, 2100, raw=raw_observations(spark, sf_dir))
    return plain(jobs.read_gold(spark, layout, "contaminated_obs"))
