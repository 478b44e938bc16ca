"""The driver's tables, and observation-shaped tables derived from them row by row.

Expressions that both SQL dialects read alike are written once. Doubles are
written with an exponent, since ``1440.0`` is a decimal in both.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.functions.flares import record_json
from obsflow.operators.sizing import spread
from obsflow.schemas import CALIBRATION_TARGETS, EMISSION_LINES, RAW_OBSERVATION_COLUMNS
from obsflow.session import scratch_path
from obsflow.sinks.files import write_parquet
from obsflow.sources.tables import read_parquet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; its times become timestamps."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in times})


_STORED: dict[tuple[str, ...], str] = {}


def stored(name: str, sf_dir: str, df: DataFrame) -> DataFrame:
    """A table written to the shared folder once per session, as one job hands it to the next."""
    spark = df.sparkSession
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = scratch_path(spark, name)
        write_parquet(df, path)
        _STORED[key] = path
    return read_parquet(spark, _STORED[key])


# Means of amounts in cents often end in a 5 right behind the last digit kept, where
# the order of a sum decides the rounding. The same small shift on both sides avoids that.
_SHIFT = 1e-7


def rounded(expression: str, digits: int = 4) -> str:
    """The SQL twin of the rounding in ``plain``."""
    return f"round({expression} + {_SHIFT}, {digits})"


def plain(df: DataFrame, digits: int = 4) -> DataFrame:
    """Result columns in types that both engines print alike."""
    casts = {"timestamp": "timestamp_ntz", "date": "string", "decimal": "double"}
    columns = []
    for field in df.schema.fields:
        name, kind = field.name, field.dataType.typeName()
        if kind == "double":
            columns.append(F.round(F.col(name) + _SHIFT, digits).alias(name))
        else:
            columns.append(F.col(name).cast(casts.get(kind, field.dataType)).alias(name))
    return df.select(*columns)


def pick(selector: str, values: Iterable[str]) -> str:
    """CASE that maps 0, 1, ... to the values."""
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {selector} {cases} END"


_CODES = [code for code, _ in EMISSION_LINES] + ["CLEAR1L", ""]
_TARGETS = [
    *(t.lower() if i % 2 else t for i, t in enumerate(CALIBRATION_TARGETS)),
    "",
    "   ",
]
_T_MIN = "(4.0587e4 + day + ((l_orderkey * 7 + l_linenumber * 13) % 1440) / 1.44e3)"

# Raw observation columns over lineitem plus `day`, the ship day counted from 1970.
_RAW = {
    "dataproduct_type": "CASE WHEN l_linestatus = 'O' THEN 'image' ELSE 'spectrum' END",
    "calib_level": pick("l_linenumber % 4", ["2.9", "3.0", "none", " "]),
    "obs_collection": "'C' || l_returnflag",
    "obs_id": "CASE WHEN l_partkey % 50 = 0 THEN '  ' ELSE 'obs-' || CAST(l_orderkey AS STRING) END",
    "target_name": f"""CASE WHEN l_suppkey % 16 < 13 THEN {pick("l_suppkey % 16", _TARGETS)}
        WHEN l_suppkey % 16 = 13 THEN NULL
        ELSE 'NGC ' || CAST(l_partkey % 700 AS STRING) END""",
    "s_ra": """CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN 'n/a'
        ELSE CAST(((l_partkey * 37) % 36000) / 1e2 AS STRING) END""",
    "s_dec": "CAST(((l_suppkey * l_linenumber * 131) % 18000) / 1e2 - 9e1 AS STRING)",
    "t_min": f"CAST({_T_MIN} AS STRING)",
    "t_max": f"""CAST({_T_MIN} + CASE WHEN l_partkey % 211 = 0 THEN -1e0 ELSE 1e0 END
        * l_quantity * 3e0 / 1.44e3 AS STRING)""",
    "t_exptime": """CASE WHEN l_linenumber = 7 THEN '-1.0' WHEN l_partkey % 41 = 0 THEN ''
        ELSE CAST(l_extendedprice AS STRING) END""",
    "wavelength_region": "'R' || l_linestatus",
    "filters": f"""CASE WHEN l_linenumber = 6 THEN NULL ELSE
        {pick("l_partkey % 14", _CODES)} || ';' || {pick("l_suppkey % 14", _CODES)} END""",
    "em_min": "CAST(l_discount * 1e2 AS STRING)",
    "em_max": "CAST(l_tax * 1e2 AS STRING)",
    "target_classification": "'class ' || CAST(l_linenumber AS STRING)",
    "t_obs_release": f"CAST({_T_MIN} + 1.8e2 AS STRING)",
    "instrument_name": "CASE WHEN l_suppkey % 7 = 6 THEN NULL ELSE 'INS/' || CAST(l_suppkey % 7 AS STRING) END",
    "proposal_pi": "'pi ' || CAST(l_suppkey AS STRING)",
    "proposal_id": "CAST(l_partkey AS STRING)",
    "proposal_type": "' '",
}


_RAW_INPUT = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An all-text observation table with a row per lineitem."""
    scan = spread(table(spark, sf_dir, "lineitem").select(*_RAW_INPUT))
    lines = scan.withColumn("day", F.unix_date(F.to_date("l_shipdate")))
    return lines.selectExpr(
        *(
            f"{_RAW.get(name, 'CAST(NULL AS STRING)')} AS {name}"
            for name in RAW_OBSERVATION_COLUMNS
        )
    )


RAW_SQL = f"""raw AS (
  SELECT {", ".join(f"{_RAW.get(name, 'CAST(NULL AS STRING)')} AS {name}" for name in RAW_OBSERVATION_COLUMNS)}
  FROM (SELECT *, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS day FROM lineitem)
)"""


# Flare events over orders: texts that both engines build alike.
_CLOCK = "lpad(CAST({hour} AS STRING), 2, '0') || lpad(CAST({minute} AS STRING), 2, '0')"
_END_CLOCK = _CLOCK.format(hour="(o_orderkey + 3) % 25", minute="(o_custkey * 7) % 60")
_ENDPOINT = """CASE WHEN o_orderkey % 10 = 9 THEN 'kp_index'
    WHEN o_orderkey % 3 = 0 THEN 'solar_flares_archive' ELSE 'solar_flares' END"""
_CLASS = f"""CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN 'N/A'
    ELSE {pick("o_custkey % 5", "ABCMX")} || CAST(o_orderkey % 30 AS STRING) || '.'
      || CAST(o_custkey % 10 AS STRING) END"""


def flare_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event envelopes with a row per order; starts repeat, so versions compete."""
    orders = table(spark, sf_dir, "orders")
    start = F.col("o_orderdate") + F.expr(
        "make_dt_interval(0, int((o_orderkey % 48) div 2), int((o_orderkey % 2) * 30))"
    )
    dated = orders.withColumn("event_time", start).withColumn(
        "begin_iso", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    record = record_json(
        F.when(F.expr("o_orderkey % 4 > 0"), F.col("begin_iso")).alias("begin_time"),
        F.expr(
            f"CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN begin_iso ELSE {_END_CLOCK} END"
        ).alias("end_time"),
        F.expr(f"CASE WHEN o_orderkey % 7 = 0 THEN '////' ELSE {_END_CLOCK} END").alias("max_time"),
        F.expr(_CLASS).alias("xray_class"),
        F.col("o_orderstatus").alias("status"),
    )
    return dated.select(
        F.expr(_ENDPOINT).alias("endpoint"),
        "event_time",
        record.alias("record"),
        (F.lit("2024-01-01").cast("timestamp") + F.expr("make_dt_interval(0, 0, 0, o_custkey)")).alias(
            "ingested_at"
        ),
    )


def _clock_sql(text: str) -> str:
    same_day = f"""date_trunc('day', event_time) + to_hours(CAST(substr({text}, 1, 2) AS INT))
        + to_minutes(CAST(substr({text}, 3, 2) AS INT))"""
    return f"""CASE WHEN NOT regexp_full_match({text}, '[0-9]{{4}}')
          THEN TRY_CAST(replace({text}, 'Z', '') AS TIMESTAMP)
        WHEN CAST(substr({text}, 1, 2) AS INT) > 23 OR CAST(substr({text}, 3, 2) AS INT) > 59 THEN NULL
        WHEN {same_day} < event_time THEN {same_day} + INTERVAL 1 DAY
        ELSE {same_day} END"""


FLARE_EVENTS_SQL = f"""events_raw AS (
  SELECT {_ENDPOINT} AS endpoint, event_time,
    CASE o_orderkey % 5 WHEN 0 THEN NULL
      WHEN 1 THEN strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') ELSE {_END_CLOCK} END AS end_text,
    CASE WHEN o_orderkey % 7 = 0 THEN '////' ELSE {_END_CLOCK} END AS max_text,
    {_CLASS} AS xray_class, ingested_at
  FROM (SELECT *, o_orderdate + to_minutes(CAST((o_orderkey % 48) * 30 AS INT)) AS event_time,
          TIMESTAMP '2024-01-01' + to_seconds(o_custkey) AS ingested_at FROM orders)
), typed_flares AS (
  SELECT CASE WHEN endpoint = 'solar_flares_archive' THEN 'archive' ELSE 'live' END AS source,
    event_time AS event_start, {_clock_sql("end_text")} AS event_end,
    {_clock_sql("max_text")} AS event_max, xray_class,
    CASE WHEN xray_class IS NULL THEN NULL ELSE regexp_extract(xray_class, '^([ABCMX])(\\d+(?:\\.\\d+)?)', 1) END
      AS xray_class_letter,
    TRY_CAST(regexp_extract(xray_class, '^([ABCMX])(\\d+(?:\\.\\d+)?)', 2) AS DOUBLE) AS xray_class_magnitude,
    ingested_at
  FROM events_raw WHERE endpoint IN ('solar_flares', 'solar_flares_archive')
), flares AS (
  SELECT * FROM typed_flares
  WHERE xray_class IS NOT NULL
    AND event_start BETWEEN TIMESTAMP '1990-01-01' AND TIMESTAMP '2030-12-31'
  QUALIFY row_number() OVER (PARTITION BY event_start, xray_class
    ORDER BY ingested_at DESC, source DESC, event_end DESC NULLS LAST, event_max DESC NULLS LAST) = 1
)"""


def _text(column: str) -> str:
    return f"CASE WHEN trim({column}, ' ') = '' THEN NULL ELSE {column} END"


def _number(column: str) -> str:
    return f"TRY_CAST({_text(column)} AS DOUBLE)"


def _instant(column: str) -> str:
    return f"make_timestamp(CAST(trunc(({_number(column)} - 4.0587e4) * 8.64e4) AS BIGINT) * 1000000)"


OBSERVATIONS_SQL = f"""{RAW_SQL}, typed AS (
  SELECT {_text("obs_id")} AS obs_id, {_text("obs_collection")} AS obs_collection,
    {_text("dataproduct_type")} AS dataproduct_type,
    CAST(trunc({_number("calib_level")}) AS INT) AS calib_level,
    {_text("target_name")} AS target_name, {_text("target_classification")} AS target_classification,
    {_number("s_ra")} AS s_ra, {_number("s_dec")} AS s_dec,
    {_instant("t_min")} AS t_start, {_instant("t_max")} AS t_end,
    {_number("t_exptime")} AS t_exptime, {_instant("t_obs_release")} AS release_date,
    {_text("instrument_name")} AS instrument_name,
    string_split({_text("filters")}, ';') AS filters,
    {_text("wavelength_region")} AS wavelength_region,
    {_number("em_min")} AS em_min, {_number("em_max")} AS em_max,
    {_text("proposal_id")} AS proposal_id, {_text("proposal_pi")} AS proposal_pi,
    {_text("proposal_type")} AS proposal_type
  FROM raw
), obs AS (SELECT * FROM typed WHERE obs_id IS NOT NULL)"""
