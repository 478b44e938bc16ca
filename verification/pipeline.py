"""Silver and gold tables end to end, and the reads on top of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.operators import grid, kpis
from obsflow.operators.paging import Page, gold_json_page, gold_page, gold_page_after, json_rows
from obsflow.operators.rejects import REASON
from obsflow.plans import gold, silver
from obsflow.schemas import CALIBRATION_TARGETS, EMISSION_LINES
from verification import query
from verification.inputs import (
    FLARE_EVENTS_SQL,
    OBSERVATIONS_SQL,
    flare_events,
    plain,
    raw_observations,
    rounded,
    stored,
)

_LINES = sorted({line for _, line in EMISSION_LINES})


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table that gold is built on."""
    return stored("observations", sf_dir, silver.observations(raw_observations(spark, sf_dir)))


def _flares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table that gold is built on."""
    return stored("flares", sf_dir, silver.flares(flare_events(spark, sf_dir)))


def _contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.contaminated_obs(
        _observations(spark, sf_dir), gold.scored_flares(_flares(spark, sf_dir))
    )


def _narrow_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.narrow_band_targets(_observations(spark, sf_dir))


def _calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.instrument_calibration(_observations(spark, sf_dir))


def _sky(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.sky_coverage(_observations(spark, sf_dir))


CONTAMINATED_SQL = f"""{OBSERVATIONS_SQL}, {FLARE_EVENTS_SQL}, scored AS (
  SELECT event_start AS flare_start, coalesce(event_end, event_start + INTERVAL 1 HOUR) AS flare_end,
    xray_class AS flare_class,
    CAST(trunc(CASE xray_class_letter WHEN 'A' THEN 0 WHEN 'B' THEN 20 WHEN 'C' THEN 40
      WHEN 'M' THEN 60 WHEN 'X' THEN 80 ELSE 0 END + coalesce(xray_class_magnitude, 0)) AS INT) AS risk_score
  FROM flares
), contaminated AS (
  SELECT obs_id, t_start, t_end, flare_class, risk_score
  FROM obs JOIN scored ON flare_start <= t_end AND flare_end >= t_start
  QUALIFY row_number() OVER (PARTITION BY obs_id
    ORDER BY risk_score DESC, flare_start, flare_class, t_start, t_end) = 1
)"""

_REFERENCE = ", ".join(f"('{code}', '{line}')" for code, line in EMISSION_LINES)
NARROW_BAND_SQL = f"""{OBSERVATIONS_SQL}, narrow_band AS (
  SELECT target_name, filter, emission_line, count(*) AS nb_obs
  FROM (SELECT target_name, unnest(filters) AS filter FROM obs WHERE target_name <> '') AS tags
  JOIN (VALUES {_REFERENCE}) AS lines(filter, emission_line) USING (filter)
  GROUP BY ALL
)"""

_TARGETS = ", ".join(f"'{t}'" for t in CALIBRATION_TARGETS)
CALIBRATION_SQL = f"""{OBSERVATIONS_SQL}, monthly AS (
  SELECT instrument_name AS instrument, date_trunc('month', t_start) AS month,
    avg(t_exptime) AS avg_calib_time
  FROM obs WHERE upper(target_name) IN ({_TARGETS}) AND t_start IS NOT NULL AND t_exptime > 0
  GROUP BY ALL
), calibration AS (
  SELECT instrument, CAST(month AS DATE) AS year_month, avg_calib_time,
    avg_calib_time - lag(avg_calib_time, 12) OVER (PARTITION BY instrument ORDER BY month) AS trend_12m
  FROM monthly
)"""

SKY_SQL = f"""{OBSERVATIONS_SQL}, sky AS (
  SELECT floor(s_ra) AS ra_bin, floor(s_dec) AS dec_bin, count(*) AS nb_obs,
    coalesce(sum(t_exptime), 0) AS total_exptime
  FROM obs WHERE s_ra IS NOT NULL AND s_dec IS NOT NULL GROUP BY ALL
)"""

_CALIBRATION_COLUMNS = f"""instrument, CAST(year_month AS VARCHAR) AS year_month,
    {rounded('avg_calib_time', 4)} AS avg_calib_time, {rounded('trend_12m', 4)} AS trend_12m"""


@query(
    "silver_observations",
    f"""WITH {OBSERVATIONS_SQL}
    SELECT * REPLACE (array_to_string(filters, '|') AS filters, {rounded('s_ra', 4)} AS s_ra,
      {rounded('s_dec', 4)} AS s_dec, {rounded('t_exptime', 4)} AS t_exptime, {rounded('em_min', 4)} AS em_min,
      {rounded('em_max', 4)} AS em_max) FROM obs""",
)
def silver_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1-P7."""
    obs = silver.observations(raw_observations(spark, sf_dir))
    return plain(obs.withColumn("filters", F.array_join("filters", "|")))


@query(
    "observation_rejects",
    f"""WITH {OBSERVATIONS_SQL}
    SELECT coalesce(CASE WHEN obs_id IS NULL THEN 'missing obs_id' END, 'valid') AS outcome,
      count(*) AS n FROM typed GROUP BY ALL""",
)
def observation_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 on observations."""
    typed = silver.typed_observations(raw_observations(spark, sf_dir))
    outcome = F.coalesce(REASON, F.lit("valid")).alias("outcome")
    return typed.groupBy(outcome).agg(F.count(F.lit(1)).alias("n"))


@query("silver_flares", f"WITH {FLARE_EVENTS_SQL} SELECT * FROM flares")
def silver_flares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8, X2-X5, P15, P10, W1."""
    return plain(silver.flares(flare_events(spark, sf_dir)))


@query(
    "flare_rejects",
    f"""WITH {FLARE_EVENTS_SQL}
    SELECT CASE WHEN xray_class IS NULL THEN 'missing xray_class' ELSE 'valid' END AS outcome,
      count(*) AS n FROM typed_flares GROUP BY ALL""",
)
def flare_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 on flares."""
    typed = silver.typed_flares(flare_events(spark, sf_dir))
    outcome = F.coalesce(REASON, F.lit("valid")).alias("outcome")
    return typed.groupBy(outcome).agg(F.count(F.lit(1)).alias("n"))


@query("contaminated_obs", f"WITH {CONTAMINATED_SQL} SELECT * FROM contaminated")
def contaminated_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13, J1, X7, W2."""
    return plain(_contaminated(spark, sf_dir))


@query("contaminated_update", f"WITH {CONTAMINATED_SQL} SELECT * FROM contaminated")
def contaminated_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a table over fewer, partly other flares to the one over all flares."""
    observations = _observations(spark, sf_dir)
    after = gold.scored_flares(_flares(spark, sf_dir))
    later = F.col("flare_start") < F.lit("1999-01-01").cast("timestamp")
    corrected = F.when(F.col("flare_class").startswith("X1"), 0).otherwise(F.col("risk_score"))
    before = after.filter(later).withColumn("risk_score", corrected.cast("int"))
    current = stored("contaminated_before", sf_dir, gold.worst_flares(observations, before))
    added, withdrawn = (
        stored(name, sf_dir, one.subtract(other))
        for name, one, other in (("flares_added", after, before), ("flares_withdrawn", before, after))
    )
    losing = stored("losing", sf_dir, gold.losing_obs(current, withdrawn))
    changed = stored("obs_changed", sf_dir, gold.maintained(current, observations, after, added, losing))
    same = current.join(losing.union(changed.select("obs_id")), "obs_id", "left_anti")
    return plain(same.unionByName(changed).select(*gold.CONTAMINATED))


@query("narrow_band_targets", f"WITH {NARROW_BAND_SQL} SELECT * FROM narrow_band")
def narrow_band_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9, G1, P12, J2, A1."""
    return plain(_narrow_band(spark, sf_dir))


@query(
    "instrument_calibration",
    f"WITH {CALIBRATION_SQL} SELECT {_CALIBRATION_COLUMNS} FROM calibration",
)
def instrument_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9, P11, A3, W3."""
    return plain(_calibration(spark, sf_dir))


@query(
    "sky_coverage",
    f"WITH {SKY_SQL} SELECT * REPLACE ({rounded('total_exptime', 2)} AS total_exptime) FROM sky",
)
def sky_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13, A2."""
    return plain(_sky(spark, sf_dir), digits=2)


@query(
    "sky_blind_spots",
    f"""WITH {SKY_SQL}
    SELECT CAST(x AS DOUBLE) AS ra_bin, CAST(y AS DOUBLE) AS dec_bin
    FROM range(0, 360) AS a(x), range(-90, 90) AS b(y)
    WHERE NOT EXISTS (SELECT 1 FROM sky WHERE ra_bin = x AND dec_bin = y)""",
)
def sky_blind_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the whole sky without an observation."""
    sky = _sky(spark, sf_dir)
    return grid.empty_cells(sky, "ra_bin", "dec_bin", (0.0, 360.0), (-90.0, 90.0))


@query(
    "sky_over_observed",
    f"""WITH {SKY_SQL} SELECT ra_bin, dec_bin, nb_obs, {rounded('total_exptime', 2)} AS total_exptime
    FROM sky ORDER BY nb_obs DESC, ra_bin, dec_bin LIMIT 20""",
)
def sky_over_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report."""
    return plain(grid.busiest_cells(_sky(spark, sf_dir), 20), digits=2)


@query(
    "page_contaminated",
    f"""WITH {CONTAMINATED_SQL} SELECT * FROM contaminated
    WHERE t_start >= TIMESTAMP '1996-01-01' AND t_start <= TIMESTAMP '1999-12-31'
    ORDER BY t_start, obs_id LIMIT 50 OFFSET 10""",
)
def page_contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1, O2, P14."""
    page = Page.of("50", "10")
    rows = _contaminated(spark, sf_dir)
    return plain(gold_page(rows, "contaminated_obs", page, "1996-01-01", "1999-12-31"))


@query(
    "page_after_contaminated",
    f"""WITH {CONTAMINATED_SQL} SELECT * FROM contaminated
    WHERE t_start >= TIMESTAMP '1996-01-01' ORDER BY t_start, obs_id LIMIT 30 OFFSET 60""",
)
def page_after_contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2 by key: the third page, reached from the last row of the second."""
    # Three pages of one table, which is computed once.
    rows, last = stored("contaminated", sf_dir, _contaminated(spark, sf_dir)), None
    for _ in range(2):
        page = gold_page_after(rows, "contaminated_obs", 30, last, "1996-01-01").collect()
        last = page[-1].asDict()
    return plain(gold_page_after(rows, "contaminated_obs", 30, last, "1996-01-01"))


@query(
    "page_narrow_band",
    f"""WITH {NARROW_BAND_SQL} SELECT * FROM narrow_band
    ORDER BY nb_obs DESC, target_name, filter, emission_line LIMIT 20 OFFSET 5""",
)
def page_narrow_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3."""
    return plain(gold_page(_narrow_band(spark, sf_dir), "narrow_band_targets", Page.of(20, 5)))


@query(
    "page_calibration",
    f"""WITH {CALIBRATION_SQL} SELECT {_CALIBRATION_COLUMNS} FROM (
      SELECT * FROM calibration WHERE year_month BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
      ORDER BY instrument NULLS LAST, year_month LIMIT 100 OFFSET 250)""",
)
def page_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page reaches the rows without an instrument."""
    page = Page.of(None, 250)
    rows = _calibration(spark, sf_dir)
    return plain(gold_page(rows, "instrument_calibration", page, "1996-01-01", "2000-12-31"))


@query(
    "page_sky",
    f"""WITH {SKY_SQL} SELECT ra_bin, dec_bin, nb_obs, {rounded('total_exptime', 2)} AS total_exptime
    FROM sky ORDER BY nb_obs DESC, ra_bin, dec_bin LIMIT 200""",
)
def page_sky(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5."""
    return plain(gold_page(_sky(spark, sf_dir), "sky_coverage", Page.of(200)), digits=2)


_NARROW_JSON = """'{"target_name":"' || target_name || '","filter":"' || filter
    || '","emission_line":"' || emission_line || '","nb_obs":' || nb_obs || '}'"""


@query("json_rows", f"WITH {NARROW_BAND_SQL} SELECT {_NARROW_JSON} AS row FROM narrow_band")
def json_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: rows as JSON."""
    return json_rows(_narrow_band(spark, sf_dir))


@query(
    "json_page",
    f"""WITH {NARROW_BAND_SQL}, page AS (
      SELECT * FROM narrow_band ORDER BY nb_obs DESC, target_name, filter, emission_line LIMIT 30 OFFSET 3)
    SELECT '{{"count":' || count(*) || ',"limit":30,"offset":3,"rows":['
      || string_agg({_NARROW_JSON}, ',' ORDER BY nb_obs DESC, target_name, filter, emission_line)
      || ']}}' AS page FROM page""",
)
def json_page_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: a page with its envelope."""
    return gold_json_page(_narrow_band(spark, sf_dir), "narrow_band_targets", Page.of(30, 3))


@query(
    "kpi_sky",
    f"""WITH {SKY_SQL}
    SELECT count(DISTINCT ra_bin) AS ra_bins, {rounded('sum(total_exptime)', 2)} AS total_exptime FROM sky""",
)
def kpi_sky(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1."""
    return plain(kpis.sky_kpis(_sky(spark, sf_dir)), digits=2)


@query(
    "kpi_narrow_band",
    f"""WITH {NARROW_BAND_SQL}, top AS (
      SELECT filter, CAST(sum(nb_obs) AS BIGINT) AS n FROM narrow_band GROUP BY ALL
      ORDER BY n DESC, filter LIMIT 1)
    SELECT (SELECT count(DISTINCT target_name) FROM narrow_band) AS targets,
      filter AS top_filter, n AS filter_obs FROM top""",
)
def kpi_narrow_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2."""
    return kpis.narrow_band_kpis(_narrow_band(spark, sf_dir))


_PIVOT = ", ".join(
    f"CAST(sum(nb_obs) FILTER (emission_line = '{line}') AS BIGINT) AS \"{line}\"" for line in _LINES
)


@query(
    "target_line_matrix",
    f"WITH {NARROW_BAND_SQL} SELECT target_name, {_PIVOT} FROM narrow_band GROUP BY target_name",
)
def target_line_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3."""
    return kpis.target_line_matrix(_narrow_band(spark, sf_dir), _LINES)


@query(
    "kpi_risk",
    f"""WITH {CONTAMINATED_SQL}
    SELECT count(*) AS observations, count(*) FILTER (risk_score > 80) AS severe FROM contaminated""",
)
def kpi_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4."""
    return kpis.risk_kpis(_contaminated(spark, sf_dir))


@query(
    "risk_histogram",
    f"""WITH {CONTAMINATED_SQL}
    SELECT CAST(floor(risk_score / 10) * 10 AS INT) AS risk_from, count(*) AS nb_obs
    FROM contaminated GROUP BY ALL""",
)
def risk_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5."""
    return kpis.risk_histogram(_contaminated(spark, sf_dir))


@query(
    "drift_strongest",
    f"""WITH {CALIBRATION_SQL}
    SELECT instrument, {rounded('avg(trend_12m)', 4)} AS mean_trend FROM calibration
    WHERE trend_12m IS NOT NULL GROUP BY instrument
    ORDER BY avg(trend_12m) DESC, instrument NULLS LAST LIMIT 1""",
)
def drift_strongest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest drift."""
    return plain(kpis.strongest_drift(_calibration(spark, sf_dir)))


@query(
    "drift_yearly",
    f"""WITH {CALIBRATION_SQL}
    SELECT instrument, CAST(year(year_month) AS INT) AS year, {rounded('avg(avg_calib_time)', 4)} AS avg_calib_time,
      {rounded('avg(trend_12m)', 4)} AS avg_trend FROM calibration GROUP BY ALL""",
)
def drift_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yearly series."""
    return plain(kpis.yearly_drift(_calibration(spark, sf_dir)))
