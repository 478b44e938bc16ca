"""Analysis tables over the silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.functions.flares import severity
from obsflow.functions.predicates import all_present, non_empty, one_of_upper, positive
from obsflow.operators.grid import grid_aggregate
from obsflow.operators.intervals import best_overlap
from obsflow.operators.latest import best_per_key
from obsflow.operators.tags import count_by, explode_tags, reference_table, with_reference
from obsflow.operators.trends import lag_difference, monthly_mean
from obsflow.schemas import CALIBRATION_TARGETS, EMISSION_LINES

LAG_ROWS = 12
OBSERVATION_SPAN = ("t_start", "t_end")
FLARE_SPAN = ("flare_start", "flare_end")


def scored_flares(flares: DataFrame) -> DataFrame:
    """Flare interval, class and score; a flare without an end lasts an hour."""
    return flares.select(
        F.col("event_start").alias("flare_start"),
        F.coalesce("event_end", F.col("event_start") + F.expr("INTERVAL 1 HOUR")).alias("flare_end"),
        F.col("xray_class").alias("flare_class"),
        severity(F.col("xray_class_letter"), F.col("xray_class_magnitude")).alias("risk_score"),
    )


def _spans(observations: DataFrame) -> DataFrame:
    columns = ("obs_id", *OBSERVATION_SPAN)
    return observations.select(*columns).filter(all_present(*columns))


CONTAMINATED = ("obs_id", "t_start", "t_end", "flare_class", "risk_score")

_SCORED = ("flare_start", "flare_end", "flare_class", "risk_score")


def _worst_first() -> list[Column]:
    """Equal scores go to the earlier flare, then to the lower class text."""
    return [F.col("risk_score").desc(), F.col("flare_start"), F.col("flare_class")]


def _first_row() -> list[Column]:
    return [F.col("t_start"), F.col("t_end")]


def worst_flares(observations: DataFrame, scored: DataFrame) -> DataFrame:
    """B6 with the start of the flare, which tells flares of one score and class apart."""
    worst = best_overlap(
        _spans(observations),
        scored,
        OBSERVATION_SPAN,
        FLARE_SPAN,
        keys=["obs_id"],
        order=_worst_first(),
        ties=_first_row(),
    )
    return worst.select(*CONTAMINATED, "flare_start")


def contaminated_obs(observations: DataFrame, scored: DataFrame) -> DataFrame:
    """Per obs_id the worst of the scored flares that overlap it, with that row's own times.

    Equal scores go to the earlier flare, then to the lower class text, then to
    the earlier observation row.
    """
    return worst_flares(observations, scored).select(*CONTAMINATED)


def changes(feed: DataFrame, scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The scored flares of a feed of changes that are there now, and those that are not.

    ``scored`` has the flares at hand; of them the time of the feed is read. So
    a change that a feed holds twice, or takes back, does no harm.
    """
    touched = scored_flares(feed).select(*_SCORED).distinct()
    start = F.unix_micros("flare_start")
    first, last = (F.timestamp_micros(F.lit(t).cast("bigint")) for t in touched.agg(F.min(start), F.max(start)).first())
    now = scored.select(*_SCORED).filter(F.col("flare_start").between(first, last))
    return touched.intersect(now), touched.subtract(now)


def losing_obs(current: DataFrame, withdrawn: DataFrame) -> DataFrame:
    """The obs_id of rows of ``worst_flares`` whose flare is withdrawn; no other one can lose its worst flare."""
    gone = ["flare_start", "flare_class", "risk_score"]
    return current.join(withdrawn.select(*gone).distinct(), gone, "left_semi").select("obs_id").distinct()


def _ends(df: DataFrame, span: tuple[str, str]) -> list[Column]:
    """The first and the last time of some intervals as literals, which reach a scan; null without rows."""
    ends = [F.unix_micros(c) for c in span]
    found = df.agg(F.min(F.least(*ends)), F.max(F.greatest(*ends))).first()
    return [F.timestamp_micros(F.lit(t).cast("bigint")) for t in found]


def maintained(
    current: DataFrame, observations: DataFrame, scored: DataFrame, added: DataFrame, losing: DataFrame
) -> DataFrame:
    """The rows of ``worst_flares`` that differ from ``current`` after flares were added and withdrawn.

    An added flare competes with the row at hand. Only the observations in
    ``losing`` are computed again, from the flares of their time; one of them that has no row
    here meets no flare any more.
    """
    spans = _spans(observations)
    again = spans.join(losing, "obs_id", "left_semi")
    first, last = _ends(again, OBSERVATION_SPAN)
    near = scored.filter((F.col("flare_start") <= last) & (F.col("flare_end") >= first))
    computed = worst_flares(again, near)
    first, last = _ends(added, FLARE_SPAN)
    met = spans.filter((F.col("t_start") <= last) & (F.col("t_end") >= first))
    new = worst_flares(met, added).join(losing, "obs_id", "left_anti").withColumn("_new", F.lit(True))
    held = current.join(new.select("obs_id"), "obs_id", "left_semi").withColumn("_new", F.lit(False))
    order = [*_worst_first(), *_first_row(), F.col("_new")]
    won = best_per_key(held.unionByName(new), ["obs_id"], order).filter("_new").drop("_new")
    return computed.unionByName(won)


def narrow_band_targets(observations: DataFrame) -> DataFrame:
    """Observations per target, narrow-band filter and emission line."""
    lines = reference_table(
        observations.sparkSession, EMISSION_LINES, ("filter", "emission_line")
    )
    named = observations.filter(non_empty(F.col("target_name")))
    tags = explode_tags(named, "filters", "filter", keep=["target_name"])
    keys = ["target_name", "filter", "emission_line"]
    return count_by(with_reference(tags, lines, "filter"), keys, "nb_obs")


def instrument_calibration(observations: DataFrame) -> DataFrame:
    """Mean calibration exposure per instrument and month, and its 12-row change."""
    calibrations = observations.filter(
        one_of_upper(F.col("target_name"), CALIBRATION_TARGETS)
        & all_present("t_start", "t_exptime")
        & positive(F.col("t_exptime"))
    ).withColumnRenamed("instrument_name", "instrument")
    monthly = monthly_mean(calibrations, "instrument", "t_start", "t_exptime", "avg_calib_time")
    return lag_difference(
        monthly, "instrument", ["year_month"], "avg_calib_time", LAG_ROWS, "trend_12m"
    )


def sky_coverage(observations: DataFrame, cell: float = 1.0) -> DataFrame:
    """Observations and exposure per sky cell."""
    return grid_aggregate(observations, "s_ra", "s_dec", "t_exptime", cell)
