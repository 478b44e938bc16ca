"""Dashboard aggregates over the gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEVERE = 80


def sky_kpis(sky: DataFrame) -> DataFrame:
    """Distinct right-ascension bins and total exposure."""
    return sky.agg(
        F.count_distinct("ra_bin").alias("ra_bins"),
        F.sum("total_exptime").alias("total_exptime"),
    )


def narrow_band_kpis(targets: DataFrame) -> DataFrame:
    """R2: distinct targets, and the filter with the most observations (ties by name)."""
    names = targets.agg(F.count_distinct("target_name").alias("targets"))
    top = (
        targets.groupBy("filter")
        .agg(F.sum("nb_obs").alias("filter_obs"))
        .orderBy(F.col("filter_obs").desc(), "filter")
        .limit(1)
        .withColumnRenamed("filter", "top_filter")
    )
    # Two single rows, joined on a constant; no filter row still gives the count.
    return (
        names.withColumn("_one", F.lit(1))
        .join(top.withColumn("_one", F.lit(1)), "_one", "left")
        .select("targets", "top_filter", "filter_obs")
    )


def target_line_matrix(targets: DataFrame, lines: Sequence[str]) -> DataFrame:
    """Observations per target, one column per emission line."""
    return targets.groupBy("target_name").pivot("emission_line", list(lines)).sum("nb_obs")


def risk_kpis(contaminated: DataFrame, severe: int = SEVERE) -> DataFrame:
    """All contaminated observations, and those above the severe score."""
    return contaminated.agg(
        F.count(F.lit(1)).alias("observations"),
        F.count_if(F.col("risk_score") > severe).alias("severe"),
    )


def risk_histogram(contaminated: DataFrame, width: int = 10) -> DataFrame:
    """Observations per score band; the band is named by its lower edge."""
    band = (F.floor(F.col("risk_score") / width) * width).cast("int")
    return contaminated.groupBy(band.alias("risk_from")).agg(F.count(F.lit(1)).alias("nb_obs"))


def strongest_drift(calibration: DataFrame) -> DataFrame:
    """The instrument with the highest mean 12-month trend (ties by name)."""
    return (
        calibration.filter(F.col("trend_12m").isNotNull())
        .groupBy("instrument")
        .agg(F.avg("trend_12m").alias("mean_trend"))
        .orderBy(F.col("mean_trend").desc(), F.col("instrument").asc_nulls_last())
        .limit(1)
    )


def yearly_drift(calibration: DataFrame) -> DataFrame:
    """Per instrument and year the mean calibration time and mean trend."""
    return calibration.groupBy("instrument", F.year("year_month").alias("year")).agg(
        F.avg("avg_calib_time").alias("avg_calib_time"),
        F.avg("trend_12m").alias("avg_trend"),
    )
