"""Annual flare reports in a fixed text layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.functions.flares import is_report_data, record_json, report_fields, strip_line
from obsflow.operators.rejects import REASON
from obsflow.schemas import ARCHIVE_FLARES

# The last group of four digits in a file name is the year of the report.
_YEAR_IN_NAME = r"(\d{4})\D*$"


def read_reports(spark: SparkSession, folder: str, first_year: int, last_year: int) -> DataFrame:
    """Lines of the report files of the given years, as ``year, line``."""
    lines = spark.read.text(folder).select(
        F.regexp_extract("_metadata.file_name", _YEAR_IN_NAME, 1).try_cast("int").alias("year"),
        F.col("value").alias("line"),
    )
    return lines.filter(F.col("year").between(first_year, last_year))


def parse_reports(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Data lines with their parsed fields, ``fields`` null where rejected."""
    stripped = lines.select(*keep, "year", strip_line(F.col("line")).alias("line"))
    # Behind a generator, or each field read later would parse the line again.
    fields = F.explode(F.array(report_fields(F.col("line"), F.col("year"))))
    return stripped.filter(is_report_data(F.col("line"))).withColumn("fields", fields)


def report_events(parsed: DataFrame, ingested_at: Column) -> DataFrame:
    """Parsed lines to event envelopes."""
    record = record_json(
        *(F.col(f"fields.{n}").alias(n) for n in
          ("begin_time", "end_time", "max_time", "xray_class", "raw_line"))
    )
    return parsed.filter(F.col("fields").isNotNull()).select(
        F.lit(ARCHIVE_FLARES).alias("endpoint"),
        F.col("fields.event_time").alias("event_time"),
        record.alias("record"),
        ingested_at.alias("ingested_at"),
    )


def report_rejects(parsed: DataFrame, ingested_at: Column) -> DataFrame:
    """K7: data lines that were not accepted."""
    return parsed.filter(F.col("fields").isNull()).select(
        "year",
        "line",
        F.lit("no flare in line").alias(REASON),
        ingested_at.alias("ingested_at"),
    )


def report_counts(parsed: DataFrame) -> DataFrame:
    """Parsed and skipped data lines per year."""
    return parsed.groupBy("year").agg(
        F.count_if(F.col("fields").isNotNull()).alias("parsed"),
        F.count_if(F.col("fields").isNull()).alias("skipped"),
    )
