"""Typed tables from raw text and event envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.functions.cleaning import (
    blank_to_null,
    mjd_to_timestamp,
    relabel,
    split_list,
    to_double,
    to_int,
)
from obsflow.functions.flares import class_letter, class_magnitude
from obsflow.functions.predicates import one_of, plausible
from obsflow.functions.times import clock_after, event_start
from obsflow.operators.latest import latest_per_key
from obsflow.operators.rejects import valid, with_reason
from obsflow.schemas import ARCHIVE_FLARES, FLARE_RECORD, LIVE_FLARES, OBSERVATION

# Silver columns whose raw column has another name.
_RENAMED = {"t_start": "t_min", "t_end": "t_max", "release_date": "t_obs_release"}

_BY_TYPE = {
    T.StringType(): blank_to_null,
    T.IntegerType(): to_int,
    T.DoubleType(): to_double,
    T.TimestampType(): mjd_to_timestamp,
    T.ArrayType(T.StringType()): split_list,
}

FLARE_KEY = ("event_start", "xray_class")


def typed_observations(raw: DataFrame) -> DataFrame:
    """Raw text columns pruned, renamed and typed, with the reason of rejected rows (K7)."""
    typed = raw.select(
        *(
            _BY_TYPE[field.dataType](F.col(_RENAMED.get(field.name, field.name))).alias(field.name)
            for field in OBSERVATION.fields
        )
    )
    return with_reason(typed, {"missing obs_id": F.col("obs_id").isNull()})


def observations(raw: DataFrame) -> DataFrame:
    """Typed rows that have an obs_id."""
    return valid(typed_observations(raw))


def typed_flares(
    events: DataFrame, class_keys: Sequence[str] = ("xray_class",), keep: Sequence[str] = ()
) -> DataFrame:
    """Flare envelopes typed, with the reason of rejected rows (K7).

    ``class_keys`` are the record keys tried in turn for the flare class,
    ``keep`` names columns of the envelopes that stay.
    """
    keys = {*FLARE_RECORD.fieldNames(), *class_keys}
    schema = T.StructType([T.StructField(name, T.StringType()) for name in sorted(keys)])
    flares = events.filter(one_of(F.col("endpoint"), [LIVE_FLARES, ARCHIVE_FLARES]))
    # Behind a generator, since a filter on the fields would otherwise move below
    # the parse and parse every record again for each field it tests.
    record = F.explode(F.array(F.from_json("record", schema)))
    parsed = (
        flares.withColumn("rec", record)
        .withColumn("event_start", event_start(F.col("rec.begin_time"), F.col("event_time")))
        .withColumn("xray_class", F.coalesce(*(F.col(f"rec.{k}") for k in class_keys)))
    )

    def clock(name: str) -> Column:
        return clock_after(F.col(f"rec.{name}"), F.col("event_start"))

    typed = parsed.select(
        relabel(F.col("endpoint"), {ARCHIVE_FLARES: "archive"}, "live").alias("source"),
        "event_start",
        clock("end_time").alias("event_end"),
        clock("max_time").alias("event_max"),
        "xray_class",
        class_letter(F.col("xray_class")).alias("xray_class_letter"),
        class_magnitude(F.col("xray_class")).alias("xray_class_magnitude"),
        "ingested_at",
        *keep,
    )
    return with_reason(
        typed,
        {
            "missing event_start": F.col("event_start").isNull(),
            "missing xray_class": F.col("xray_class").isNull(),
            "implausible event_start": ~plausible(F.col("event_start")),
        },
    )


def flares(events: DataFrame, class_keys: Sequence[str] = ("xray_class",)) -> DataFrame:
    """The newest version of every plausible flare."""
    return newest_flares(valid(typed_flares(events, class_keys)))


def newest_flares(typed: DataFrame) -> DataFrame:
    """The newest version of every flare."""
    return latest_per_key(
        typed,
        FLARE_KEY,
        "ingested_at",
        ties=("source", "event_end", "event_max"),
    )
