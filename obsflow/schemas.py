"""Table schemas and the fixed values that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the raw observation export, in file order.
RAW_OBSERVATION_COLUMNS = (
    "dataproduct_type", "calib_level", "obs_collection", "obs_id", "target_name",
    "s_ra", "s_dec", "t_min", "t_max", "t_exptime", "wavelength_region", "filters",
    "em_min", "em_max", "target_classification", "obs_title", "t_obs_release",
    "instrument_name", "proposal_pi", "proposal_id", "proposal_type", "project",
    "sequence_number", "provenance_name", "s_region", "jpegURL", "dataURL",
    "dataRights", "mtFlag", "srcDen", "intentType", "obsid", "objID", "wave_min",
    "wave_max", "wave_region",
)

RAW_OBSERVATION = T.StructType(
    [T.StructField(name, T.StringType()) for name in RAW_OBSERVATION_COLUMNS]
)

# Columns of the event, observation and flare tables, in their order.
EVENT_ENVELOPE = T.StructType(
    [
        T.StructField("endpoint", T.StringType(), False),
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("record", T.StringType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
    ]
)

OBSERVATION = T.StructType(
    [
        T.StructField("obs_id", T.StringType()),
        T.StructField("obs_collection", T.StringType()),
        T.StructField("dataproduct_type", T.StringType()),
        T.StructField("calib_level", T.IntegerType()),
        T.StructField("target_name", T.StringType()),
        T.StructField("target_classification", T.StringType()),
        T.StructField("s_ra", T.DoubleType()),
        T.StructField("s_dec", T.DoubleType()),
        T.StructField("t_start", T.TimestampType()),
        T.StructField("t_end", T.TimestampType()),
        T.StructField("t_exptime", T.DoubleType()),
        T.StructField("release_date", T.TimestampType()),
        T.StructField("instrument_name", T.StringType()),
        T.StructField("filters", T.ArrayType(T.StringType())),
        T.StructField("wavelength_region", T.StringType()),
        T.StructField("em_min", T.DoubleType()),
        T.StructField("em_max", T.DoubleType()),
        T.StructField("proposal_id", T.StringType()),
        T.StructField("proposal_pi", T.StringType()),
        T.StructField("proposal_type", T.StringType()),
    ]
)

FLARE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("event_start", T.TimestampType()),
        T.StructField("event_end", T.TimestampType()),
        T.StructField("event_max", T.TimestampType()),
        T.StructField("xray_class", T.StringType()),
        T.StructField("xray_class_letter", T.StringType()),
        T.StructField("xray_class_magnitude", T.DoubleType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

# The part of a flare record that is read; other keys are ignored.
FLARE_RECORD = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("begin_time", "end_time", "max_time", "xray_class")
    ]
)

# Feed names and the record key that holds the time of an event.
FEED_TIME_KEYS = {
    "kp_index": "time_tag",
    "xray_flux": "time_tag",
    "solar_wind": "time_tag",
    "solar_flares": "begin_time",
}

# Endpoint names that carry flares.
LIVE_FLARES = "solar_flares"
ARCHIVE_FLARES = "solar_flares_archive"

# Narrow-band filter codes and the emission line each one isolates.
EMISSION_LINES = (
    ("F656N", "Halpha"),
    ("F658N", "Halpha+NII"),
    ("F502N", "OIII"),
    ("F673N", "SII"),
    ("F487N", "Hbeta"),
    ("F631N", "OI"),
    ("F164N", "FeII"),
    ("F343N", "NeV"),
    ("F953N", "SIII"),
    ("F469N", "HeII"),
    ("F505N", "OIII"),
    ("F657N", "Halpha+NII"),
)

# Target names, in upper case, that mark a calibration exposure.
CALIBRATION_TARGETS = (
    "BIAS", "DARK", "BLANK", "FLAT", "FLATFIELD", "INTFLAT", "CCDFLAT",
    "EARTH-CALIB", "EARTHFLAT", "TUNGSTEN", "DEUTERIUM",
)

# Base score of a flare class letter; other letters score 0.
CLASS_SCORES = {"A": 0, "B": 20, "C": 40, "M": 60, "X": 80}

# Plausible range of an event start, both ends included.
EARLIEST_EVENT = "1990-01-01"
LATEST_EVENT = "2030-12-31"

# Page size when none is given, and the largest one.
DEFAULT_PAGE = 100
LARGEST_PAGE = 10_000
