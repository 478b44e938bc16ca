"""JSON feeds landed as files, one payload per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.functions.times import parse_iso
from obsflow.operators.rejects import REASON, valid
from obsflow.schemas import FEED_TIME_KEYS

# Landing layout: <landing>/<endpoint>/<any name>; the folder names the feed.
LANDED = "landed_at"
_ENDPOINT_FOLDER = r"([^/]+)/[^/]+$"


def read_payloads(spark: SparkSession, landing: str) -> DataFrame:
    """Landed payload files as ``endpoint, value`` and the time each landed."""
    files = spark.read.text(f"{landing}/*/*", wholetext=True)
    return with_endpoint(files)


def stream_payloads(spark: SparkSession, landing: str, files_per_batch: int = 1000) -> DataFrame:
    """The same as a stream of newly landed files."""
    files = (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .text(f"{landing}/*/*", wholetext=True)
    )
    return with_endpoint(files)


def with_endpoint(files: DataFrame) -> DataFrame:
    endpoint = F.regexp_extract(F.col("_metadata.file_path"), _ENDPOINT_FOLDER, 1)
    return files.select(
        endpoint.alias("endpoint"), "value", F.col("_metadata.file_modification_time").alias(LANDED)
    )


def parse_payloads(payloads: DataFrame, ingested_at: Column) -> DataFrame:
    """The elements of payload arrays with their time, or the reason they have none.

    ``ingested_at`` is a literal or a column of the payloads, such as the time
    they landed: of two payloads with the same event the later one is newer.
    A payload of an unknown feed, or one that is not a JSON array, is rejected
    as a whole and stays whole in ``record``.
    """
    # Behind generators, or each column read later would parse the text again.
    arrays = payloads.select(
        "endpoint",
        "value",
        ingested_at.alias("ingested_at"),
        F.explode(F.array(F.from_json("value", "array<string>"))).alias("elements"),
    )
    refused = F.when(~F.col("endpoint").isin(*FEED_TIME_KEYS), F.lit("unknown feed")).when(
        F.col("elements").isNull(), F.lit("no JSON array")
    )
    elements = arrays.withColumn("refused", refused).select(
        "endpoint",
        "ingested_at",
        "refused",
        F.explode(F.when(F.col("refused").isNull(), F.col("elements")).otherwise(F.array("value"))).alias("record"),
    )
    time_text = F.lit(None).cast("string")
    for key in sorted(set(FEED_TIME_KEYS.values())):
        feeds = [endpoint for endpoint, k in FEED_TIME_KEYS.items() if k == key]
        found = F.get_json_object("record", f"$.{key}")
        time_text = F.when(F.col("endpoint").isin(*feeds), found).otherwise(time_text)
    time = F.when(F.col("refused").isNull(), parse_iso(time_text))
    timed = elements.withColumn("event_time", F.explode(F.array(time)))
    reason = F.coalesce("refused", F.when(F.col("event_time").isNull(), F.lit("no time")))
    return timed.select("endpoint", "event_time", "record", "ingested_at", reason.alias(REASON))


def payload_events(payloads: DataFrame, ingested_at: Column) -> DataFrame:
    """Payload arrays to event envelopes, without what is rejected."""
    return valid(parse_payloads(payloads, ingested_at))
