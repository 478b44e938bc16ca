"""Jobs over a folder layout."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow import paths, versions
from obsflow.operators.latest import merge_latest
from obsflow.operators.rejects import REASON, rejected, valid
from obsflow.plans import gold, silver
from obsflow.schemas import EVENT_ENVELOPE, FLARE, OBSERVATION, RAW_OBSERVATION
from obsflow.sinks.catalog import publish, register_view
from obsflow.sinks.files import recover, replace_parquet, replace_partitions, staged, write_parquet
from obsflow.sinks.jdbc import write_database
from obsflow.sources.archive_csv import read_export, read_export_in_parts
from obsflow.sources.feeds import LANDED, parse_payloads, read_payloads, stream_payloads
from obsflow.sources.reports import parse_reports, read_reports, report_counts, report_events, report_rejects
from obsflow.sources.tables import catalog_table, has_rows, read_or_empty, read_parquet, read_required

EVENT_KEY = ("endpoint", "event_time")
EVENT_PARTITION = ("endpoint", "event_date")
_DATED_ENVELOPE = T.StructType([*EVENT_ENVELOPE.fields, T.StructField("event_date", T.DateType())])
_CHANGED = T.StructType([T.StructField("event_date", T.DateType())])

FLARE_PARTITION = ("status", "flare_date")
_TYPED_FLARE = T.StructType(
    [*FLARE.fields, T.StructField(REASON, T.StringType()), T.StructField("flare_date", T.DateType())]
)
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"

_CHANGE = T.StructType([*FLARE.fields, T.StructField("change", T.IntegerType())])

#: Folders by hash of obs_id of contaminated_obs, the unit that a refresh rewrites. More for larger tables.
GOLD_BUCKETS = 64

GOLD = ("contaminated_obs", "narrow_band_targets", "instrument_calibration", "sky_coverage")


@dataclass(frozen=True)
class Layout:
    """Where the tables live below one root."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/observations"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/events"

    @property
    def report_rejects(self) -> str:
        return f"{self.root}/bronze/report_rejects"

    @property
    def observations_all(self) -> str:
        """Versions of valid and rejected rows, one folder each, written in one pass."""
        return f"{self.root}/silver/observations"

    @property
    def observations(self) -> str:
        """Where valid rows lie in a table from before it had versions (``silver_observations`` finds either)."""
        return f"{self.observations_all}/status=valid"

    @property
    def report_counts(self) -> str:
        return f"{self.root}/bronze/report_counts"

    @property
    def feed_rejects(self) -> str:
        return f"{self.root}/bronze/feed_rejects"

    @property
    def changed_days(self) -> str:
        """The days of bronze that were merged into since silver flares were last refreshed."""
        return f"{self.root}/bronze/changed_days"

    @property
    def landed(self) -> str:
        """The checkpoint that says which landed files are in bronze."""
        return f"{self.root}/bronze/landed_files"

    @property
    def flares_all(self) -> str:
        """Valid and rejected rows by day of their bronze event, written in one pass."""
        return f"{self.root}/silver/flares"

    @property
    def flares(self) -> str:
        return f"{self.flares_all}/status=valid"

    @property
    def flare_rejects(self) -> str:
        return f"{self.flares_all}/status=rejected"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    @property
    def flare_changes(self) -> str:
        """The flares that each refresh of silver flares added and withdrew, by its version."""
        return f"{self.root}/silver/flare_changes"

    @property
    def contaminated_basis(self) -> str:
        """The version of the flare changes that contaminated_obs has taken in, and its number of buckets."""
        return f"{self.root}/gold/contaminated_obs_basis"

    def work(self, name: str) -> str:
        """A fresh path for a table that one job run needs."""
        return f"{self.root}/work/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def _worked(spark: SparkSession, layout: Layout, name: str) -> Iterator[str]:
    """A path for a table that one job run needs, deleted however the run ends."""
    path = layout.work(name)
    try:
        yield path
    finally:
        paths.delete(spark, path)


def run_time() -> Column:
    """The time a run started: one literal for all of its rows."""
    return F.lit(datetime.now(timezone.utc)).cast("timestamp")


def load_raw(
    spark: SparkSession, layout: Layout, csv: str, embedded_newlines: bool = True, in_parts: bool = False
) -> int:
    """B1: load the export once; nothing happens without a file or with rows in place.

    With ``in_parts`` many tasks read each file, line breaks inside quotes or not.
    """
    if not paths.path_exists(spark, csv):
        return 0
    if has_rows(read_or_empty(spark, layout.raw, RAW_OBSERVATION)):
        return 0
    export = read_export_in_parts(spark, csv) if in_parts else read_export(spark, csv, embedded_newlines=embedded_newlines)
    return write_parquet(export, layout.raw)


def read_events(spark: SparkSession, layout: Layout) -> DataFrame:
    """The bronze table."""
    return read_or_empty(spark, layout.bronze, _DATED_ENVELOPE)


def merge_events(
    spark: SparkSession, layout: Layout, events: DataFrame, keys: Sequence[str] = EVENT_KEY
) -> int:
    """U1 + W1 + K2: merge events into bronze; gives the rows of the rewritten days.

    ``keys`` say which events are versions of one another. With the default,
    events of one feed at the same instant are; add ``record`` to keep them all.

    The events are written once at first, so that their parsing is not repeated
    by the steps that follow; without any, bronze stays as it is. Only the days
    that occur in them are read and rewritten. A day is noted as changed before
    it is, so that ``refresh_changed_flares`` finds it even if the run breaks off.
    """
    dated = events.withColumn("event_date", F.to_date("event_time"))
    with _worked(spark, layout, "events") as work:
        if not write_parquet(dated, work):
            return 0
        new = spark.read.schema(_DATED_ENVELOPE).parquet(work)
        days = new.select(*EVENT_PARTITION).distinct()
        days.select("event_date").distinct().coalesce(1).write.mode("append").parquet(layout.changed_days)
        existing = _of_days(read_events(spark, layout), days, EVENT_PARTITION)
        merged = merge_latest(
            existing, new, (*keys, "event_date"), "ingested_at", ties=("record",)
        )
        return replace_partitions(merged, layout.bronze, EVENT_PARTITION)


def _of_days(events: DataFrame, days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The events of some days: their range prunes the scan, their list, no longer than
    the calendar times the handful of feeds, is broadcast."""
    first, last = days.agg(F.min("event_date"), F.max("event_date")).first()
    in_range = events.filter(F.col("event_date").between(F.lit(first), F.lit(last)))
    return in_range.join(F.broadcast(days.select(*keys).distinct()), list(keys), "left_semi")


def backfill(
    spark: SparkSession,
    layout: Layout,
    folder: str,
    first_year: int = 2010,
    last_year: int = 2017,
    ingested_at: Column | None = None,
) -> int:
    """B2: archive reports of a span of years into bronze; no parsed line, no write there.

    The rejected lines of these years and the numbers of parsed and skipped
    lines are kept beside it; those of other years stay. The reports are parsed
    once.
    """
    at = run_time() if ingested_at is None else ingested_at
    with _worked(spark, layout, "report_lines") as work:
        if not write_parquet(parse_reports(read_reports(spark, folder, first_year, last_year)), work):
            return 0
        parsed = spark.read.parquet(work)
        replace_partitions(report_rejects(parsed, at), layout.report_rejects, ["year"])
        replace_partitions(report_counts(parsed), layout.report_counts, ["year"])
        return merge_events(spark, layout, report_events(parsed, at))


def ingest_live(
    spark: SparkSession, layout: Layout, landing: str, ingested_at: Column | None = None
) -> int:
    """All landed feed payloads into bronze; of two versions the one that landed last wins."""
    return merge_payloads(spark, layout, read_payloads(spark, landing), ingested_at)


def merge_payloads(
    spark: SparkSession, layout: Layout, payloads: DataFrame, ingested_at: Column | None = None
) -> int:
    """Payloads into bronze, and what is rejected of them beside it.

    Without ``ingested_at`` events are as old as their file, or as this run
    where the payloads name no file. Payloads that come again change nothing.
    """
    if ingested_at is None:
        ingested_at = F.col(LANDED) if LANDED in payloads.columns else run_time()
    with _worked(spark, layout, "payloads") as work:
        if not write_parquet(parse_payloads(payloads, ingested_at), work):
            return 0
        parsed = spark.read.parquet(work)
        refused = rejected(parsed).drop("event_time").withColumn("landed_on", F.to_date("ingested_at"))
        days = refused.select(F.col("landed_on").alias("event_date")).distinct()
        if not days.isEmpty():
            kept = read_or_empty(spark, layout.feed_rejects, refused.schema)
            same_days = _of_days(kept.withColumn("event_date", F.col("landed_on")), days, ["event_date"])
            both = same_days.select(refused.columns).unionByName(refused).distinct()
            replace_partitions(both, layout.feed_rejects, ["landed_on"])
        return merge_events(spark, layout, valid(parsed))


def ingest_landed(spark: SparkSession, layout: Layout, landing: str) -> None:
    """B3 for the files that landed since the last call; each is read once."""

    def merge(batch: DataFrame, _: int) -> None:
        merge_payloads(batch.sparkSession, layout, batch)

    (
        stream_payloads(spark, landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", layout.landed)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def refresh_observations(spark: SparkSession, layout: Layout, raw: DataFrame | None = None) -> int:
    """Silver observations and their rejects, from the raw table or a database scan."""
    if raw is None:
        raw = read_or_empty(spark, layout.raw, RAW_OBSERVATION)
    # From here on contaminated_obs has to be computed in full once.
    paths.delete(spark, layout.contaminated_basis)
    status = F.when(F.col(REASON).isNull(), F.lit("valid")).otherwise(F.lit("rejected"))
    typed = silver.typed_observations(raw).withColumn("status", status)
    # In time order within a file, so that a scan for a time range skips row groups.
    ordered = typed.sortWithinPartitions("status", "t_start")
    return versions.write_version(ordered, layout.observations_all, by=["status"])


def refresh_flares(
    spark: SparkSession, layout: Layout, class_keys: Sequence[str] = ("xray_class",)
) -> int:
    """Silver flares and their rejects, from all of bronze."""
    recover(spark, layout.flares_all)
    with _worked(spark, layout, "flares") as work:
        write_parquet(_dated_flares(read_events(spark, layout), class_keys), work)
        made = _judged_flares(spark.read.schema(_TYPED_FLARE).parquet(work))
        before = read_or_empty(spark, layout.flares, FLARE)
        _note_changes(spark, layout, before.select(FLARE.fieldNames()), valid_flares(made))
        replace_parquet(made.hint("rebalance", *FLARE_PARTITION), layout.flares_all, by=FLARE_PARTITION)
    paths.delete(spark, layout.changed_days)
    return silver_flares(spark, layout).count()


def refresh_changed_flares(
    spark: SparkSession, layout: Layout, class_keys: Sequence[str] = ("xray_class",)
) -> int:
    """B5 after a merge: the rows of refresh_flares, with only the changed days parsed and written.

    Versions of a flare meet on one day, since an event's time is the start of
    its flare. Where a record names a start on another day the flare has no
    date, and all of bronze is read again.
    """
    recover(spark, layout.flares_all)
    undated = paths.path_exists(spark, f"{layout.flares}/flare_date={_NO_DATE}")
    if undated or not paths.path_exists(spark, layout.flares_all):
        return refresh_flares(spark, layout, class_keys)
    if paths.path_exists(spark, layout.changed_days):
        with _worked(spark, layout, "flares") as work:
            noted = spark.read.schema(_CHANGED).parquet(layout.changed_days).distinct()
            events = _of_days(read_events(spark, layout), noted, ["event_date"])
            write_parquet(_dated_flares(events, class_keys), work)
            typed = spark.read.schema(_TYPED_FLARE).parquet(work)
            if not typed.filter("flare_date IS NULL").isEmpty():
                return refresh_flares(spark, layout, class_keys)
            made = _judged_flares(typed)
            before = _of_days(_flares_by_day(spark, layout), noted, ["event_date"])
            _note_changes(spark, layout, before.select(FLARE.fieldNames()), valid_flares(made))
            replace_partitions(made, layout.flares_all, FLARE_PARTITION)
            # A day that has no row of a kind any more keeps no folder of it. One row per day.
            days = {r[0] for r in noted.collect()}
            left = {tuple(r) for r in made.select(*FLARE_PARTITION).distinct().collect()}
            for status, day in ((s, d) for s in ("valid", "rejected") for d in days):
                if (status, day) not in left:
                    paths.delete(spark, f"{layout.flares_all}/status={status}/flare_date={day}")
        spark.catalog.refreshByPath(layout.flares_all)
        paths.delete(spark, layout.changed_days)
    return silver_flares(spark, layout).count()


def valid_flares(judged: DataFrame) -> DataFrame:
    return judged.filter("status = 'valid'").select(FLARE.fieldNames())


def _flares_by_day(spark: SparkSession, layout: Layout) -> DataFrame:
    """Silver flares with the day of their folder as event_date."""
    dated = T.StructType([*FLARE.fields, T.StructField("flare_date", T.DateType())])
    return read_or_empty(spark, layout.flares, dated).withColumnRenamed("flare_date", "event_date")


def _note_changes(spark: SparkSession, layout: Layout, before: DataFrame, after: DataFrame) -> None:
    """Append what tells two versions of some flares apart to the change feed.

    The feed is written before silver is, so a run that breaks off in between
    notes the same changes again; who reads the feed takes a change in twice
    without harm.
    """
    sides = before.withColumn("change", F.lit(-1)).unionByName(after.withColumn("change", F.lit(1)))
    net = sides.groupBy(*FLARE.fieldNames()).agg(F.sum("change").cast("int").alias("change")).filter("change <> 0")
    version = last_change(spark, layout) + 1
    write_parquet(net.select(_CHANGE.fieldNames()), f"{layout.flare_changes}/version={version}")


def last_change(spark: SparkSession, layout: Layout) -> int:
    """The newest version of the change feed, 0 without any."""
    folders = paths.siblings(spark, layout.flare_changes, "/version=*")
    return max((int(f.rpartition("=")[2]) for f in folders if paths.path_exists(spark, f"{f}/_SUCCESS")), default=0)


def flare_changes(spark: SparkSession, layout: Layout, after: int, to: int) -> DataFrame:
    """The changes of the versions behind ``after`` up to ``to``; only their folders are read."""
    folders = [f"{layout.flare_changes}/version={v}" for v in range(after + 1, to + 1)]
    return spark.read.schema(_CHANGE).parquet(*folders)


def _dated_flares(events: DataFrame, class_keys: Sequence[str]) -> DataFrame:
    """Typed flares with the day of their event, null for valid ones that start on another day."""
    typed = silver.typed_flares(events, class_keys, keep=["event_date"])
    dated = F.col(REASON).isNotNull() | (F.to_date("event_start") == F.col("event_date"))
    return typed.withColumn("flare_date", F.when(dated, F.col("event_date"))).drop("event_date")


def _judged_flares(typed: DataFrame) -> DataFrame:
    """The newest valid versions and the rejected rows, marked as such."""
    newest = silver.newest_flares(valid(typed)).withColumn(REASON, F.lit(None).cast("string"))
    kinds = newest.withColumn("status", F.lit("valid")), rejected(typed).withColumn("status", F.lit("rejected"))
    return kinds[0].unionByName(kinds[1])


def silver_observations(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_or_empty(spark, _observations_of(spark, layout, "valid"), OBSERVATION)


def observation_rejects(spark: SparkSession, layout: Layout) -> DataFrame:
    """K7: the rows that refresh_observations rejected, with the reason."""
    rejects = T.StructType([*OBSERVATION.fields, T.StructField(REASON, T.StringType())])
    return read_or_empty(spark, _observations_of(spark, layout, "rejected"), rejects)


def _observations_of(spark: SparkSession, layout: Layout, status: str) -> str:
    """The folder of valid or rejected rows in the current version."""
    folder = versions.resolve(spark, layout.observations_all)
    if folder is None:
        raise FileNotFoundError(f"{layout.observations_all} has not been written yet")
    return f"{folder}/status={status}"


def silver_flares(spark: SparkSession, layout: Layout) -> DataFrame:
    read_required(spark, layout.flares_all, FLARE)
    return read_or_empty(spark, layout.flares, FLARE).select(FLARE.fieldNames())


def scored_flares(spark: SparkSession, layout: Layout) -> DataFrame:
    return gold.scored_flares(silver_flares(spark, layout))


def gold_table(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """One gold table, computed from silver."""
    observations = silver_observations(spark, layout)
    if name == "contaminated_obs":
        return gold.contaminated_obs(observations, scored_flares(spark, layout))
    build: dict[str, Callable[[DataFrame], DataFrame]] = {
        "narrow_band_targets": gold.narrow_band_targets,
        "instrument_calibration": gold.instrument_calibration,
        "sky_coverage": gold.sky_coverage,
    }
    return build[name](observations)


def refresh_gold(
    spark: SparkSession, layout: Layout, name: str, database: str = "gold", buckets: int = GOLD_BUCKETS
) -> int:
    """Compute a gold table and publish it in the catalog.

    contaminated_obs lies in ``buckets`` folders by hash of obs_id, each row with
    the start of its flare, so that ``refresh_contaminated`` can go on from it.
    """
    if name != "contaminated_obs":
        return publish(gold_table(spark, layout, name), f"{database}.{name}", layout.gold(name))
    # Changes that come while this runs are taken in twice, which does no harm.
    version = last_change(spark, layout)
    made = gold.worst_flares(silver_observations(spark, layout), scored_flares(spark, layout))
    path = layout.gold(name)
    rows = replace_parquet(_bucketed(made, buckets).hint("rebalance", _BUCKET), path, by=[_BUCKET])
    register_view(spark, f"{database}.{name}", path, gold.CONTAMINATED)
    _remember(spark, layout, version, buckets)
    return rows


_BUCKET = "obs_bucket"
_BASIS = T.StructType([T.StructField("version", T.IntegerType()), T.StructField("buckets", T.IntegerType())])
_STORED = T.StructType(
    [*(f for f in OBSERVATION.fields if f.name in ("obs_id", "t_start", "t_end")), T.StructField("flare_class", T.StringType()),
     T.StructField("risk_score", T.IntegerType()), T.StructField("flare_start", T.TimestampType()),
     T.StructField(_BUCKET, T.IntegerType())]
)


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn(_BUCKET, F.pmod(F.xxhash64("obs_id"), F.lit(buckets)).cast("int"))


def _remember(spark: SparkSession, layout: Layout, version: int, buckets: int) -> None:
    state = spark.createDataFrame([(version, buckets)], _BASIS).coalesce(1)
    replace_parquet(state, layout.contaminated_basis)


def read_gold(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """A gold table as its readers see it."""
    path = layout.gold(name)
    table = read_parquet(spark, versions.resolve(spark, path) or path)
    return table.select(*gold.CONTAMINATED) if _BUCKET in table.columns else table


def refresh_contaminated(spark: SparkSession, layout: Layout, database: str = "gold") -> int:
    """B6 after new flares: the rows of refresh_gold, from what changed since the table was last refreshed.

    The change feed of silver flares says which flares came and went. A flare
    that came competes with the row at hand; only observations that lose their
    worst flare are computed again (``gold.maintained``). Of the table, the
    buckets with a changed row are read and replaced. What was taken in is
    noted last, so a run that broke off is made up for by the next one.
    """
    name = "contaminated_obs"
    path = layout.gold(name)
    for target in (path, layout.contaminated_basis):
        recover(spark, target)
    newest = last_change(spark, layout)
    basis = read_or_empty(spark, layout.contaminated_basis, _BASIS)
    known = basis.dropna().first()
    # Without a feed nothing says what changed.
    if not known or not newest:
        return refresh_gold(spark, layout, name, database)
    version, buckets = known
    current = read_or_empty(spark, path, _STORED)
    register_view(spark, f"{database}.{name}", path, gold.CONTAMINATED)
    if newest > version:
        observations, scored = silver_observations(spark, layout), scored_flares(spark, layout)
        feed = flare_changes(spark, layout, version, newest)
        added, withdrawn = (staged(c, "changes") for c in gold.changes(feed, scored))
        losing = staged(gold.losing_obs(current, withdrawn), "losing")
        changed = staged(_bucketed(gold.maintained(current.drop(_BUCKET), observations, scored, added, losing), buckets), "changed")
        gone = _bucketed(losing, buckets).unionByName(changed.select("obs_id", _BUCKET)).distinct()
        touched = [r[0] for r in gone.select(_BUCKET).distinct().collect()]
        if touched:
            kept = current.filter(F.col(_BUCKET).isin(touched)).join(gone.select("obs_id"), "obs_id", "left_anti")
            left = {r[0] for r in changed.select(_BUCKET).union(kept.select(_BUCKET)).distinct().collect()}
            replace_partitions(kept.unionByName(changed), path, [_BUCKET])
            for bucket in set(touched) - left:
                paths.delete(spark, f"{path}/{_BUCKET}={bucket}")
            spark.catalog.refreshByPath(path)
        _remember(spark, layout, newest, buckets)
    return read_or_empty(spark, path, _STORED).count()


def register_silver(spark: SparkSession, layout: Layout, database: str = "silver") -> None:
    """The silver tables by name; called again, observations follow their newest version."""
    catalog_table(spark, f"{database}.observations", _observations_of(spark, layout, "valid"))
    catalog_table(spark, f"{database}.flares", layout.flares)


def serve(spark: SparkSession, layout: Layout, name: str, dsn: str, table: str) -> int:
    """Copy a gold table into its serving table.

    The table is read from its path, which any process finds, not from the
    catalog of the one that made it.
    """
    return write_database(read_gold(spark, layout, name), dsn, table)


def refresh_all(
    spark: SparkSession,
    layout: Layout,
    reports: str,
    first_year: int = 2010,
    last_year: int = 2016,
    raw: DataFrame | None = None,
    after_gold: Callable[[str], object] | None = None,
) -> dict[str, int]:
    """Backfill, both silver tables, then every gold table.

    ``after_gold`` is called with the name of each gold table once it is
    published, which is the place for B10.
    """
    counts = {
        "events": backfill(spark, layout, reports, first_year, last_year),
        "flares": refresh_flares(spark, layout),
        "observations": refresh_observations(spark, layout, raw),
    }
    for name in GOLD:
        counts[name] = refresh_gold(spark, layout, name)
        if after_gold:
            after_gold(name)
    return counts


def refresh_incremental(
    spark: SparkSession,
    layout: Layout,
    landing: str,
    after_gold: Callable[[str], object] | None = None,
) -> dict[str, int]:
    """Newly landed payloads through bronze and silver to the contaminated observations.

    Each file is read once, only the days they touch are parsed and rewritten,
    and only observations that overlap a changed flare are computed again.
    """
    ingest_landed(spark, layout, landing)
    counts = {"flares": refresh_changed_flares(spark, layout)}
    counts["contaminated_obs"] = refresh_contaminated(spark, layout)
    if after_gold:
        after_gold("contaminated_obs")
    return counts
