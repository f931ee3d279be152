"""Whole runs: landed files to raw rows, and those to processed, curated and published datasets.

Counters of a run are taken from the datasets it has committed, not collected on the side while
tasks run: a task that is repeated because an executor was lost would be counted twice there.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.functions.dates import leading_date
from skyledger.functions.values import station_code
from skyledger.operators import curate, incremental, long_rows, observations, publish, stations, wide_rows, windows
from skyledger.operators.quality import (
    bad_stations,
    metrics_summary,
    require_some_success,
)
from skyledger.operators.validity import guarded, raising_unusable, rejected
from skyledger.schemas import (
    CLIMATE_DAILY,
    DAILY,
    PROCESSED_DATASETS,
    REQUIRED_LONG,
    REQUIRED_WIDE,
    RUN_METRICS,
    SOURCE_YEAR,
    STATION_YEAR,
    conform,
)
from skyledger.session import remove_folder, settle
from skyledger.sources import raw, tables

SOURCES = ("nws", "noaa", "meteostat")


@dataclass(frozen=True)
class Zones:
    """Where the datasets of one installation lie."""

    root: str

    def raw(self, source: str) -> str:
        return f"{self.root}/raw/{source}"

    def failures(self, source: str) -> str:
        return f"{self.root}/failures/{source}"

    @property
    def processed(self) -> str:
        return f"{self.root}/processed"

    def daily(self, source: str) -> str:
        return f"{self.processed}/{PROCESSED_DATASETS[source]}"

    def rejects(self, source: str) -> str:
        return f"{self.processed}/{source}_daily/rejects"

    def curated(self, name: str) -> str:
        return f"{self.root}/curated/{name}/parquet"

    @property
    def snapshot(self) -> str:
        return f"{self.root}/published/climate_daily"

    @property
    def observation_snapshot(self) -> str:
        return f"{self.root}/published/observations"


def check_sources(sources: list[str]) -> list[str]:
    """The distinct sources in their order; unknown ones are an error."""
    unknown = [source for source in sources if source not in SOURCES]
    if unknown:
        raise ValueError(f"unsupported sources requested: {unknown}")
    return list(dict.fromkeys(sources))


class StationError(RuntimeError):
    """Some station of a run failed, and the run was told to stop at that."""


def _record_failures(failures: DataFrame, zones: Zones, source: str, on_error: str) -> int:
    """Adds failed stations to the source's ledger and returns their number."""
    failures = settle(failures, "failures")
    failed = failures.count()
    if failed:
        tables.append_failures(failures, zones.failures(source))
        if on_error == "fail":
            raise StationError(f"{source}: {failed} stations failed, see {zones.failures(source)}")
    return failed


def _failed(manifest: DataFrame, source: str, run_date: str, start: date, end: date, message: str) -> DataFrame:
    return manifest.select(
        F.lit(run_date).alias("run_date"), F.lit(source).alias("source"),
        "noaa_station_id", "nws_station_id", "station_name", "state",
        F.lit(start).cast("string").alias("start_date"), F.lit(end).cast("string").alias("end_date"),
        F.lit("ValueError").alias("error_type"),
        F.format_string(message, F.coalesce("noaa_station_id", F.lit(""))).alias("error_message"),
    )


def land_long(
    spark: SparkSession, zones: Zones, files: str, manifest: DataFrame, start: date, end: date, run_date: str,
    on_error: str = "reject", offset: int = 0, limit: int | None = None,
) -> int:
    """Writes a run's raw long rows from by-station files; returns the number of failed stations.

    Only enabled manifest stations are landed, of these the slice asked for. A station fails if the
    files have no line of it.
    """
    manifest = stations.slice_manifest(manifest, offset, limit)
    lines = raw.read_ghcn_lines(spark, files)
    listed = manifest.filter(F.col("noaa_station_id") != "")
    found = lines.select(station_code(F.col("station_id")).alias("code")).distinct()
    absent = listed.join(found, station_code(F.col("noaa_station_id")) == F.col("code"), "left_anti")
    failed = _record_failures(
        _failed(absent, "noaa", run_date, start, end, "no station file landed for %s"), zones, "noaa", on_error
    )
    rows = long_rows.station_rows(lines, listed, start, end, run_date)
    tables.write_json_lines(rows.drop("run_date"), f"{zones.raw('noaa')}/run_date={run_date}")
    if failed:
        require_some_success(failed, raw.read_long(spark, zones.raw("noaa"), run_date).limit(1).count())
    return failed


def land_wide(
    spark: SparkSession, zones: Zones, catalog_file: str, files: str, manifest: DataFrame, start: date, end: date,
    run_date: str, on_error: str = "reject", resume: bool = True, offset: int = 0, limit: int | None = None,
) -> int:
    """Writes a run's raw wide rows from a catalogue and station-year files; returns failed stations.

    Only enabled manifest stations are landed, of these the slice asked for. Stations that have rows
    in the run already are passed over, unless ``resume`` is off; then the run and the ledger of
    failures are written anew. A station fails if it cannot be resolved, or if one of its files has
    an unreadable date: then none of its rows are written.
    """
    source = wide_rows.SOURCE
    manifest = stations.slice_manifest(manifest, offset, limit)
    if not resume:
        remove_folder(spark, zones.failures(source))
    landed = raw.optional(lambda: raw.read_wide(spark, zones.raw(source), run_date)) if resume else None
    pending = manifest if landed is None else incremental.pending_stations(manifest, landed)
    catalog = settle(stations.flatten_catalog(raw.read_catalog(spark, catalog_file)), "catalog")
    # One search serves the resolved stations and the failures.
    matched = settle(stations.match_stations(pending, catalog, start), "matched")
    resolved = settle(stations.resolved_rows(matched, catalog), "resolved")
    unresolved = stations.failure_rows(matched, start, end, run_date)

    # The files are read and parsed once; ledger, check and rows use what was parsed.
    lines = raw.read_station_years(spark, files, start, end)
    dated = settle(wide_rows.dated_rows(lines).join(
        resolved.select("meteostat_station_id").distinct(), "meteostat_station_id", "left_semi"
    ), "dated")
    unreadable = F.col("date_status") == "bad"
    bad = settle(bad_stations(dated, "meteostat_station_id", unreadable), "bad-stations")
    broken = resolved.join(bad, "meteostat_station_id", "left_semi")
    failed = _record_failures(
        unresolved.unionByName(_failed(broken, source, run_date, start, end, "unreadable date in a file of %s")),
        zones, source, on_error,
    )
    whole = dated.join(bad, "meteostat_station_id", "left_anti")
    rows = wide_rows.station_year_rows(whole, resolved, start, end, run_date)
    tables.write_json_lines(
        rows.drop("run_date"), f"{zones.raw(source)}/run_date={run_date}", "append" if resume else "overwrite"
    )
    if failed:
        require_some_success(failed, raw.read_wide(spark, zones.raw(source), run_date).limit(1).count())
    return failed


def pending_windows(
    spark: SparkSession, zones: Zones, source: str, run_date: str, manifest: DataFrame, start: date, end: date
) -> DataFrame:
    """What is still to be fetched for a run: enabled stations and the parts of each calendar year of the window of
    which no day has landed (``window_start`` to ``window_end`` is the year's part of the window)."""
    read = {"noaa": raw.read_long, "meteostat": raw.read_wide}[source]
    landed = raw.optional(lambda: read(spark, zones.raw(source), run_date))
    listed = stations.slice_manifest(manifest, 0, None).filter(F.col("noaa_station_id") != "")
    asked = windows.year_windows(listed.select("noaa_station_id", F.lit(start).alias("start_date"), F.lit(end).alias("end_date")))
    if landed is None:
        landed = spark.createDataFrame([], "noaa_station_id string, date string")
    days = landed.select("noaa_station_id", leading_date(F.col("date")).alias("day"))
    return incremental.missing_windows(asked, incremental.landed_islands(days, "noaa_station_id"), "noaa_station_id")


def process_source(
    spark: SparkSession, zones: Zones, source: str, run_date: str, manifest: DataFrame, on_error: str = "reject",
    ordered: bool = False,
) -> DataFrame:
    """Turns one source's raw rows of a run into daily rows and rejects; returns its metrics.

    ``ordered`` lays the daily rows out in published order. The curated dataset is laid out so
    in any case, and reads the daily rows whole, so the shuffle is seldom worth while here.
    """
    landed = f"{zones.raw(source)}/run_date={run_date}"
    if source == "noaa":
        raw.check_fields(spark, landed, raw.LONG_FILE, [name for name in REQUIRED_LONG if name != "run_date"])
        rows = raw.read_long(spark, zones.raw(source), run_date)
        normalized, checks = long_rows.normalize_long(rows), long_rows.CHECKS
        daily = long_rows.normalized_to_daily
    elif source == "nws":
        rows = observations.explode_features(listed_payloads(raw.read_payloads(spark, zones.raw(source), run_date), manifest))
        normalized, checks = observations.normalize_observations(rows), observations.CHECKS

        def daily(normalized: DataFrame) -> DataFrame:
            return observations.enrich_days(observations.summarize_days(normalized), manifest)
    else:
        raw.check_fields(spark, landed, raw.WIDE_FILE, [name for name in REQUIRED_WIDE if name != "run_date"])
        rows = raw.read_wide(spark, zones.raw(source), run_date)
        normalized, checks = wide_rows.normalize_wide(rows), wide_rows.CHECKS
        daily = wide_rows.normalized_to_daily

    rejects = rejected(normalized, checks).drop("run_date")
    # A run that may not have unusable rows fails while it is written, beside the rows of the run it replaces.
    strict = on_error == "fail"
    with raising_unusable():
        tables.overwrite_run(
            daily(guarded(normalized, checks) if strict else normalized),
            zones.daily(source), "ingest_run_date", run_date, ordered, staged=strict,
        )
    tables.overwrite_run(rejects, zones.rejects(source), "run_date", run_date)
    metrics = committed_metrics(spark, zones, source, run_date, rejects.schema)
    tables.write_metrics(metrics, zones.processed, source, run_date)
    return tables.read_metrics(spark, zones.processed, source, run_date)


def listed_payloads(payloads: DataFrame, manifest: DataFrame) -> DataFrame:
    """Payloads without those in the folder of a station that the manifest no longer lists."""
    placed = payloads.withColumn("station", F.regexp_extract("path", "/station=([^/]+)/", 1))
    stale = incremental.stale_stations(placed.filter(F.col("station") != ""), manifest)
    return placed.join(stale, "station", "left_anti").drop("station")


def committed_metrics(
    spark: SparkSession, zones: Zones, source: str, run_date: str, reject_schema: StructType
) -> DataFrame:
    """Counters of a run from its daily rows, which carry their number of raw rows, and its rejects."""
    daily = tables.read_table(spark, zones.daily(source), DAILY).filter(F.col("ingest_run_date") == run_date)
    rejects = spark.read.schema(reject_schema).parquet(f"{zones.rejects(source)}/run_date={run_date}")
    nothing = F.lit(0).cast("bigint")
    counts = (
        daily.agg(F.sum("obs_count").alias("valid"), F.count(F.lit(1)).alias("output"), nothing.alias("invalid"))
        .unionByName(rejects.agg(nothing.alias("valid"), nothing.alias("output"), F.count(F.lit(1)).alias("invalid")))
        .agg(*[F.coalesce(F.sum(name), nothing).alias(name) for name in ("valid", "output", "invalid")])
    )
    return conform(
        counts,
        RUN_METRICS,
        source=F.lit(source),
        run_date=F.lit(run_date),
        raw_input_rows=F.col("valid") + F.col("invalid"),
        invalid_rows_removed="invalid",
        valid_input_rows="valid",
        output_rows="output",
        rows_consolidated_by_aggregation=F.greatest(nothing, F.col("valid") - F.col("output")),
    )


def curate_sources(spark: SparkSession, zones: Zones, sources: list[str], run_date: str | None = None) -> None:
    """Unites processed sources and rolls them up to station-years and source-years.

    A source's rows replace all it had, years that the run no longer has included; sources that are not
    asked for stay. Each rollup reads what the step before has written, so nothing is computed twice.
    With several runs processed, ``run_date`` takes one of them.
    """
    daily_path, trend_path = zones.curated("climate_daily"), zones.curated("climate_trends")
    tables.read_existing(spark, zones.processed, sources, DAILY)  # an error if there is none
    for source in sources:
        frame = raw.optional(lambda: tables.read_table(spark, zones.daily(source), DAILY))
        if frame is None:
            continue
        if run_date is not None:
            frame = frame.filter(F.col("ingest_run_date") == run_date)
        tables.overwrite_source(curate.climate_daily([frame]), daily_path, source, ordered=True)
        own = tables.read_table(spark, daily_path, CLIMATE_DAILY).filter(F.col("source") == source)
        tables.overwrite_source(curate.station_years(own), trend_path, source)

    trends = tables.read_table(spark, trend_path, STATION_YEAR)
    summary = conform(curate.source_years(trends), SOURCE_YEAR)
    tables.overwrite_table(summary, zones.curated("climate_trends_source_summary"))


def publish_curated(spark: SparkSession, zones: Zones) -> DataFrame:
    """Merges the curated daily rows into the published snapshot; returns what was done."""
    daily = tables.read_table(spark, zones.curated("climate_daily"), CLIMATE_DAILY)
    return tables.publish_snapshot(spark, zones.snapshot, publish.to_documents(daily))


def publish_raw_observations(spark: SparkSession, zones: Zones, run_date: str) -> DataFrame:
    """Merges a run's single observations into a snapshot of their own, by day of observation."""
    rows = observations.explode_features(raw.read_payloads(spark, zones.raw("nws"), run_date))
    documents = observations.raw_observation_documents(rows).withColumn("day", F.substring("timestamp", 1, 10))
    return tables.publish_snapshot(spark, zones.observation_snapshot, documents, ("day",), "ingestRunDate")


def run(
    spark: SparkSession, root: str, run_date: str, manifest_path: str, sources: list[str] | None = None
) -> dict[str, DataFrame]:
    """Processes, curates and publishes one run; returns its metrics summary and publish counts."""
    zones = Zones(root)
    manifest = raw.read_manifest(spark, manifest_path)
    sources = check_sources(sources or list(SOURCES))
    metrics = [process_source(spark, zones, source, run_date, manifest) for source in sources]
    curate_sources(spark, zones, sources, run_date)
    return {"metrics": metrics_summary(curate.unite(metrics)), "published": publish_curated(spark, zones)}
