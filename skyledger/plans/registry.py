"""Registered queries: every operator on inputs derived from the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import dates, display, values
from skyledger.operators import (
    curate,
    incremental,
    intervals,
    long_rows,
    nearest,
    observations,
    publish,
    quality,
    rollup_view,
    stations,
    wide_rows,
    windows,
)
from skyledger.operators.validity import REASON, accepted, guarded, rejected
from skyledger.plans import inputs
from skyledger.plans.inputs import RUN_DATE
from skyledger.schemas import CATALOG, CLIMATE_DAILY
from skyledger.session import scratch_dir, settle
from skyledger.sources import raw, tables
from skyledger.streaming import closing, landing

Query = Callable[[SparkSession, str], DataFrame]

LINES_START, LINES_END = date(1996, 1, 1), date(2000, 12, 31)
WINDOW_START, WINDOW_END = date(2014, 1, 1), date(2023, 12, 31)
TREND_YEAR = 1998
SAMPLE_DAY = "2024-01-15"
LOOKUP_STATION = "M7"
EARLIER_RUN_UNTIL = "2024-01-16"

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Landed text

@query
def ghcn_line_fields(spark: SparkSession, sf: str) -> DataFrame:
    """By-station lines, short and long ones among them, split into their eight fields."""
    return raw.split_ghcn_lines(inputs.ghcn_text(spark, sf))


@query
def stated_fields(spark: SparkSession, sf: str) -> DataFrame:
    """The required fields that some landed line states, of lines that are in part broken."""
    return raw.stated_fields(inputs.event_lines(spark, sf), ["event_id", "kind", "value", "station_name"])


@query
def station_year_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Whole station-year files of three layouts, taken apart by their first lines."""
    return raw.split_station_years(inputs.station_year_files(spark, sf))


@query
def manifest_file(spark: SparkSession, sf: str) -> DataFrame:
    """A station manifest written as CSV and read back by the names of its header."""
    path = f"{scratch_dir(spark, 'manifest-file')}/manifest"
    rows = inputs.manifest(spark, sf).drop("source_api")
    rows.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return raw.read_manifest(spark, path).select(
        "noaa_station_id", "station_name", "state", "country", "ingest_enabled", "priority_rank", "latitude", "longitude",
        "nws_station_id", "source_api",
    )


@query
def landed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows landed as JSON lines of two runs, broken lines among them: those of one run, read back."""
    root = f"{scratch_dir(spark, 'landed-lines')}/noaa"
    rows = inputs.raw_long(spark, sf)
    for run_date in (RUN_DATE, "2024-03-01"):
        tables.write_json_lines(rows.drop("run_date"), f"{root}/run_date={run_date}")
    broken = inputs.event_lines(spark, sf).filter(F.substring("value", 1, 18) == '{"station_name": {')
    broken.write.mode("append").text(f"{root}/run_date={RUN_DATE}")
    return raw.read_long(spark, root, RUN_DATE, malformed=True).select(
        "run_date", "noaa_station_id", "station_name", "date", "datatype", "value", "malformed"
    )


@query
def guarded_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily rows of a run in which an unusable row would be an error, after those were set aside."""
    rows = long_rows.normalize_long(inputs.raw_long(spark, sf))
    return long_rows.normalized_to_daily(guarded(accepted(rows, long_rows.CHECKS), long_rows.CHECKS))


# Shared steps

def long_daily(spark: SparkSession, sf: str) -> DataFrame:
    return long_rows.long_to_daily(inputs.raw_long(spark, sf))


def obs_daily(spark: SparkSession, sf: str) -> DataFrame:
    return observations.observations_to_daily(inputs.observations(spark, sf), inputs.manifest(spark, sf))


def unified(spark: SparkSession, sf: str) -> DataFrame:
    frames = [long_daily(spark, sf), obs_daily(spark, sf), wide_rows.wide_to_daily(inputs.raw_wide(spark, sf))]
    return curate.climate_daily(frames)


def flat_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return stations.flatten_catalog(inputs.catalog(spark, sf).select("position", *CATALOG))


def settled_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The catalogue as a table: matching stations reads it once per level of its search."""
    return settle(flat_catalog(spark, sf), "catalog")


def normalized_observations(spark: SparkSession, sf: str) -> DataFrame:
    return observations.normalize_observations(inputs.observations(spark, sf))


# Long rows

@query
def ghcn_value_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return long_rows.normalize_ghcn(inputs.ghcn_lines(spark, sf))


@query
def ghcn_station_rows(spark: SparkSession, sf: str) -> DataFrame:
    return long_rows.station_rows(
        inputs.ghcn_lines(spark, sf), inputs.manifest(spark, sf), LINES_START, LINES_END, RUN_DATE
    )


@query
def result_page_rows(spark: SparkSession, sf: str) -> DataFrame:
    return long_rows.page_rows(
        inputs.result_pages(spark, sf), inputs.manifest(spark, sf), date(1995, 1, 1), LINES_END, RUN_DATE
    )


@query
def long_rejects(spark: SparkSession, sf: str) -> DataFrame:
    bad = rejected(long_rows.normalize_long(inputs.raw_long(spark, sf)), long_rows.CHECKS)
    return bad.groupBy(REASON).agg(F.count(F.lit(1)).alias("rows"))


@query
def long_to_wide_daily(spark: SparkSession, sf: str) -> DataFrame:
    return long_daily(spark, sf)


# Intraday observations

@query
def local_day(spark: SparkSession, sf: str) -> DataFrame:
    events = inputs.table(spark, sf, "events")
    day = F.to_date(dates.local_time_of_utc(F.col("ts")))
    return events.groupBy("user_id", day.alias("day")).agg(F.count(F.lit(1)).alias("rows"))


@query
def obs_daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    days = observations.summarize_days(normalized_observations(spark, sf))
    return days.select(
        "*", F.col("position.lat").alias("latitude"), F.col("position.lon").alias("longitude")
    ).drop("position")


@query
def obs_daily_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return obs_daily(spark, sf)


@query
def explode_features(spark: SparkSession, sf: str) -> DataFrame:
    exploded = observations.explode_features(inputs.payloads(spark, sf))
    return exploded.select(
        "run_date", "feature_id", "stationId",
        F.col("temperature.value").alias("temperature"),
        F.get("geometry.coordinates", F.lit(1)).alias("latitude"),
        F.get("geometry.coordinates", F.lit(0)).alias("longitude"),
    )


@query
def path_lineage(spark: SparkSession, sf: str) -> DataFrame:
    paths = inputs.payloads(spark, sf).select("path")
    return paths.groupBy(observations.run_date_of_path(F.col("path")).alias("run_date")).agg(
        F.count(F.lit(1)).alias("files")
    )


@query
def raw_observation_docs(spark: SparkSession, sf: str) -> DataFrame:
    documents = observations.raw_observation_documents(
        observations.explode_features(inputs.payloads(spark, sf))
    )
    return documents.select(
        "_id", "source", "dataLevel", "ingestRunDate", "timestamp", "stationId", "station", "stationName",
        "textDescription",
        F.col("properties.temperature.value").alias("temperature"),
        F.get("geometry.coordinates", F.lit(0)).alias("longitude"),
    )


@query
def observation_samples(spark: SparkSession, sf: str) -> DataFrame:
    return observations.observation_samples(inputs.observations(spark, sf), 10)


# Wide rows

@query
def wide_daily(spark: SparkSession, sf: str) -> DataFrame:
    return wide_rows.wide_to_daily(inputs.raw_wide(spark, sf))


@query
def flexible_dates(spark: SparkSession, sf: str) -> DataFrame:
    return wide_rows.dated_rows(inputs.station_year_lines(spark, sf)).select(
        "meteostat_station_id", "observed_on", "date_status"
    )


@query
def measure_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    lines = inputs.station_year_lines(spark, sf)
    return lines.select(
        "meteostat_station_id",
        *[values.number(F.col(name)).alias(name) for name in ("temp", "tmin", "tmax", "prcp", "snwd", "wspd")],
    )


@query
def catalog_names(spark: SparkSession, sf: str) -> DataFrame:
    return flat_catalog(spark, sf).select("id", "name", "country", "region", "national", "icao", "daily_start", "daily_end")


@query
def station_all_or_nothing(spark: SparkSession, sf: str) -> DataFrame:
    rows = wide_rows.dated_rows(inputs.station_year_lines(spark, sf))
    kept = quality.all_or_nothing(rows, "meteostat_station_id", F.col("date_status") == "bad")
    return kept.filter(F.col("date_status") == "ok").select("meteostat_station_id", "observed_on", "temp")


@query
def station_year_rows(spark: SparkSession, sf: str) -> DataFrame:
    resolved = stations.resolve_stations(inputs.manifest(spark, sf), settled_catalog(spark, sf), WINDOW_START)
    return wide_rows.station_year_rows(
        inputs.station_year_lines(spark, sf), resolved, LINES_START, LINES_END, RUN_DATE
    )


# Union and rollups

@query
def unified_daily(spark: SparkSession, sf: str) -> DataFrame:
    return unified(spark, sf)


@query
def yearly_station(spark: SparkSession, sf: str) -> DataFrame:
    return curate.station_years(unified(spark, sf))


@query
def yearly_source(spark: SparkSession, sf: str) -> DataFrame:
    return curate.source_years(yearly_station(spark, sf))


@query
def counts_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return curate.counts_by_source(unified(spark, sf))


@query
def stored_extent(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows of which days each partition of the stored daily rows has, read from the files' footers."""
    path = f"{scratch_dir(spark, 'stored-extent')}/daily"
    tables.overwrite_partitions(unified(spark, sf), path, "source", "year")
    return curate.extent_by_year(tables.read_by_footers(spark, path, CLIMATE_DAILY))


@query
def warmest_stations(spark: SparkSession, sf: str) -> DataFrame:
    return curate.warmest_stations(unified(spark, sf), TREND_YEAR)


@query
def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    return curate.sample_rows(unified(spark, sf), "noaa", SAMPLE_DAY)


@query
def trend_sorted_top(spark: SparkSession, sf: str) -> DataFrame:
    return curate.trend_order(yearly_station(spark, sf))


# Accounting and checks

@query
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return curate.unite([
        quality.run_metrics(
            long_rows.normalize_long(inputs.raw_long(spark, sf)), long_rows.CHECKS, "noaa", RUN_DATE,
            long_rows.DAILY_KEYS,
        ),
        quality.run_metrics(
            normalized_observations(spark, sf), observations.CHECKS, "nws", RUN_DATE, observations.DAY_KEYS
        ),
        quality.run_metrics(
            wide_rows.normalize_wide(inputs.raw_wide(spark, sf)), wide_rows.CHECKS, "meteostat", RUN_DATE
        ),
    ])


@query
def metrics_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.metrics_summary(run_metrics(spark, sf))


@query
def raw_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.raw_counts(
        {"noaa": inputs.raw_long(spark, sf), "meteostat": inputs.raw_wide(spark, sf)},
        inputs.payloads(spark, sf),
        unified(spark, sf),
    )


@query
def retrieved_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Per source, rows until mid-January as the earlier count and all rows as the later one."""
    daily = unified(spark, sf)
    counts = daily.groupBy("source").agg(
        F.count_if(F.col("date") < F.lit(EARLIER_RUN_UNTIL).cast("date")).alias("before"),
        F.count(F.lit(1)).alias("after"),
    )
    return counts.withColumn(
        "retrieved", quality.newly_retrieved(F.col("source"), F.col("before"), F.col("after"))
    )


@query
def contract_checks(spark: SparkSession, sf: str) -> DataFrame:
    return quality.contract_checks(unified(spark, sf))


@query
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(unified(spark, sf))


@query
def format_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.table(spark, sf, "orders")
    source = inputs.choose(
        F.col("o_orderstatus"), {"O": "noaa", "F": "nws", "P": "meteostat"}, "other"
    )
    groups = orders.groupBy("o_custkey", source.alias("source")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.floor("o_totalprice")).alias("amount"),
        F.min("o_orderdate").alias("started"),
    )
    return groups.select(
        "o_custkey",
        display.source_name(F.col("source")).alias("source_name"),
        display.count_text(F.col("amount")).alias("amount_text"),
        display.duration_text(F.col("amount") / F.lit(16.0)).alias("duration"),
        display.timestamp_text(F.col("started")).alias("started"),
        values.whole_number(F.when(F.col("n") > 1, F.col("n").cast("string")).otherwise(F.lit(""))).alias("repeats"),
    )


@query
def source_list(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's requested sources as trimmed, distinct list, and the unsupported among them."""
    segment = inputs.choose(
        F.col("c_mktsegment"),
        {"BUILDING": "nws, noaa,nws", "MACHINERY": " meteostat ,,noaa", "HOUSEHOLD": "noaa,radar, noaa"},
        "",
    )
    requested = inputs.text(segment, ",", F.when(F.col("c_acctbal") < 0, F.lit("sonde")).otherwise(F.lit("nws ")))
    listed = display.listed(requested)
    customers = inputs.table(spark, sf, "customer")
    return customers.select(
        "c_custkey",
        F.array_join(listed, "|").alias("sources"),
        F.array_join(display.unsupported(listed), "|").alias("unsupported"),
    )


# Windows

@query
def trailing_window(spark: SparkSession, sf: str) -> DataFrame:
    ends = inputs.table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("end_date")
    )
    return windows.trailing_windows(ends)


@query
def year_windows(spark: SparkSession, sf: str) -> DataFrame:
    ranges = inputs.table(spark, sf, "orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("start_date"),
        F.date_add(F.to_date("o_orderdate"), F.floor(F.col("o_totalprice") / 300).cast("int") - 100).alias("end_date"),
    )
    return windows.year_windows(ranges)


@query
def interval_predicates(spark: SparkSession, sf: str) -> DataFrame:
    bounds = F.col("daily_start"), F.col("daily_end")
    first, last = F.lit(WINDOW_START), F.lit(date(2024, 6, 30))
    return flat_catalog(spark, sf).select(
        "id",
        dates.covers_day(*bounds, first).alias("covers_start"),
        dates.covers_range(*bounds, first, last).alias("covers_window"),
        dates.overlaps_range(*bounds, first, last).alias("overlaps_window"),
    )


# Stations

@query
def manifest_slice(spark: SparkSession, sf: str) -> DataFrame:
    size = 50
    offset = stations.batch_offset(2, size)
    return stations.slice_manifest(inputs.manifest(spark, sf), offset, size).select(
        "noaa_station_id", "ingest_enabled", "priority_rank", "ordinal"
    )


@query
def nearest_station(spark: SparkSession, sf: str) -> DataFrame:
    latitude, longitude = stations.query_place(*[
        F.col(name)
        for name in ("latitude", "longitude", "meteostat_query_latitude", "meteostat_query_longitude")
    ])
    places = inputs.manifest(spark, sf).select(
        latitude.alias("query_latitude"), longitude.alias("query_longitude"), "country", "state"
    ).filter(F.col("query_latitude").isNotNull() & F.col("query_longitude").isNotNull())
    catalog = settled_catalog(spark, sf).filter(
        dates.covers_day(F.col("daily_start"), F.col("daily_end"), F.lit(WINDOW_START))
    )
    return nearest.nearest_station(places, catalog).withColumn("km", F.round("km", 2))


@query
def station_resolve(spark: SparkSession, sf: str) -> DataFrame:
    resolved = stations.resolve_stations(inputs.manifest(spark, sf), settled_catalog(spark, sf), WINDOW_START)
    return resolved.select(
        "noaa_station_id", "meteostat_match_type", "meteostat_station_distance_km",
        "meteostat_station_id", "meteostat_station_name", "meteostat_station_latitude",
        "meteostat_station_longitude", "meteostat_station_elevation_m",
    )


@query
def resolve_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return stations.resolution_failures(
        inputs.manifest(spark, sf), settled_catalog(spark, sf), WINDOW_START, WINDOW_END, RUN_DATE
    )


# Continuing earlier runs

@query
def resume_anti(spark: SparkSession, sf: str) -> DataFrame:
    pending = incremental.pending_stations(inputs.manifest(spark, sf), inputs.raw_long(spark, sf))
    return pending.select("noaa_station_id", "station_name", "priority_rank")


@query
def prune_semi(spark: SparkSession, sf: str) -> DataFrame:
    landed = inputs.observations(spark, sf).withColumn("station", F.col("stationId"))
    return incremental.prune_to_manifest(landed, inputs.manifest(spark, sf)).select("station", "feature_id", "timestamp")


@query
def resume_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The parts of each station's calendar windows that its landed days leave open."""
    orders, day = inputs.table(spark, sf, "orders"), F.to_date("o_orderdate")
    station = inputs.text("GHCND:U", F.col("o_custkey")).alias("noaa_station_id")
    ranges = orders.groupBy(station).agg(
        F.date_sub(F.min(day), 10).alias("start_date"), F.date_add(F.max(day), 20).alias("end_date")
    )
    asked = windows.year_windows(ranges)
    covered = F.sequence(day, F.date_add(day, F.floor(F.col("o_totalprice") / 20000).cast("int")))
    landed = orders.select(station, F.explode(covered).alias("day"))
    return incremental.missing_windows(
        asked, incremental.landed_islands(landed, "noaa_station_id"), "noaa_station_id"
    )


@query
def inventory_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue stations and requests of their region whose days overlap, with the days shared."""
    orders, day = inputs.table(spark, sf, "orders"), F.to_date("o_orderdate")
    places = inputs.table(spark, sf, "customer").join(
        inputs.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", F.col("n_name").alias("region"))
    asked = orders.groupBy("o_custkey").agg(F.min(day).alias("request_start"), F.max(day).alias("request_end"))
    requests = asked.join(places, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    inventories = flat_catalog(spark, sf).select("id", "region", "daily_start", "daily_end")
    return intervals.overlap_join(
        inventories, requests, ("daily_start", "daily_end"), ("request_start", "request_end"), ("region",)
    ).select("region", "id", "o_custkey", "overlap_start", "overlap_end")


@query
def prune_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """As ``prune_semi``, of rows that lie in a folder per station: others' folders are not read."""
    path = f"{scratch_dir(spark, 'prune-partitions')}/landed"
    rows = inputs.observations(spark, sf).filter("stationId IS NOT NULL").withColumn("station", F.col("stationId"))
    rows.select("station", "feature_id", "timestamp").hint("rebalance", "station").write.partitionBy("station").parquet(path)
    landed = spark.read.schema("feature_id string, timestamp string, station string").parquet(path)
    return incremental.prune_to_manifest(landed, inputs.manifest(spark, sf)).select("station", "feature_id", "timestamp")


# Publishing

@query
def publish_documents(spark: SparkSession, sf: str) -> DataFrame:
    return publish.to_documents(unified(spark, sf))


@query
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return publish.latest_per_key(publish.to_documents(unified(spark, sf)))


def earlier_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of a run before the wide source was added, with observations until mid-January."""
    arrived = inputs.observations(spark, sf).filter(F.col("timestamp") < EARLIER_RUN_UNTIL)
    daily = observations.observations_to_daily(arrived, inputs.manifest(spark, sf))
    documents = publish.to_documents(curate.climate_daily([long_daily(spark, sf), daily]))
    return publish.latest_per_key(documents)


def handed_over(spark: SparkSession, sf: str) -> DataFrame:
    frames = [obs_daily(spark, sf), wide_rows.wide_to_daily(inputs.raw_wide(spark, sf))]
    return publish.to_documents(curate.climate_daily(frames))


def next_documents(spark: SparkSession, sf: str) -> DataFrame:
    return publish.latest_per_key(handed_over(spark, sf))


@query
def keyed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return publish.merge_snapshot(earlier_snapshot(spark, sf), next_documents(spark, sf))


SNAPSHOT_BUCKETS = 8


@query
def bucketed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """As ``keyed_upsert``, into a snapshot that lies in buckets of its key and is not moved."""
    folder = scratch_dir(spark, "bucketed-upsert")
    table = "snapshot_" + uuid.uuid4().hex
    for documents in (earlier_snapshot(spark, sf), handed_over(spark, sf)):
        tables.publish_bucketed(spark, table, folder, documents, SNAPSHOT_BUCKETS)
    return spark.table(table)


@query
def cell_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Of daily rows laid out by cells of date and station: one station's, and one day's."""
    path = f"{scratch_dir(spark, 'cells')}/daily"
    tables.write_in_cells(unified(spark, sf), path, 16)
    daily = tables.read_table(spark, path, CLIMATE_DAILY)
    return daily.filter((F.col("source_station_id") == LOOKUP_STATION) | (F.col("date") == F.lit(SAMPLE_DAY).cast("date")))


@query
def upsert_counts(spark: SparkSession, sf: str) -> DataFrame:
    return publish.upsert_counts(keyed_upsert(spark, sf), handed_over(spark, sf))


@query
def yearly_view(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly values read from sums that three publishes have kept up to date."""
    folder = scratch_dir(spark, "yearly-view")
    snapshot, view = f"{folder}/snapshot", f"{folder}/view"
    observed = publish.to_documents(curate.with_calendar(obs_daily(spark, sf)))
    for documents in (earlier_snapshot(spark, sf), observed, handed_over(spark, sf)):
        tables.publish_with_view(spark, snapshot, view, documents)
    return rollup_view.read_years(tables.read_table(spark, view, rollup_view.VIEW))


# Streams

def streamed_events(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.observation_rows(landing.stream_parquet(spark, f"{sf}/events.parquet"))


def days_like(spark: SparkSession, sf: str) -> DataFrame:
    return observations.summarize_days(normalized_observations(spark, sf))


@query
def streaming_local_day(spark: SparkSession, sf: str) -> DataFrame:
    """The streamed summaries of all station-days; the same rows and columns as the batch query's."""
    folder = scratch_dir(spark, "streaming-local-day")
    stream = observations.normalize_observations(streamed_events(spark, sf))
    landing.stream_days(stream, folder, f"{folder}/checkpoint")
    days = landing.read_days(spark, folder, days_like(spark, sf))
    return days.select("*", "position.lat", "position.lon").drop("position").withColumnsRenamed(
        {"lat": "latitude", "lon": "longitude"}
    )


def feed_by_feed(spark: SparkSession, sf: str, folder: str, take: Callable[[], None]) -> str:
    """Events that arrive file after file; ``take`` is called after each arrival. Returns the folder they arrive in."""
    fed = f"{folder}/fed"
    inputs.fed_events(spark, sf).write.partitionBy("feed").parquet(fed)
    schema = inputs.table(spark, sf, "events").schema
    for feed in range(inputs.FEEDS):
        spark.read.schema(schema).parquet(f"{fed}/feed={feed}").write.parquet(f"{folder}/in/{feed}")
        take()
    return fed


def closed_days(spark: SparkSession, sf: str) -> str:
    """The folder of a stream that closes station-days, after ten arrivals."""
    folder = scratch_dir(spark, "streaming-closed-days")

    def take() -> None:
        events = spark.readStream.schema(inputs.table(spark, sf, "events").schema).parquet(f"{folder}/in/*")
        stream = observations.normalize_observations(inputs.observation_rows(events))
        closing.stream_closed_days(stream, folder, f"{folder}/checkpoint")

    feed_by_feed(spark, sf, folder, take)
    return folder


@query
def streaming_closed_days(spark: SparkSession, sf: str) -> DataFrame:
    """Summaries of the station-days that ten arrivals have closed, without the rows that came too late."""
    days = closing.read_closed_days(spark, closed_days(spark, sf))
    return days.select(
        "batch", "station_id", "run_date", "day", "station_name", F.col("position.lat").alias("latitude"),
        F.col("position.lon").alias("longitude"), "obs_count", "avg_temp_c", "min_temp_c", "max_temp_c",
        "avg_wind_mps", "max_wind_mps",
    )


@query
def streaming_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that came when their day was closed, per station-day and arrival."""
    late = closing.read_late_rows(spark, closed_days(spark, sf))
    return late.groupBy("batch", "station_id", "day").agg(F.count(F.lit(1)).alias("rows"), F.max("local_time").cast("string").alias("newest"))


@query
def streaming_first_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Observations landed twice in part: those of two overlapping arrivals, each once."""
    folder = scratch_dir(spark, "streaming-first-arrivals")
    rows = inputs.observations(spark, sf)
    number = F.substring_index("feature_id", "-", -1).cast("bigint")
    for part, absent in enumerate((0, 1)):
        rows.filter(F.pmod(number, F.lit(3)) != absent).write.json(f"{folder}/in/{part}")
        stream = spark.readStream.schema(rows.schema).json(f"{folder}/in/*")
        once = landing.first_arrivals(stream, landing.record_key("@id", "feature_id"))
        landing.land(once, f"{folder}/out", f"{folder}/checkpoint", ("run_date",))
    landed = spark.read.schema(rows.schema).parquet(f"{folder}/out")
    return landed.select("feature_id", F.col("`@id`").alias("observation_id"), "stationId", "timestamp", F.col("temperature.value").alias("temperature"))


@query
def streaming_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Days of streamed observations published batch by batch into the earlier snapshot, and what became of it."""
    folder = scratch_dir(spark, "streaming-upsert")
    snapshot, before = f"{folder}/snapshot", earlier_snapshot(spark, sf)
    tables.publish_snapshot(spark, snapshot, before)
    manifest = inputs.manifest(spark, sf)

    def documents(days: DataFrame) -> DataFrame:
        return publish.to_documents(curate.with_calendar(observations.enrich_days(days, manifest)))

    stream = observations.normalize_observations(streamed_events(spark, sf))
    landing.stream_days(
        stream, folder, f"{folder}/checkpoint",
        lambda days, number: tables.publish_snapshot(spark, snapshot, documents(days)),
    )
    # Both whole: a document that the stream lost or left alone shows as such.
    published = spark.read.schema(before.schema).parquet(snapshot).select(*before.columns)
    streamed = documents(landing.read_days(spark, folder, days_like(spark, sf))).select(publish.KEY)
    return publish.compare_snapshots(before, published, handed=streamed)
