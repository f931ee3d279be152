"""Intraday observations: unnesting, normalising, and summarising to local days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.dates import DEFAULT_ZONE, local_time
from skyledger.functions.display import temperature_text, wind_text
from skyledger.functions.values import first_present, number, round_aggregate, wind_to_mps
from skyledger.operators.validity import accepted
from skyledger.schemas import DAILY, conform

SOURCE = "nws"

CHECKS = {
    "missing_station": "station_id IS NULL",
    "bad_timestamp": "day IS NULL",
    "no_measure": "temperature_c IS NULL AND wind_mps IS NULL",
}

DAY_KEYS = ("station_id", "run_date", "day")

# Where a raw path states its run date.
RUN_DATE_IN_PATH = r"run_date=([^/]+)/"
LEGACY_DATE_IN_PATH = r"raw/([^/]+)/"


def run_date_of_path(path: Column) -> Column:
    """Run date stated by a raw file's path, in its present or its legacy layout."""
    return F.coalesce(
        F.nullif(F.regexp_extract(path, RUN_DATE_IN_PATH, 1), F.lit("")),
        F.regexp_extract(path, LEGACY_DATE_IN_PATH, 1),
    )


def explode_features(payloads: DataFrame) -> DataFrame:
    """One row per observation of each payload; a payload without any gives one empty row.

    Expects ``features`` and either ``run_date`` or the ``path`` that states it.
    """
    run_date = F.col("run_date") if "run_date" in payloads.columns else run_date_of_path(F.col("path"))
    return payloads.select(run_date.alias("run_date"), F.explode_outer("features").alias("feature")).select(
        "run_date",
        F.col("feature.id").alias("feature_id"),
        "feature.properties.*",
        F.col("feature.geometry").alias("geometry"),
    )


def normalize_observations(observations: DataFrame, zone: str | Column = DEFAULT_ZONE) -> DataFrame:
    """Typed observations with their local time and day.

    ``zone`` is one zone for all stations, or a column naming each row's own. Timestamp text is
    read as an instant; the day does not depend on the session's time zone.
    """
    return observations.select(
        "run_date",
        F.col("stationId").alias("station_id"),
        F.col("stationName").alias("station_name"),
        F.col("timestamp").try_cast("timestamp").alias("observed_at"),
        local_time(F.col("timestamp").try_cast("timestamp"), zone).alias("local_time"),
        number(F.col("temperature.value")).alias("temperature_c"),
        wind_to_mps(number(F.col("windSpeed.value")), F.col("windSpeed.unitCode")).alias("wind_mps"),
        F.get("geometry.coordinates", F.lit(1)).alias("payload_latitude"),
        F.get("geometry.coordinates", F.lit(0)).alias("payload_longitude"),
    ).withColumn("day", F.to_date("local_time"))


#: What a station-day's observations state besides their measures; nearly always one variant a day.
VARIANT_KEYS = (*DAY_KEYS, "station_name", "payload_latitude", "payload_longitude")


def day_partials(normalized: DataFrame) -> DataFrame:
    """Station-days in a form that can be merged, per metadata stated.

    Choosing the earliest text or position needs a sort-based aggregate. So that it does not sort
    every observation, rows are combined per stated metadata here, and with numbers only, which
    Spark does in hash maps.
    """
    return accepted(normalized, CHECKS).groupBy(*VARIANT_KEYS).agg(
        F.min("observed_at").alias("first_at"),
        F.count(F.lit(1)).alias("obs_count"),
        F.sum("temperature_c").alias("temp_sum"),
        F.count("temperature_c").alias("temp_count"),
        F.min("temperature_c").alias("min_temp_c"),
        F.max("temperature_c").alias("max_temp_c"),
        F.sum("wind_mps").alias("wind_sum"),
        F.count("wind_mps").alias("wind_count"),
        F.max("wind_mps").alias("max_wind_mps"),
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """Partial station-days of several parts of the observations as those of all of them."""
    totals = ("obs_count", "temp_sum", "temp_count", "wind_sum", "wind_count")
    least, most = ("first_at", "min_temp_c"), ("max_temp_c", "max_wind_mps")
    merged = partials.groupBy(*VARIANT_KEYS).agg(
        *[F.sum(name).alias(name) for name in totals],
        *[F.min(name).alias(name) for name in least],
        *[F.max(name).alias(name) for name in most],
    )
    return merged.select(*partials.columns)


def finish_days(partials: DataFrame) -> DataFrame:
    """One row per station, run and local day, with metadata of the earliest observation that has any."""
    def earliest(value: Column, present: Column) -> Column:
        return F.min(F.when(present, F.struct(F.col("first_at"), value.alias("value"))))["value"]

    def mean(measure: str) -> Column:
        return round_aggregate(F.try_divide(F.sum(f"{measure}_sum"), F.sum(f"{measure}_count")))

    position = F.struct(F.col("payload_latitude").alias("lat"), F.col("payload_longitude").alias("lon"))
    has_position = F.col("payload_latitude").isNotNull() | F.col("payload_longitude").isNotNull()
    return partials.groupBy(*DAY_KEYS).agg(
        earliest(F.col("station_name"), F.col("station_name").isNotNull()).alias("station_name"),
        earliest(position, has_position).alias("position"),
        F.sum("obs_count").alias("obs_count"),
        mean("temp").alias("avg_temp_c"),
        F.min("min_temp_c").alias("min_temp_c"),
        F.max("max_temp_c").alias("max_temp_c"),
        mean("wind").alias("avg_wind_mps"),
        round_aggregate(F.max("max_wind_mps")).alias("max_wind_mps"),
    )


def summarize_days(normalized: DataFrame) -> DataFrame:
    """One row per station, run and local day."""
    return finish_days(day_partials(normalized))


def enrich_days(days: DataFrame, manifest: DataFrame) -> DataFrame:
    """Daily rows from local-day summaries, with the manifest's metadata where it knows the station.

    The join comes after the aggregation, when a station has one row per day. No side is
    broadcast by hint: Spark does so where the manifest's size allows it, and splits skewed
    stations where it does not. Stations missing from the manifest keep their payload's metadata.
    """
    stations = manifest.filter(F.col("nws_station_id").isNotNull()).select(
        F.col("nws_station_id").alias("station_id"),
        "noaa_station_id",
        F.col("station_name").alias("manifest_name"),
        "state",
        "country",
        number(F.col("latitude")).alias("manifest_latitude"),
        number(F.col("longitude")).alias("manifest_longitude"),
    )
    return conform(
        days.join(stations, "station_id", "left"),
        DAILY,
        source=F.lit(SOURCE),
        date="day",
        source_station_id="station_id",
        station_name=F.coalesce("manifest_name", "station_name"),
        latitude=F.coalesce("manifest_latitude", "position.lat"),
        longitude=F.coalesce("manifest_longitude", "position.lon"),
        ingest_run_date="run_date",
    )


def observations_to_daily(
    observations: DataFrame, manifest: DataFrame, zone: str | Column = DEFAULT_ZONE
) -> DataFrame:
    return enrich_days(summarize_days(normalize_observations(observations, zone)), manifest)


def raw_observation_documents(observations: DataFrame) -> DataFrame:
    """Documents of single raw observations; those without any id are left out."""
    # Document field names and constants.
    properties = F.struct(
        *[
            F.col(f"`{name}`")
            for name in (
                "@id", "station", "stationId", "stationName", "timestamp", "textDescription",
                "temperature", "windSpeed",
            )
        ]
    )
    return observations.select(
        first_present(F.col("`@id`"), F.col("feature_id")).alias("_id"),
        F.lit(SOURCE).alias("source"),
        F.lit("raw").alias("dataLevel"),
        F.col("run_date").alias("ingestRunDate"),
        "timestamp", "stationId", "station", "stationName", "textDescription",
        properties.alias("properties"),
        "geometry",
    ).filter(F.col("_id").isNotNull())


def observation_samples(observations: DataFrame, n: int = 10) -> DataFrame:
    """Readable lines of the ``n`` earliest observations."""
    return observations.orderBy("timestamp", "stationId").limit(n).select(
        "stationId",
        "timestamp",
        temperature_text(F.col("temperature.value")).alias("temperature"),
        wind_text(F.col("windSpeed.value"), F.col("windSpeed.unitCode")).alias("wind"),
    )
