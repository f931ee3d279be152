"""Continuing earlier runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.values import first_present


def station_key(*, unknown: str = "unknown") -> Column:
    """The id under which a manifest row counts as landed."""
    return F.coalesce(
        first_present(F.col("noaa_station_id"), F.col("nws_station_id"), F.col("station_name")), F.lit(unknown)
    )


def completed_stations(landed: DataFrame) -> DataFrame:
    """Distinct ids of stations with landed rows."""
    return landed.filter(F.col("noaa_station_id") != "").select(F.col("noaa_station_id").alias("done")).distinct()


def pending_stations(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Manifest rows whose station has nothing landed yet."""
    return manifest.join(completed_stations(landed), station_key() == F.col("done"), "left_anti")


def prune_to_manifest(rows: DataFrame, manifest: DataFrame, station: str = "station") -> DataFrame:
    """Landed rows of stations that the manifest still lists."""
    expected = manifest.filter(F.col("nws_station_id") != "").select(F.col("nws_station_id").alias(station)).distinct()
    return rows.join(expected, station, "left_semi")


def stale_stations(rows: DataFrame, manifest: DataFrame, station: str = "station") -> DataFrame:
    """Landed stations that the manifest no longer lists."""
    expected = manifest.filter(F.col("nws_station_id") != "").select(F.col("nws_station_id").alias(station))
    return rows.select(station).distinct().join(expected, station, "left_anti")


def landed_islands(rows: DataFrame, key: str, day: str = "day") -> DataFrame:
    """Unbroken runs of landed days: key, ``first_day``, ``last_day``.

    Days are made distinct before they meet, so a station is as many rows as days, however many rows landed.
    """
    days = rows.filter(F.col(key).isNotNull() & F.col(day).isNotNull()).select(key, F.col(day).alias("day")).distinct()
    place = F.row_number().over(Window.partitionBy(key).orderBy("day"))
    # Consecutive days lie equally far from their places.
    return (
        days.withColumn("island", F.date_sub("day", place))
        .groupBy(key, "island").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day")).drop("island")
    )


def missing_windows(
    requests: DataFrame, islands: DataFrame, key: str, start: str = "window_start", end: str = "window_end"
) -> DataFrame:
    """The parts of requested windows that no landed run covers: key, ``start``, ``end``, ``missing_start``, ``missing_end``.

    Windows of a key may overlap; each is answered for itself, equal ones once. A window without a bound, or that
    ends before it starts, asks for nothing.
    """
    asked = requests.filter(F.col(start) <= F.col(end)).select(key, start, end).distinct()
    runs = islands.select(F.col(key).alias("_key"), "first_day", "last_day")
    met = asked.join(
        runs, (F.col(key) == F.col("_key")) & (F.col("first_day") <= F.col(end)) & (F.col("last_day") >= F.col(start)), "left"
    )
    order = Window.partitionBy(key, start, end).orderBy("first_day")
    follows = F.coalesce(F.date_add(F.lag("last_day").over(order), 1), F.col(start))
    before = F.struct(follows.alias("missing_start"), F.coalesce(F.date_sub("first_day", 1), F.col(end)).alias("missing_end"))
    # Behind the last run; a window that meets none is its own gap already.
    after = F.when(
        F.col("first_day").isNotNull() & F.lead("first_day").over(order).isNull(),
        F.struct(F.date_add("last_day", 1).alias("missing_start"), F.col(end).alias("missing_end")),
    )
    gaps = met.select(key, start, end, F.array(before, after).alias("gaps"))
    gaps = gaps.select(key, start, end, F.inline("gaps"))
    return gaps.filter(F.col("missing_start") <= F.col("missing_end"))
