"""Long rows (one per station, day and datatype): normalising, and pivoting to daily rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.dates import compact_date, iso_date, leading_date, year_window
from skyledger.functions.values import (
    DEFAULT_DATATYPES,
    flag_text,
    number,
    qualified_station_id,
    scaled_measure,
    station_code,
)
from skyledger.operators.validity import accepted
from skyledger.schemas import DAILY, RAW_LONG, REQUIRED_LONG, conform, require_columns

SOURCE = "noaa"

# The datatypes that feed a daily column. Others are only counted.
PIVOTED = {
    "TAVG": "tavg",
    "TMIN": "tmin",
    "TMAX": "tmax",
    "PRCP": "prcp",
    "AWND": "awnd",
    "SNOW": "snow",
}

# A row without a value is usable.
CHECKS = {
    "missing_station": "noaa_station_id IS NULL",
    "missing_datatype": "datatype IS NULL",
    "bad_date": "day IS NULL",
}

DAILY_KEYS = (
    "noaa_station_id", "station_name", "state", "country", "latitude", "longitude", "run_date", "day",
)


def normalize_ghcn(lines: DataFrame, dataset: str = "GHCND") -> DataFrame:
    """Typed columns for the eight text fields of a by-station file."""
    return lines.select(
        qualified_station_id(F.col("station_id"), dataset).alias("noaa_station_id"),
        station_code(F.col("station_id")).alias("station_code"),
        compact_date(F.col("raw_day")).alias("day"),
        "datatype",
        scaled_measure(F.col("datatype"), F.col("raw_value")).alias("value"),
        flag_text(
            mflag=F.col("mflag"), qflag=F.col("qflag"), sflag=F.col("sflag"), obs_time=F.col("obs_time")
        ).alias("attributes"),
    )


def station_rows(
    lines: DataFrame,
    manifest: DataFrame,
    start: date,
    end: date,
    run_date: str,
    datatypes: tuple[str, ...] = DEFAULT_DATATYPES,
    dataset: str = "GHCND",
) -> DataFrame:
    """Raw long rows of the manifest's stations within a window, from by-station file lines.

    Lines with another datatype, an unreadable day or a day outside the window are left out.
    """
    wanted = normalize_ghcn(lines, dataset).filter(
        F.col("datatype").isin(*datatypes) & F.col("day").between(start, end)
    )
    stations = manifest.filter(F.col("noaa_station_id") != "").select(
        station_code(F.col("noaa_station_id")).alias("station_code"),
        "station_name", "state", "country", "latitude", "longitude", "nws_station_id",
    )
    return conform(
        wanted.join(stations, "station_code"),
        RAW_LONG,
        source=F.lit(SOURCE),
        run_date=F.lit(run_date),
        noaa_dataset_id=F.lit(dataset),
        date=F.col("day"),
        request_window_start=F.lit(start),
        request_window_end=F.lit(end),
    )


def page_rows(
    pages: DataFrame, manifest: DataFrame, start: date, end: date, run_date: str, dataset: str = "GHCND"
) -> DataFrame:
    """Raw long rows from landed result pages (``noaa_station_id``, ``results``).

    Each row carries the calendar-year part of the window in which it was requested.
    """
    items = pages.select("noaa_station_id", F.explode("results").alias("item")).select(
        "noaa_station_id",
        leading_date(F.col("item.date")).alias("day"),
        F.col("item.datatype").alias("datatype"),
        number(F.col("item.value")).alias("value"),
        F.col("item.attributes").alias("attributes"),
    )
    stations = manifest.filter(F.col("noaa_station_id") != "").select(
        "noaa_station_id", "station_name", "state", "country", "latitude", "longitude", "nws_station_id"
    )
    first, last = year_window(F.year("day"), F.lit(start), F.lit(end))
    return conform(
        items.join(stations, "noaa_station_id"),
        RAW_LONG,
        source=F.lit(SOURCE),
        run_date=F.lit(run_date),
        noaa_dataset_id=F.lit(dataset),
        date=F.col("day"),
        request_window_start=first,
        request_window_end=last,
    )


def normalize_long(raw: DataFrame) -> DataFrame:
    """Typed raw long rows."""
    return require_columns(raw, REQUIRED_LONG, SOURCE).select(
        "noaa_station_id", "station_name", "state", "country",
        number(F.col("latitude")).alias("latitude"),
        number(F.col("longitude")).alias("longitude"),
        "run_date",
        iso_date(F.col("date")).alias("day"),
        "datatype",
        number(F.col("value")).alias("value"),
    )


def long_to_daily(raw: DataFrame) -> DataFrame:
    return normalized_to_daily(normalize_long(raw))


def normalized_to_daily(normalized: DataFrame) -> DataFrame:
    """One daily row per station, day and run; the largest of repeated readings wins.

    Only doubles and a count are aggregated, so Spark combines rows in hash maps before the
    shuffle and a station-day with any number of copies leaves each task as one row.
    """
    def largest(datatype: str) -> Column:
        return F.max(F.when(F.col("datatype") == datatype, F.col("value")))

    wide = (
        accepted(normalized, CHECKS)
        .groupBy(*DAILY_KEYS)
        .agg(
            F.count(F.lit(1)).alias("obs_count"),
            *[largest(datatype).alias(column) for datatype, column in PIVOTED.items()],
        )
    )
    middle = F.round((F.col("tmin") + F.col("tmax")) / 2, 2)
    return conform(
        wide,
        DAILY,
        source=F.lit(SOURCE),
        date="day",
        source_station_id="noaa_station_id",
        avg_temp_c=F.coalesce("tavg", middle),
        min_temp_c="tmin",
        max_temp_c="tmax",
        precip_mm="prcp",
        avg_wind_mps="awnd",
        snow_mm="snow",
        ingest_run_date="run_date",
    )
