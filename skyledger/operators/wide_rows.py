"""Wide rows (one per station and day, all measures): landing, normalising, and daily rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.dates import date_status, day_date, iso_date, stated_date
from skyledger.functions.values import cm_to_mm, kmh_to_mps, number
from skyledger.operators.validity import accepted
from skyledger.schemas import DAILY, RAW_WIDE, REQUIRED_WIDE, WIDE_MEASURES, conform, require_columns

SOURCE = "meteostat"
PROVIDER = "meteostat_bulk"

CHECKS = {
    "missing_station": "noaa_station_id IS NULL OR meteostat_station_id IS NULL",
    "bad_date": "day IS NULL",
    "no_measure": f"coalesce({', '.join(WIDE_MEASURES)}) IS NULL",
}


def dated_rows(lines: DataFrame) -> DataFrame:
    """Station-year file lines with their date, whichever way the file states it, and its status."""
    fields = [F.col(name) if name in lines.columns else F.lit(None).cast("string")
              for name in ("date", "time", "year", "month", "day")]
    return (
        lines.withColumn("_stated", stated_date(*fields))
        .withColumn("observed_on", day_date(F.col("_stated")))
        .withColumn("date_status", date_status(F.col("_stated"), F.col("observed_on")))
        .drop("_stated")
    )


def station_year_rows(
    lines: DataFrame, resolved: DataFrame, start: date, end: date, run_date: str
) -> DataFrame:
    """Raw wide rows within a window for every resolved manifest station.

    ``lines`` hold ``meteostat_station_id`` and the file's text fields, dated or not; ``resolved``
    is the output of ``stations.resolve_stations``. Lines without a readable date are left out
    here; ``quality.all_or_nothing`` on ``dated_rows`` drops whole stations that have a bad one.
    """
    dated = lines if "observed_on" in lines.columns else dated_rows(lines)
    in_window = dated.filter(F.col("observed_on").between(start, end))
    measures = [
        (number(F.col(name)) if name in lines.columns else F.lit(None).cast("double")).alias(name)
        for name in WIDE_MEASURES
    ]
    return conform(
        in_window.select(
            "meteostat_station_id", F.col("observed_on").cast("string").alias("date"), *measures
        ).join(resolved, "meteostat_station_id"),
        RAW_WIDE,
        source=F.lit(SOURCE),
        run_date=F.lit(run_date),
        provider=F.lit(PROVIDER),
    )


def normalize_wide(raw: DataFrame) -> DataFrame:
    """Typed raw wide rows."""
    require_columns(raw, REQUIRED_WIDE, SOURCE)
    measures = [
        (number(F.col(name)) if name in raw.columns else F.lit(None).cast("double")).alias(name)
        for name in WIDE_MEASURES
    ]
    return raw.select(
        "noaa_station_id", "meteostat_station_id", "station_name", "state", "country",
        number(F.col("latitude")).alias("latitude"),
        number(F.col("longitude")).alias("longitude"),
        "run_date",
        iso_date(F.col("date")).alias("day"),
        *measures,
    )


def wide_to_daily(raw: DataFrame) -> DataFrame:
    return normalized_to_daily(normalize_wide(raw))


def normalized_to_daily(normalized: DataFrame) -> DataFrame:
    """Daily rows one to one from usable raw rows; wind to m/s, snow to mm. No shuffle."""
    return conform(
        accepted(normalized, CHECKS),
        DAILY,
        source=F.lit(SOURCE),
        date="day",
        source_station_id="meteostat_station_id",
        avg_temp_c="temp",
        min_temp_c="tmin",
        max_temp_c="tmax",
        precip_mm="prcp",
        avg_wind_mps=kmh_to_mps(F.col("wspd")),
        max_wind_mps=kmh_to_mps(F.col("wpgt")),
        snow_mm=cm_to_mm(F.col("snwd")),
        obs_count=F.lit(1),
        ingest_run_date="run_date",
    )
