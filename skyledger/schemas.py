"""Explicit schemas of every dataset, and the checks and projections built on them.

Raw inputs are always read with a schema of ours: inference costs a pass over the files and
drifts with their content (whole numbers become ``bigint``, all-null fields become ``string``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Dataset column names and types.
MANIFEST = {
    "noaa_station_id": "string",
    "station_name": "string",
    "state": "string",
    "country": "string",
    "source_api": "string",
    "ingest_enabled": "string",
    "priority_rank": "int",
    "latitude": "string",
    "longitude": "string",
    "nws_station_id": "string",
    "nws_station_url": "string",
    "meteostat_station_id": "string",
    "meteostat_query_latitude": "string",
    "meteostat_query_longitude": "string",
}

RAW_LONG = {
    "source": "string",
    "run_date": "string",
    "noaa_dataset_id": "string",
    "noaa_station_id": "string",
    "station_name": "string",
    "state": "string",
    "country": "string",
    "latitude": "string",
    "longitude": "string",
    "nws_station_id": "string",
    "date": "string",
    "datatype": "string",
    "value": "double",
    "attributes": "string",
    "request_window_start": "string",
    "request_window_end": "string",
}

RAW_WIDE = {
    "source": "string",
    "run_date": "string",
    "provider": "string",
    "noaa_station_id": "string",
    "nws_station_id": "string",
    "station_name": "string",
    "state": "string",
    "country": "string",
    "latitude": "string",
    "longitude": "string",
    "meteostat_station_id": "string",
    "meteostat_station_name": "string",
    "meteostat_station_latitude": "double",
    "meteostat_station_longitude": "double",
    "meteostat_station_elevation_m": "double",
    "meteostat_station_distance_km": "double",
    "meteostat_match_type": "string",
    "date": "string",
    "temp": "double",
    "tmin": "double",
    "tmax": "double",
    "prcp": "double",
    "snwd": "double",
    "wspd": "double",
    "wpgt": "double",
}

WIDE_MEASURES = ("temp", "tmin", "tmax", "prcp", "snwd", "wspd", "wpgt")

OBSERVATION_PROPERTIES = (
    "struct<`@id`:string,station:string,stationId:string,stationName:string,timestamp:string,"
    "textDescription:string,temperature:struct<value:double,unitCode:string>,"
    "windSpeed:struct<value:double,unitCode:string>>"
)

RAW_OBSERVATIONS = {
    "features": (
        "array<struct<id:string,geometry:struct<type:string,coordinates:array<double>>,"
        f"properties:{OBSERVATION_PROPERTIES}>>"
    ),
}

LONG_PAGE = {
    "results": "array<struct<date:string,datatype:string,value:string,attributes:string>>",
    "metadata": "struct<resultset:struct<count:bigint>>",
}

CATALOG = {
    "id": "string",
    "name": "string",
    "country": "string",
    "region": "string",
    "identifiers": "struct<national:string,icao:string>",
    "location": "struct<latitude:double,longitude:double,elevation:double>",
    "inventory": "struct<daily:struct<start:string,end:string>>",
}

DAILY = {
    "source": "string",
    "date": "date",
    "noaa_station_id": "string",
    "source_station_id": "string",
    "station_name": "string",
    "state": "string",
    "country": "string",
    "latitude": "double",
    "longitude": "double",
    "avg_temp_c": "double",
    "min_temp_c": "double",
    "max_temp_c": "double",
    "precip_mm": "double",
    "avg_wind_mps": "double",
    "max_wind_mps": "double",
    "snow_mm": "double",
    "obs_count": "bigint",
    "ingest_run_date": "string",
}

CLIMATE_DAILY = DAILY | {"year": "int", "month": "int"}

STATION_YEAR = {
    "source": "string",
    "noaa_station_id": "string",
    "station_name": "string",
    "state": "string",
    "country": "string",
    "year": "int",
    "latitude": "double",
    "longitude": "double",
    "days_covered": "bigint",
    "annual_avg_temp_c": "double",
    "annual_avg_min_temp_c": "double",
    "annual_avg_max_temp_c": "double",
    "annual_precip_mm": "double",
    "annual_avg_wind_mps": "double",
}

SOURCE_YEAR = {
    "source": "string",
    "year": "int",
    "stations_covered": "bigint",
    "mean_station_temp_c": "double",
    "mean_station_precip_mm": "double",
    "mean_station_wind_mps": "double",
}

RUN_METRICS = {
    "source": "string",
    "run_date": "string",
    "raw_input_rows": "bigint",
    "invalid_rows_removed": "bigint",
    "valid_input_rows": "bigint",
    "output_rows": "bigint",
    "rows_consolidated_by_aggregation": "bigint",
}

FAILURES = {
    "run_date": "string",
    "source": "string",
    "noaa_station_id": "string",
    "nws_station_id": "string",
    "station_name": "string",
    "state": "string",
    "start_date": "string",
    "end_date": "string",
    "error_type": "string",
    "error_message": "string",
    "logged_at": "string",
}

REQUIRED_LONG = (
    "noaa_station_id", "station_name", "state", "country", "latitude", "longitude",
    "run_date", "date", "datatype", "value",
)

REQUIRED_WIDE = (
    "date", "noaa_station_id", "station_name", "state", "country", "latitude", "longitude",
    "meteostat_station_id", "temp", "tmin", "tmax", "prcp", "snwd", "wspd", "run_date",
)

PROCESSED_DATASETS = {
    "nws": "nws_daily/parquet",
    "noaa": "noaa_daily/parquet",
    "meteostat": "meteostat_daily/parquet",
}


class MissingColumnsError(ValueError):
    """An input lacks columns that an operator cannot work without."""


def ddl(schema: Mapping[str, str]) -> str:
    """The schema as a DDL string for ``DataFrameReader.schema``."""
    return ", ".join(f"`{name}` {kind}" for name, kind in schema.items())


def missing_columns(present: Iterable[str], required: Iterable[str]) -> list[str]:
    have = set(present)
    return [name for name in required if name not in have]


def require_columns(df: DataFrame, required: Iterable[str], dataset: str) -> DataFrame:
    """Return ``df`` unchanged, or fail before any job starts if columns are missing."""
    missing = missing_columns(df.columns, required)
    if missing:
        raise MissingColumnsError(f"{dataset}: missing required columns: {', '.join(missing)}")
    return df


def conform(df: DataFrame, schema: Mapping[str, str], **values: Column | str | None) -> DataFrame:
    """Project ``df`` onto ``schema`` in its column order.

    ``values`` gives the expression (or input column name) of a target column; ``None`` makes it a
    typed null. Columns not named there are taken from ``df`` by name, or are typed nulls.
    """
    def column(name: str) -> Column:
        value = values.get(name, name if name in df.columns else None)
        if value is None:
            value = F.lit(None)
        elif isinstance(value, str):
            value = F.col(value)
        return value.cast(schema[name]).alias(name)

    return df.select(*[column(name) for name in schema])
