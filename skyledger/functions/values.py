"""Measures and identifiers: parsing, missing values, units, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Datatypes stored in tenths of their unit, and the missing-value marker.
TENTHS = ("TAVG", "TMAX", "TMIN", "PRCP", "AWND")
MISSING = "-9999"
DEFAULT_DATATYPES = ("TAVG", "TMAX", "TMIN", "PRCP", "AWND", "SNOW", "SNWD")
TRUE_TEXTS = ("1", "true", "yes", "y")
KMH_UNIT = "km_h"
KMH_PER_MPS = 3.6
MM_PER_CM = 10.0


def present(text: Column) -> Column:
    """Text, with the empty string read as null."""
    return F.nullif(text, F.lit(""))


def first_present(*texts: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[present(text) for text in texts])


def number(text: Column) -> Column:
    """A double; unparseable text and NaN give null."""
    value = text.try_cast("double")
    return F.when(~F.isnan(value), value)


def whole_number(text: Column) -> Column:
    """An int; blank or unparseable text gives null."""
    return present(text).try_cast("int")


def scaled_measure(datatype: Column, raw: Column) -> Column:
    """A long-format reading in metric units; blank, missing-marked and bad text give null."""
    value = number(F.when(~raw.isin("", MISSING), raw))
    return F.when(datatype.isin(*TENTHS), value / F.lit(10.0)).otherwise(value)


def wind_to_mps(speed: Column, unit: Column) -> Column:
    """Speed in m/s where the unit says km/h; other and missing units are left as they are."""
    return F.when(unit.contains(KMH_UNIT), speed / F.lit(KMH_PER_MPS)).otherwise(speed)


def kmh_to_mps(speed: Column) -> Column:
    return speed / F.lit(KMH_PER_MPS)


def cm_to_mm(depth: Column) -> Column:
    return depth * F.lit(MM_PER_CM)


def round_aggregate(value: Column) -> Column:
    """Two decimals of an average or sum.

    The order in which a distributed sum adds its doubles is not fixed, so its last bits move
    between runs. Rounding to eight decimals first takes that noise off, and results near a tie
    come out the same for every partitioning.
    """
    return F.round(F.round(value, 8), 2)


def truthy(text: Column) -> Column:
    """Flag text as boolean; null or empty counts as true."""
    return F.when(present(text).isNull(), F.lit(True)).otherwise(
        F.lower(F.trim(text)).isin(*TRUE_TEXTS)
    )


def station_code(station_id: Column) -> Column:
    """The part of a station id behind its dataset prefix (behind the first colon)."""
    colon = F.instr(station_id, ":")
    return F.when(colon > 0, F.substring(station_id, colon + 1, F.length(station_id))).otherwise(station_id)


def qualified_station_id(station_id: Column, dataset: str = "GHCND") -> Column:
    """A station id with its dataset prefix, added where it has none."""
    return F.when(F.instr(station_id, ":") > 0, station_id).otherwise(
        F.concat(F.lit(f"{dataset}:"), station_id)
    )


def flag_text(**flags: Column) -> Column:
    """``name=value`` pairs joined by commas, missing values empty."""
    pairs = [F.concat(F.lit(f"{name}="), F.coalesce(value, F.lit(""))) for name, value in flags.items()]
    return F.concat_ws(",", *pairs)


def document_key(source: Column, source_station_id: Column, noaa_station_id: Column, day: Column) -> Column:
    """``source|station|date``, with a fixed stand-in for each missing part."""
    return F.concat_ws(
        "|",
        F.coalesce(present(source), F.lit("unknown")),
        F.coalesce(present(source_station_id), present(noaa_station_id), F.lit("unknown_station")),
        F.coalesce(present(day), F.lit("unknown_date")),
    )
