"""Text for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.values import KMH_PER_MPS, KMH_UNIT

# Display names of the sources.
SOURCE_NAMES = {"nws": "NWS", "noaa": "NOAA", "meteostat": "Meteostat"}


def source_name(source: Column) -> Column:
    """Display name of a source; unknown ones stay as they are."""
    named = F.when(F.lit(False), source)
    for code, name in SOURCE_NAMES.items():
        named = named.when(source == code, F.lit(name))
    return named.otherwise(source)


def count_text(count: Column) -> Column:
    """A count with thousands separators."""
    return F.format_number(count, 0)


def duration_text(seconds: Column) -> Column:
    """Elapsed seconds as ``1h 2m 3s``, without leading zero units."""
    total = F.bround(seconds, 0).cast("bigint")
    hours, minutes, rest = F.floor(total / 3600), F.floor(total % 3600 / 60), total % 60
    return (
        F.when(hours > 0, F.format_string("%dh %dm %ds", hours, minutes, rest))
        .when(minutes > 0, F.format_string("%dm %ds", minutes, rest))
        .otherwise(F.format_string("%ds", rest))
    )


def timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def temperature_text(celsius: Column) -> Column:
    return F.when(celsius.isNull(), F.lit("N/A")).otherwise(F.format_string("%.1f°C", celsius))


def wind_text(speed: Column, unit: Column) -> Column:
    """Speed in m/s with two decimals if given in km/h, else the bare number with three."""
    return (
        F.when(speed.isNull(), F.lit("N/A"))
        .when(unit.contains(KMH_UNIT), F.format_string("%.2f m/s", speed / F.lit(KMH_PER_MPS)))
        .otherwise(F.format_string("%.3f", speed))
    )


def listed(text: Column) -> Column:
    """The distinct entries of comma-separated text, trimmed, in their order; blank ones go."""
    entries = F.transform(F.split(text, ","), lambda entry: F.trim(entry))
    return F.array_distinct(F.filter(entries, lambda entry: entry != ""))


def unsupported(sources: Column) -> Column:
    """Listed sources that there is no data for."""
    return F.array_except(sources, F.array(*[F.lit(code) for code in SOURCE_NAMES]))
