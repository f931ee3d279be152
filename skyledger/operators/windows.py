"""Request windows as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.dates import calendar_years, trailing_start, year_window


def trailing_windows(ends: DataFrame, end: str = "end_date", years: int = 10) -> DataFrame:
    """Adds the first day of the whole-year window that closes on ``end``."""
    return ends.withColumn("start_date", trailing_start(F.col(end), years))


def year_windows(ranges: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row per calendar year a range touches, with the part of the range in that year."""
    years = ranges.withColumn("year", F.explode(calendar_years(F.col(start), F.col(end))))
    first, last = year_window(F.col("year"), F.col(start), F.col(end))
    return years.withColumns({"window_start": first, "window_end": last})
