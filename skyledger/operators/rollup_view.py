"""Yearly station values that follow a snapshot: sums that can be added to and taken from.

A view has a row per station-year and position with the number of its days and, for each measure, the sum and the
number of stated values. Documents that come add to it, documents that are replaced are taken from it, so
a publish changes the rows of touched station-years only. Sums are decimals: adding and taking away leaves
exactly what a new rollup would give, in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.curate import PLACE_KEYS, YEARLY_MEASURES, finish_station_years

#: Twelve decimals are exact for stated measures and far below what a rounded result shows for converted ones.
STORED, SUMMED = "decimal(26,12)", "decimal(38,12)"

#: What a document states for the view.
STATED = (*PLACE_KEYS, *YEARLY_MEASURES)

VIEW = {
    **dict.fromkeys(("source", "noaa_station_id", "station_name", "state", "country"), "string"),
    "year": "int", "latitude": "double", "longitude": "double", "days": "bigint",
    **{f"{name}_sum": SUMMED for name in YEARLY_MEASURES}, **{f"{name}_count": "bigint" for name in YEARLY_MEASURES},
}


def change_sums(changes: DataFrame) -> DataFrame:
    """What documents with a ``sign`` (1 added, -1 taken) add to the view."""
    sign = F.col("sign").cast("bigint")

    def count(name: str) -> object:
        return F.coalesce(F.sum(F.when(F.col(name).isNotNull(), sign)), F.lit(0)).cast("bigint").alias(f"{name}_count")

    def total(name: str) -> object:
        value = F.col(name).cast(STORED)
        return F.coalesce(F.sum(F.when(sign < 0, -value).otherwise(value)).cast(SUMMED), F.lit(0).cast(SUMMED)).alias(f"{name}_sum")

    return changes.groupBy(*PLACE_KEYS).agg(
        F.sum(sign).alias("days"), *[total(name) for name in YEARLY_MEASURES], *[count(name) for name in YEARLY_MEASURES]
    ).select(*VIEW)


def add_changes(view: DataFrame, sums: DataFrame) -> DataFrame:
    """The view with sums added to it; a station-year that lost all its days stays with none."""
    numbers = [name for name in VIEW if name not in PLACE_KEYS]
    return view.unionByName(sums).groupBy(*PLACE_KEYS).agg(*[F.sum(name).cast(VIEW[name]).alias(name) for name in numbers]).select(*VIEW)


def read_years(view: DataFrame) -> DataFrame:
    """The yearly values of a view, as a rollup of its documents gives them."""
    stated = view.filter(F.col("days") > 0)
    means = [name for name in YEARLY_MEASURES if name != "precip_mm"]
    return finish_station_years(stated.select(
        *PLACE_KEYS, "days", F.when(F.col("precip_mm_count") > 0, F.col("precip_mm_sum").cast("double")).alias("precip_mm"),
        *[F.when(F.col(f"{name}_count") > 0, F.col(f"{name}_sum").cast("double")).alias(f"{name}_sum") for name in means],
        *[f"{name}_count" for name in means],
    ))
