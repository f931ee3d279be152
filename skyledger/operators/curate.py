"""Union of the daily sources, yearly rollups, and reports on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.values import round_aggregate

STATION_YEAR_KEYS = ("source", "noaa_station_id", "station_name", "state", "country", "year")
PLACE_KEYS = (*STATION_YEAR_KEYS, "latitude", "longitude")
#: What is summed over a year; all but precipitation become means.
YEARLY_MEASURES = ("avg_temp_c", "min_temp_c", "max_temp_c", "precip_mm", "avg_wind_mps")


def unite(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; a column some frame lacks is null there."""
    if not frames:
        raise ValueError("no daily datasets to unite")
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def with_calendar(daily: DataFrame) -> DataFrame:
    return daily.withColumns({"year": F.year("date"), "month": F.month("date")})


def climate_daily(frames: list[DataFrame]) -> DataFrame:
    return with_calendar(unite(frames))


def station_years(daily: DataFrame) -> DataFrame:
    """Yearly values per station.

    Days are first combined per key and position, which is nearly always one group per station-year,
    and with numbers only: in hash maps, before the shuffle, so a source or station with most of the
    rows does not weigh on one task. The place is one position that the days state: of several the one
    of least latitude, then longitude; positions that lack a coordinate come last.
    """
    means = [name for name in YEARLY_MEASURES if name != "precip_mm"]
    return finish_station_years(daily.groupBy(*PLACE_KEYS).agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("precip_mm").alias("precip_mm"),
        *[F.sum(name).alias(f"{name}_sum") for name in means],
        *[F.count(name).alias(f"{name}_count") for name in means],
    ))


def finish_station_years(places: DataFrame) -> DataFrame:
    """Yearly values per station from sums and counts per station-year and position."""
    def mean(name: str) -> Column:
        return round_aggregate(F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_count")))

    place = F.min(F.struct(
        F.col("latitude").isNull().alias("no_latitude"), "latitude",
        F.col("longitude").isNull().alias("no_longitude"), "longitude",
    ))
    return places.groupBy(*STATION_YEAR_KEYS).agg(
        place.alias("place"),
        F.sum("days").alias("days_covered"),
        mean("avg_temp_c").alias("annual_avg_temp_c"),
        mean("min_temp_c").alias("annual_avg_min_temp_c"),
        mean("max_temp_c").alias("annual_avg_max_temp_c"),
        round_aggregate(F.sum("precip_mm")).alias("annual_precip_mm"),
        mean("avg_wind_mps").alias("annual_avg_wind_mps"),
    ).select(
        *STATION_YEAR_KEYS, F.col("place.latitude").alias("latitude"), F.col("place.longitude").alias("longitude"),
        "days_covered", "annual_avg_temp_c", "annual_avg_min_temp_c", "annual_avg_max_temp_c", "annual_precip_mm",
        "annual_avg_wind_mps",
    )


def source_years(stations: DataFrame) -> DataFrame:
    """Yearly values per source: plain means of the stations' rounded values."""
    return stations.groupBy("source", "year").agg(
        F.count(F.lit(1)).alias("stations_covered"),
        round_aggregate(F.avg("annual_avg_temp_c")).alias("mean_station_temp_c"),
        round_aggregate(F.avg("annual_precip_mm")).alias("mean_station_precip_mm"),
        round_aggregate(F.avg("annual_avg_wind_mps")).alias("mean_station_wind_mps"),
    )


def counts_by_source(daily: DataFrame) -> DataFrame:
    return daily.groupBy("source").count()


def extent_by_year(daily: DataFrame) -> DataFrame:
    """Rows, stated means and first and last day per source and year."""
    return daily.groupBy("source", "year").agg(
        F.count(F.lit(1)).alias("rows"), F.count("avg_temp_c").alias("with_mean"),
        F.min("date").alias("first_day"), F.max("date").alias("last_day"),
    )


def warmest_stations(daily: DataFrame, year: int, n: int = 10) -> DataFrame:
    """The ``n`` highest station means of one year, per station name and source."""
    return (
        daily.filter((F.col("year") == year) & F.col("avg_temp_c").isNotNull())
        .groupBy("station_name", "source")
        .agg(
            round_aggregate(F.avg("avg_temp_c")).alias("yearly_avg_temp_c"),
            F.count(F.lit(1)).alias("days_counted"),
        )
        .orderBy(F.desc("yearly_avg_temp_c"), "station_name", "source")
        .limit(n)
    )


def sample_rows(daily: DataFrame, source: str, day: str, n: int = 8) -> DataFrame:
    """The first ``n`` stations by name of one source on one day."""
    shown = ("source", "date", "station_name", "avg_temp_c", "precip_mm", "avg_wind_mps")
    return (
        daily.filter((F.col("source") == source) & (F.col("date") == F.lit(day).cast("date")))
        .select(*shown)
        .orderBy("station_name", *[F.col(name).asc_nulls_last() for name in shown[3:]])
        .limit(n)
    )


def trend_order(trends: DataFrame) -> DataFrame:
    """A yearly dataset in its published order: newest year, then keys."""
    keys = [name for name in STATION_YEAR_KEYS if name in trends.columns and name != "year"]
    return trends.orderBy(F.desc("year"), *[F.col(name).asc_nulls_first() for name in keys])


def publication_order(daily: DataFrame) -> DataFrame:
    """Rows in files by newest date, then source and station.

    A range shuffle, so that files hold few dates each and readers can skip files. The range
    keys end in a hash of the row: copies of a hot station-day can then be cut apart.
    """
    keys = [F.desc("date"), F.asc("source"), F.asc("source_station_id")]
    spread = F.xxhash64(*[F.col(name) for name in daily.columns])
    return daily.repartitionByRange(*keys, spread).sortWithinPartitions(*keys)


#: Rows that are looked at to cut dates and stations into ranges, and ranges of each as a power of 2.
LAYOUT_SAMPLE = 4096
LAYOUT_BITS = 4


def range_bounds(df: DataFrame, column: str) -> list:
    """Up to 15 values that cut a column into ranges of about as many rows each.

    From a sample of fixed size: the rows of least hash, which each task finds for itself. Bounds decide
    where rows lie, never which rows there are.
    """
    key = F.xxhash64(*[F.col(name) for name in df.columns])
    rows = df.select(F.col(column).alias("value"), key.alias("key")).filter("value IS NOT NULL").orderBy("key", "value").limit(LAYOUT_SAMPLE)
    values = sorted(row.value for row in rows.collect())
    parts = 1 << LAYOUT_BITS
    return sorted({values[len(values) * i // parts] for i in range(1, parts)}) if values else []


def cell_of(date_rank: Column, station_rank: Column) -> Column:
    """The place of a cell on a Z-shaped curve through all cells: the bits of both ranks in turn."""
    cell = F.lit(0)
    for bit in range(LAYOUT_BITS):
        for side, rank in ((1, station_rank), (0, date_rank)):
            cell = cell.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), 2 * bit + side))
    return cell


def cell_order(daily: DataFrame, files: int) -> DataFrame:
    """Rows in files by cells of date range and station range, along a Z-shaped curve.

    ``publication_order`` serves filters by date; here a filter by station skips as many files as one by date. The
    range keys end in a hash of the row, so that a hot cell can be cut apart.
    """
    def rank(column: str) -> Column:
        bounds = range_bounds(daily, column)
        below = [F.when(F.col(column) >= F.lit(bound), 1).otherwise(0) for bound in bounds]
        return sum(below, F.lit(0))

    spread = F.xxhash64(*[F.col(name) for name in daily.columns])
    laid = daily.withColumn("_cell", cell_of(rank("date"), rank("source_station_id")))
    keys = ("_cell", "source_station_id", "date")
    return laid.repartitionByRange(files, "_cell", spread).sortWithinPartitions(*keys).drop("_cell")
