"""Run accounting and data checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.curate import unite
from skyledger.operators.validity import Checks, reason
from skyledger.schemas import RUN_METRICS, conform

COUNTERS = (
    "raw_input_rows", "invalid_rows_removed", "valid_input_rows", "output_rows",
    "rows_consolidated_by_aggregation",
)


class AllStationsFailedError(RuntimeError):
    """A run in which stations failed and nothing was landed."""


def run_metrics(
    rows: DataFrame, checks: Checks, source: str, run_date: str, keys: tuple[str, ...] = ()
) -> DataFrame:
    """One row of counters for a run over normalised rows whose daily rows are grouped by ``keys``.

    Without keys every usable row is one daily row. Rows are first counted per group, unusable
    ones as one group; the final sums then read only the groups.
    """
    usable = reason(checks).isNull()
    if keys:
        groups = rows.groupBy(
            usable.alias("usable"), *[F.when(usable, F.col(key)).alias(key) for key in keys]
        ).agg(F.count(F.lit(1)).alias("n"))
        output = F.count_if("usable")
    else:
        groups = rows.groupBy(usable.alias("usable")).agg(F.count(F.lit(1)).alias("n"))
        output = F.sum(F.when(F.col("usable"), F.col("n")))
    counts = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_input_rows"),
        F.coalesce(F.sum(F.when(F.col("usable"), F.col("n"))), F.lit(0)).alias("valid_input_rows"),
        F.coalesce(output, F.lit(0)).alias("output_rows"),
    )
    return conform(
        counts,
        RUN_METRICS,
        source=F.lit(source),
        run_date=F.lit(run_date),
        invalid_rows_removed=F.col("raw_input_rows") - F.col("valid_input_rows"),
        rows_consolidated_by_aggregation=F.greatest(
            F.lit(0), F.col("valid_input_rows") - F.col("output_rows")
        ),
    )


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """Sums of the counters of all reporting sources, and the number of those."""
    return metrics.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in COUNTERS],
        F.count(F.lit(1)).alias("sources_with_metrics"),
    )


def raw_counts(line_sources: dict[str, DataFrame], payloads: DataFrame, curated: DataFrame) -> DataFrame:
    """Raw records per source (lines, or features of payloads) and curated rows."""
    counted = [
        rows.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("dataset"), "records")
        for name, rows in line_sources.items()
    ]
    counted.append(
        payloads.agg(F.coalesce(F.sum(F.size(F.coalesce("features", F.array()))), F.lit(0)).alias("records"))
        .select(F.lit("nws").alias("dataset"), "records")
    )
    counted.append(
        curated.agg(F.count(F.lit(1)).alias("records")).select(F.lit("climate_daily").alias("dataset"), "records")
    )
    return unite(counted)


def newly_retrieved(source: Column, before: Column, after: Column) -> Column:
    """Records a run added: the growth of an appended source, all records of a rewritten one."""
    return F.when(source == "meteostat", F.greatest(F.lit(0), after - before)).otherwise(after)


def contract_checks(daily: DataFrame) -> DataFrame:
    """Row count, and rows that break the non-null contract, per source."""
    return daily.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("source").isNull()).alias("null_source"),
        F.count_if(F.col("date").isNull()).alias("null_date"),
        F.count_if(F.col("source_station_id").isNull()).alias("null_source_station_id"),
    )


def duplicate_keys(daily: DataFrame) -> DataFrame:
    """Source, station and day keys that more than one row has."""
    return (
        daily.groupBy("source", "source_station_id", "date")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def bad_stations(rows: DataFrame, station: str, bad: Column) -> DataFrame:
    """Stations with a bad row, and how many they have."""
    return rows.filter(bad).groupBy(station).agg(F.count(F.lit(1)).alias("bad_rows"))


def all_or_nothing(rows: DataFrame, station: str, bad: Column) -> DataFrame:
    """Rows of the stations that have no bad row at all.

    Bad stations are collected by a pre-aggregated group-by and removed by an anti join, rather
    than by a window over each station, which would bring a large station into one task.
    """
    return rows.join(bad_stations(rows, station, bad).select(station), station, "left_anti")


def require_some_success(failed: int, landed: int) -> None:
    """Fails a run in which stations failed and nothing was landed."""
    if failed and not landed:
        raise AllStationsFailedError(f"all {failed} stations failed")
