"""The station manifest, and resolving its stations against a catalogue."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.dates import covers_day, day_date
from skyledger.functions.values import first_present, number, present, station_code, truthy
from skyledger.operators.nearest import QUERY, nearest_station

# Match types in order of precedence, the distance limit, and failure messages.
BY_ID, BY_NATIONAL, BY_ICAO, BY_DISTANCE = "meteostat_station_id", "national", "icao", "nearest"
MAX_DISTANCE_KM = 100
NO_COORDINATES = "Station is missing identifiers and coordinates for Meteostat: %s"
NO_CANDIDATE = "No Meteostat station with daily coverage found for %s"
TOO_FAR = "Nearest Meteostat station for %s is too far away (%.1f km)"
ERROR_TYPE = "ValueError"

UNRANKED = 2 ** 31 - 1


def enabled_stations(manifest: DataFrame) -> DataFrame:
    return manifest.filter(truthy(F.col("ingest_enabled")))


def number_in_order(rows: DataFrame, rank: str, tie: str) -> DataFrame:
    """Adds ``ordinal``, a row's zero-based place by ``rank``; unranked rows come last.

    A window over the whole table would sort it in one task. Rows are counted per rank instead
    (a shared rank in 64 parts, by a hash of ``tie``), places of whole blocks of ranks are summed
    up, and only rows within one part of one rank are numbered by a window.
    """
    placed = rows.withColumns({
        "_rank": F.coalesce(F.col(rank), F.lit(UNRANKED)),
        "_part": F.pmod(F.xxhash64(tie), F.lit(64)),
    }).withColumn("_block", F.shiftright("_rank", 12))
    parts = placed.groupBy("_block", "_rank", "_part").agg(F.count(F.lit(1)).alias("_n"))
    blocks = parts.groupBy("_block").agg(F.sum("_n").alias("_n"))

    def before(window: Window) -> Column:
        return F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    block_starts = blocks.select("_block", before(Window.orderBy("_block")).alias("_block_start"))
    part_starts = parts.select(
        "_block", "_rank", "_part",
        before(Window.partitionBy("_block").orderBy("_rank", "_part")).alias("_part_start"),
    )
    within = Window.partitionBy("_block", "_rank", "_part").orderBy(tie, F.xxhash64(*rows.columns))
    return (
        placed.withColumn("_place", F.row_number().over(within) - 1)
        .join(part_starts, ["_block", "_rank", "_part"])
        .join(block_starts, "_block")
        .select(*rows.columns, (F.col("_block_start") + F.col("_part_start") + F.col("_place")).alias("ordinal"))
    )


def batch_offset(index: int, size: int) -> int:
    """Offset of a 1-based batch."""
    if size <= 0 or index <= 0:
        raise ValueError("batch size and index must be greater than zero")
    return (index - 1) * size


def slice_manifest(
    manifest: DataFrame, offset: int = 0, limit: int | None = None, only_enabled: bool = True
) -> DataFrame:
    """Enabled manifest rows from ``offset`` on, in manifest order, at most ``limit`` of them."""
    if offset < 0:
        raise ValueError("offset must be zero or greater")
    rows = enabled_stations(manifest) if only_enabled else manifest
    wanted = F.col("ordinal") >= offset
    if limit is not None:
        wanted &= F.col("ordinal") < offset + limit
    return number_in_order(rows, "priority_rank", "noaa_station_id").filter(wanted)


def flatten_catalog(catalog: DataFrame) -> DataFrame:
    """Plain columns of catalogue records; the name may be text or a set of translations."""
    def inventory(bound: str) -> Column:
        return day_date(F.col(f"inventory.daily.{bound}"))

    english = F.when(F.col("name").startswith("{"), F.get_json_object("name", "$.en"))
    return catalog.select(
        "position",
        "id",
        F.coalesce(english, F.when(~F.col("name").startswith("{"), F.col("name"))).alias("name"),
        present(F.col("country")).alias("country"),
        present(F.col("region")).alias("region"),
        present(F.col("identifiers.national")).alias("national"),
        present(F.col("identifiers.icao")).alias("icao"),
        number(F.col("location.latitude")).alias("latitude"),
        number(F.col("location.longitude")).alias("longitude"),
        number(F.col("location.elevation")).alias("elevation"),
        inventory("start").alias("daily_start"),
        inventory("end").alias("daily_end"),
    )


def _identifier_index(catalog: DataFrame) -> DataFrame:
    """Catalogue positions by kind of identifier and its value; of repeated ones the last counts."""
    identifiers = F.array(*[
        F.struct(F.lit(order).alias("precedence"), F.col(column).alias("identifier"))
        for order, column in enumerate(("id", "national", "icao"))
    ])
    return (
        catalog.select("position", "daily_start", "daily_end", F.explode(identifiers).alias("key"))
        .select("key.*", "position", "daily_start", "daily_end")
        .filter(F.col("identifier") != "")
        .groupBy("precedence", "identifier")
        .agg(
            F.max("position").alias("position"),
            F.max_by("daily_start", "position").alias("daily_start"),
            F.max_by("daily_end", "position").alias("daily_end"),
        )
    )


def match_identifiers(manifest: DataFrame, catalog: DataFrame, start: date) -> DataFrame:
    """Per manifest row, the catalogue position its identifiers lead to, if any.

    A station's own id comes first, then its national and its ICAO code. A hit counts only if
    the station's daily data reach back to ``start``; if not, the next identifier is tried. The
    identifiers are joined as rows of their own, so blank ones take no part in the shuffle.
    """
    columns = manifest.columns
    identifiers = F.array(*[
        F.struct(F.lit(order).alias("precedence"), value.alias("identifier"))
        for order, value in enumerate((
            F.col("meteostat_station_id"),
            station_code(F.col("noaa_station_id")),
            F.col("nws_station_id"),
        ))
    ])
    hits = (
        manifest.withColumn("key", F.explode(identifiers))
        .select(*columns, "key.*")
        .filter(F.col("identifier") != "")
        .join(_identifier_index(catalog), ["precedence", "identifier"])
        .filter(covers_day(F.col("daily_start"), F.col("daily_end"), F.lit(start)))
        .select(*columns, "precedence", "position")
    )
    missed = manifest.select(
        *columns, F.lit(None).cast("int").alias("precedence"), F.lit(None).cast("bigint").alias("position")
    )
    best = F.min("precedence")
    match_type = F.when(best == 0, F.lit(BY_ID)).when(best == 1, F.lit(BY_NATIONAL)).when(best == 2, F.lit(BY_ICAO))
    return hits.unionByName(missed).groupBy(*columns).agg(
        match_type.alias("match_type"), F.min_by("position", "precedence").alias("position")
    )


def query_place(latitude: Column, longitude: Column, query_latitude: Column, query_longitude: Column) -> tuple[Column, Column]:
    """Where to search from: the query coordinates, else the station's own."""
    return number(first_present(query_latitude, latitude)), number(first_present(query_longitude, longitude))


def match_stations(manifest: DataFrame, catalog: DataFrame, start: date) -> DataFrame:
    """Distinct manifest rows with match type, catalogue position, distance and failure message.

    Those without a usable identifier get the nearest station whose data reach back to
    ``start``, unless it is too far away. Exactly one of position and message is set.
    """
    columns = manifest.columns
    latitude, longitude = query_place(*[
        F.col(name)
        for name in ("latitude", "longitude", "meteostat_query_latitude", "meteostat_query_longitude")
    ])
    matched = match_identifiers(manifest, catalog, start).withColumns({"_lat": latitude, "_lon": longitude})
    located = F.col("_lat").isNotNull() & F.col("_lon").isNotNull()
    searching = F.col("position").isNull() & located

    def query(lat: Column, lon: Column, country: Column, state: Column) -> Column:
        return F.struct(*[part.alias(name) for name, part in zip(QUERY, (lat, lon, country, state))])

    # Rows that are not searched for meet no answer. They get keys of their own all the same, so
    # that the join spreads them.
    nowhere = F.lit(None).cast("double")
    keyed = matched.withColumn("query", F.when(
        searching, query(F.col("_lat"), F.col("_lon"), F.coalesce("country", F.lit("")), F.coalesce("state", F.lit("")))
    ).otherwise(query(nowhere, nowhere, F.col("noaa_station_id"), F.col("station_name"))))
    reaching_back = catalog.filter(covers_day(F.col("daily_start"), F.col("daily_end"), F.lit(start)))
    found = nearest_station(keyed.filter(searching).select("query.*"), reaching_back).select(
        F.struct(*QUERY).alias("query"), F.col("position").alias("found"), "km"
    )
    near = F.col("km") <= MAX_DISTANCE_KM
    return keyed.join(found, "query", "left").select(
        *columns,
        F.coalesce("match_type", F.when(near, F.lit(BY_DISTANCE))).alias("match_type"),
        F.coalesce("position", F.when(near, F.col("found"))).alias("position"),
        F.when(near, F.round("km", 2)).alias("distance_km"),
        F.when(F.col("position").isNotNull() | near, F.lit(None))
        .when(~located, F.format_string(NO_COORDINATES, "noaa_station_id"))
        .when(F.col("km").isNull(), F.format_string(NO_CANDIDATE, "noaa_station_id"))
        .otherwise(F.format_string(TOO_FAR, "noaa_station_id", "km"))
        .alias("error_message"),
    )


def resolve_stations(manifest: DataFrame, catalog: DataFrame, start: date) -> DataFrame:
    """Manifest rows with the catalogue station each one is resolved to."""
    return resolved_rows(match_stations(manifest, catalog, start), catalog)


def resolved_rows(matched: DataFrame, catalog: DataFrame) -> DataFrame:
    """The same from matches at hand, so that one search serves rows and failures."""
    stations = catalog.select(
        "position",
        F.col("id").alias("meteostat_station_id"),
        F.col("name").alias("meteostat_station_name"),
        F.col("latitude").alias("meteostat_station_latitude"),
        F.col("longitude").alias("meteostat_station_longitude"),
        F.col("elevation").alias("meteostat_station_elevation_m"),
    )
    return (
        matched.filter(F.col("position").isNotNull())
        .drop("meteostat_station_id")
        .withColumnsRenamed({"match_type": "meteostat_match_type", "distance_km": "meteostat_station_distance_km"})
        .join(stations, "position")
        .drop("position", "error_message")
    )


def resolution_failures(manifest: DataFrame, catalog: DataFrame, start: date, end: date, run_date: str) -> DataFrame:
    """Ledger rows of the manifest stations that cannot be resolved, with the reason."""
    return failure_rows(match_stations(manifest, catalog, start), start, end, run_date)


def failure_rows(matched: DataFrame, start: date, end: date, run_date: str) -> DataFrame:
    return (
        matched.filter(F.col("error_message").isNotNull())
        .select(
            F.lit(run_date).alias("run_date"),
            F.lit("meteostat").alias("source"),
            "noaa_station_id", "nws_station_id", "station_name", "state",
            F.lit(start).cast("string").alias("start_date"),
            F.lit(end).cast("string").alias("end_date"),
            F.lit(ERROR_TYPE).alias("error_type"),
            "error_message",
        )
    )
