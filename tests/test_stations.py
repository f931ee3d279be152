from __future__ import annotations

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from skyledger.operators import incremental, quality, stations, windows
from skyledger.operators.nearest import nearest_station
from skyledger.schemas import CATALOG, MANIFEST, ddl

START, END = date(2014, 1, 1), date(2023, 12, 31)


def manifest(spark, *rows):
    base = dict.fromkeys(MANIFEST, "") | {"priority_rank": 1}
    return spark.createDataFrame([tuple((base | row).values()) for row in rows], ddl(MANIFEST))


def entry(id, name="Name", country="US", region="AL", national=None, icao=None, lat=33.0, lon=-86.0, start="2000-01-01", end="2024-01-01"):
    return (id, name, country, region, (national, icao), (lat, lon, 100.0), ((start, end),))


def catalog(spark, *entries):
    frame = spark.createDataFrame(
        [(i, *e) for i, e in enumerate(entries)], "position bigint, " + ddl(CATALOG)
    )
    return stations.flatten_catalog(frame)


def resolved(spark, station, *entries):
    rows = stations.resolve_stations(manifest(spark, station), catalog(spark, *entries), START).collect()
    return [(r.meteostat_station_id, r.meteostat_match_type, r.meteostat_station_distance_km) for r in rows]


def failure(spark, station, *entries):
    rows = stations.resolution_failures(manifest(spark, station), catalog(spark, *entries), START, END, "r").collect()
    return [r.error_message for r in rows]


STATION = {
    "noaa_station_id": "GHCND:U1", "nws_station_id": "K1", "meteostat_station_id": "M1", "country": "US", "state": "AL",
    "latitude": "33.0", "longitude": "-86.0",
}


def test_resolution_order(spark):
    by_id, national, icao = entry("M1"), entry("M2", national="U1"), entry("M3", icao="K1")
    assert resolved(spark, STATION, icao, national, by_id) == [("M1", "meteostat_station_id", None)]
    assert resolved(spark, STATION, icao, national) == [("M2", "national", None)]
    assert resolved(spark, STATION, icao) == [("M3", "icao", None)]
    assert resolved(spark, STATION, entry("M9", lat=33.1)) == [("M9", "nearest", 11.12)]


def test_hit_without_coverage_falls_through(spark):
    late = entry("M1", start="2015-01-01")
    assert resolved(spark, STATION, late, entry("M3", icao="K1")) == [("M3", "icao", None)]
    assert resolved(spark, STATION, entry("M1", start=None), entry("M3", icao="K1")) == [("M3", "icao", None)]
    assert resolved(spark, STATION, entry("M1", end="2013-01-01"), entry("M4")) == [("M4", "nearest", 0.0)]


def test_last_of_repeated_codes_counts(spark):
    assert resolved(spark, STATION, entry("M5", icao="K1"), entry("M6", icao="K1")) == [("M6", "icao", None)]
    # The last one lacks coverage: the earlier one with the same code is not tried.
    assert resolved(
        spark, STATION | {"latitude": "33.2"}, entry("M5", icao="K1"), entry("M6", icao="K1", start="2020-01-01")
    ) == [("M5", "nearest", 22.24)]


def test_nearest_country_and_region(spark):
    near_abroad, far_home = entry("A", country="CA", lat=33.0), entry("B", lat=33.5)
    assert resolved(spark, STATION, near_abroad, far_home) == [("B", "nearest", 55.6)]
    assert resolved(spark, STATION, near_abroad) == [("A", "nearest", 0.0)]
    blank = entry("C", country=None, region=None, lat=33.2)
    assert resolved(spark, STATION, near_abroad, far_home, blank) == [("C", "nearest", 22.24)]
    assert resolved(spark, STATION | {"country": ""}, near_abroad, far_home) == [("A", "nearest", 0.0)]
    assert resolved(spark, STATION, entry("D", region="GA")) == []
    assert resolved(spark, STATION | {"state": ""}, entry("D", region="GA")) == [("D", "nearest", 0.0)]


def test_ties_go_to_the_first(spark):
    assert resolved(spark, STATION, entry("A", lat=33.1), entry("B", lat=33.1)) == [("A", "nearest", 11.12)]
    assert resolved(spark, STATION, entry("B", lon=-86.1), entry("A", lon=-85.9))[0][0] == "B"


def test_query_coordinates_come_first(spark):
    station = STATION | {"meteostat_query_latitude": "40.0", "meteostat_query_longitude": ""}
    assert resolved(spark, station, entry("A", lat=33.0), entry("B", lat=40.0)) == [("B", "nearest", 0.0)]


def test_failures_name_their_reason(spark):
    assert failure(spark, STATION, entry("A")) == []
    assert failure(spark, STATION, entry("A", lat=34.0)) == [
        "Nearest Meteostat station for GHCND:U1 is too far away (111.2 km)"
    ]
    assert failure(spark, STATION, entry("A", region="GA")) == [
        "No Meteostat station with daily coverage found for GHCND:U1"
    ]
    assert failure(spark, STATION | {"latitude": "x"}, entry("A")) == [
        "Station is missing identifiers and coordinates for Meteostat: GHCND:U1"
    ]
    assert failure(spark, STATION | {"latitude": ""}, entry("A", icao="K1")) == []


def test_translated_names(spark):
    flat = catalog(spark, entry("A", name='{"en": "Rome", "it": "Roma"}'), entry("B", name="Oslo"), entry("C", name=None))
    assert {r.id: r.name for r in flat.select("id", "name").collect()} == {"A": "Rome", "B": "Oslo", "C": None}


def km(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    dp, dl = p2 - p1, math.radians(lon2) - math.radians(lon1)
    a = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, a)))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nearest_against_brute_force(spark, seed):
    """Scattered stations, a dense cluster with a third of everything, poles and the date line."""
    rng = random.Random(seed)

    def place():
        kind = rng.random()
        if kind < 0.35:
            return 48.0 + rng.gauss(0, 0.001), 11.0 + rng.gauss(0, 0.001)
        if kind < 0.45:
            return rng.choice([89.9, -89.9]) + rng.uniform(-0.1, 0.1), rng.uniform(-180, 180)
        if kind < 0.55:
            return rng.uniform(-5, 5), rng.choice([179.9, -179.9]) + rng.uniform(-0.09, 0.09)
        return math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)

    countries, regions = ["US", "CA", "MX", ""], ["AL", "GA", ""]
    items = [(i, *place(), rng.choice(countries) or None, rng.choice(regions) or None) for i in range(400)]
    items += [(1000 + i, *rng.choice(items)[1:3], "US", "AL") for i in range(20)]
    asked = [(*place(), rng.choice(countries + ["FR"]), rng.choice(regions + ["XX"])) for _ in range(150)]

    def accepts(query, item, with_country):
        _, _, country, state = query
        return (not with_country or not country or item[3] in (None, country)) and (not state or item[4] in (None, state))

    want = {}
    for query in asked:
        for with_country in (True, False):
            found = [(km(*query[:2], *item[1:3]), item[0]) for item in items if accepts(query, item, with_country)]
            if found:
                want[query] = min(found)
                break
    got = nearest_station(
        spark.createDataFrame(asked + asked[:30], "query_latitude double, query_longitude double, country string, state string"),
        spark.createDataFrame(items, "position bigint, latitude double, longitude double, country string, region string"),
    ).collect()
    assert len(got) == len(want)
    for row in got:
        distance, position = want[tuple(row)[:4]]
        assert row.km == pytest.approx(distance, rel=1e-9, abs=1e-9)
        assert row.position == position


def test_manifest_slice(spark):
    rows = [{"noaa_station_id": f"S{i:02}", "priority_rank": i, "ingest_enabled": flag}
            for i, flag in enumerate(["TRUE", "no", "", "yes", "0", "1", " Y ", "TRUE"])]
    frame = manifest(spark, *rows)

    def ids(**kwargs):
        return sorted(r.noaa_station_id for r in stations.slice_manifest(frame, **kwargs).collect())

    assert ids() == ["S00", "S02", "S03", "S05", "S06", "S07"]
    assert ids(offset=1, limit=2) == ["S02", "S03"]
    assert ids(offset=4, limit=10) == ["S06", "S07"]
    assert ids(limit=0) == [] and ids(offset=9) == []
    assert ids(offset=1, limit=2, only_enabled=False) == ["S01", "S02"]
    with pytest.raises(ValueError):
        stations.slice_manifest(frame, offset=-1)
    assert stations.batch_offset(3, 10) == 20
    with pytest.raises(ValueError):
        stations.batch_offset(0, 10)


def test_numbering_is_gapless_with_shared_and_missing_ranks(spark):
    frame = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") * 17)
        .cast("int").alias("rank"),
        F.concat(F.lit("S"), F.col("id")).alias("tie"),
    )
    rows = stations.number_in_order(frame, "rank", "tie").collect()
    assert sorted(r.ordinal for r in rows) == list(range(20000))
    ranks = [r["rank"] for r in sorted(rows, key=lambda r: r.ordinal)]
    assert ranks == sorted(ranks, key=lambda r: (r is None, r))


def test_resume_and_prune(spark):
    listed = manifest(
        spark, {"noaa_station_id": "A", "nws_station_id": "KA"}, {"noaa_station_id": "B", "nws_station_id": "KB"},
        {"noaa_station_id": "", "nws_station_id": "KC"},
    )
    landed = spark.createDataFrame([("A",), ("A",), ("",), (None,)], "noaa_station_id string")
    pending = incremental.pending_stations(listed, landed).collect()
    assert sorted(r.nws_station_id for r in pending) == ["KB", "KC"]
    rows = spark.createDataFrame([("KA", 1), ("KA", 2), ("KX", 3), (None, 4)], "station string, n int")
    assert sorted(r.n for r in incremental.prune_to_manifest(rows, listed).collect()) == [1, 2]
    assert [r.station for r in incremental.stale_stations(rows.filter("station is not null"), listed).collect()] == ["KX"]


def test_all_or_nothing(spark):
    rows = spark.createDataFrame([("A", 1), ("A", -1), ("B", 2), ("B", 3)], "station string, n int")
    kept = quality.all_or_nothing(rows, "station", F.col("n") < 0).collect()
    assert sorted(r.n for r in kept) == [2, 3]
    assert [tuple(r) for r in quality.bad_stations(rows, "station", F.col("n") < 0).collect()] == [("A", 1)]


def test_year_windows(spark):
    ranges = spark.createDataFrame(
        [(1, date(2022, 6, 1), date(2024, 2, 1)), (2, date(2024, 1, 1), date(2023, 1, 1))], "id int, start_date date, end_date date"
    )
    got = windows.year_windows(ranges).orderBy("window_start").collect()
    assert [(r.window_start.isoformat(), r.window_end.isoformat()) for r in got] == [
        ("2022-06-01", "2022-12-31"), ("2023-01-01", "2023-12-31"), ("2024-01-01", "2024-02-01"),
    ]
