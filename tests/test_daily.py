from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from skyledger.operators import curate, long_rows, observations, quality, wide_rows
from skyledger.operators.validity import REASON, UnusableRowError, accepted, guarded, raising_unusable, reason, rejected
from skyledger.schemas import DAILY, OBSERVATION_PROPERTIES, RAW_LONG, RAW_OBSERVATIONS, RAW_WIDE, MissingColumnsError, ddl

LONG = "noaa_station_id string, station_name string, state string, country string, latitude string, " \
       "longitude string, run_date string, date string, datatype string, value double"


def long(spark, *rows):
    return spark.createDataFrame(
        [(station, "Name", "AL", "US", "33.5", "bad", run, day, kind, value)
         for station, run, day, kind, value in rows], LONG
    )


def test_long_rows_pivot_to_days(spark):
    nan = float("nan")
    raw = long(
        spark,
        ("S1", "r1", "2024-01-01", "TMIN", 1.0), ("S1", "r1", "2024-01-01", "TMAX", 4.25),
        ("S1", "r1", "2024-01-01", "TMAX", 4.0), ("S1", "r1", "2024-01-01", "PRCP", None),
        ("S1", "r1", "2024-01-02", "TAVG", 2.123), ("S1", "r1", "2024-01-02", "TMIN", 0.0),
        ("S1", "r1", "2024-01-02", "TMAX", 9.0), ("S1", "r1", "2024-01-03", "SNWD", 7.0),
        ("S1", "r1", "2024-01-04", "TMIN", 7.0), ("S1", "r2", "2024-01-04", "TMIN", 8.0),
        ("S1", "r1", "2024-01-05", "SNOW", nan), ("S1", "r1", "2024-01-05", "SNOW", 3.0),
        (None, "r1", "2024-01-01", "TMAX", 1.0), ("S1", "r1", "soon", "TMAX", 1.0), ("S1", "r1", "2024-01-01", None, 1.0),
    )
    daily = long_rows.long_to_daily(raw)
    assert daily.columns == list(DAILY)
    got = {
        (row.date.day, row.ingest_run_date): (row.avg_temp_c, row.min_temp_c, row.max_temp_c, row.snow_mm, row.obs_count)
        for row in daily.collect()
    }
    assert got == {
        (1, "r1"): (2.63, 1.0, 4.25, None, 4),
        (2, "r1"): (2.123, 0.0, 9.0, None, 3),
        (3, "r1"): (None, None, None, None, 1),
        (4, "r1"): (None, 7.0, None, None, 1),
        (4, "r2"): (None, 8.0, None, None, 1),
        (5, "r1"): (None, None, None, 3.0, 2),
    }
    first = daily.first()
    assert (first.source, first.latitude, first.longitude, first.max_wind_mps) == ("noaa", 33.5, None, None)


def mark(raw):
    return long_rows.normalize_long(raw).withColumn(REASON, reason(long_rows.CHECKS))


def test_long_rejects_name_their_reason(spark):
    marked = mark(long(
        spark, (None, "r", "2024-01-01", None, 1.0), ("S", "r", "2024-01-01", None, 1.0), ("S", "r", "x", "TMAX", 1.0),
        ("S", "r", "2024-01-01", "TMAX", None),
    ))
    assert sorted(str(row[REASON]) for row in marked.collect()) == [
        "None", "bad_date", "missing_datatype", "missing_station",
    ]


def test_missing_columns_fail_at_once(spark):
    raw = long(spark, ("S", "r", "2024-01-01", "TMAX", 1.0)).drop("value", "state")
    with pytest.raises(MissingColumnsError, match="state, value"):
        long_rows.long_to_daily(raw)


def test_on_error_fail(spark):
    rows = long_rows.normalize_long(long(spark, ("S", "r", "x", "TMAX", 1.0), ("S", "r", "2024-01-01", "TMAX", 1.0)))
    assert [r[REASON] for r in rejected(rows, long_rows.CHECKS).collect()] == ["bad_date"]
    # Also where the very next step would leave the row out.
    with pytest.raises(UnusableRowError, match="unusable row: bad_date"), raising_unusable():
        accepted(guarded(rows, long_rows.CHECKS), long_rows.CHECKS).count()
    good = rows.filter("day IS NOT NULL")
    assert guarded(good, long_rows.CHECKS).count() == good.count()


GHCN = "station_id string, raw_day string, datatype string, raw_value string, mflag string, qflag string, sflag string, obs_time string"
STATIONS = "noaa_station_id string, station_name string, state string, country string, latitude string, longitude string, nws_station_id string"


def test_ghcn_station_rows(spark):
    lines = spark.createDataFrame([
        ("USW1", "20240101", "TMAX", "123", None, "", "W", "2400"), ("USW1", "20240131", "SNOW", "12", "P", None, None, None),
        ("USW1", "20231231", "TMAX", "1", None, None, None, None), ("USW1", "20240201", "TMAX", "1", None, None, None, None),
        ("USW1", "20240101", "WT01", "1", None, None, None, None), ("USW1", "20240199", "TMAX", "1", None, None, None, None),
        ("OTHER", "20240101", "TMAX", "1", None, None, None, None),
    ], GHCN)
    manifest = spark.createDataFrame([("GHCND:USW1", "One", "AL", "US", "1", "2", "K1"), ("", "Blank", "", "", "", "", "")], STATIONS)
    rows = long_rows.station_rows(lines, manifest, date(2024, 1, 1), date(2024, 1, 31), "2024-02-01")
    assert rows.columns == list(RAW_LONG)
    got = sorted((r.noaa_station_id, r.date, r.datatype, r.value, r.attributes, r.station_name) for r in rows.collect())
    assert got == [
        ("GHCND:USW1", "2024-01-01", "TMAX", 12.3, "mflag=,qflag=,sflag=W,obs_time=2400", "One"),
        ("GHCND:USW1", "2024-01-31", "SNOW", 12.0, "mflag=P,qflag=,sflag=,obs_time=", "One"),
    ]


def feature(station="K1", at="2024-01-02T12:00:00+00:00", temp=10.0, wind=36.0, unit="wmoUnit:km_h-1", name="N",
            place=(-86.0, 33.0), own="o1", fid="f1"):
    geometry = None if place is None else ("Point", list(place))
    return (fid, geometry, (own, "st", station, name, at, "Clear", (temp, "wmoUnit:degC"), (wind, unit)))


def payloads(spark, *documents):
    return spark.createDataFrame(
        [(f"file:/d/raw/nws/run_date={run}/station=X/nws_raw.json", list(features)) for run, features in documents],
        "path string, " + ddl(RAW_OBSERVATIONS),
    )


MANIFEST = STATIONS


def test_observations_to_days(spark):
    documents = payloads(
        spark,
        ("2024-01-03", [
            feature(at="2024-01-02T04:59:59+00:00", temp=1.0, wind=None, name="Late", place=(-1.0, 1.0)),
            feature(at="2024-01-02T05:00:00+00:00", temp=2.0, name=None, place=None),
            feature(at="2024-01-02T06:00:00+00:00", temp=3.0, wind=5.0, unit="wmoUnit:m_s-1", name="First", place=(-2.0, 2.0)),
            feature(at="2024-01-02T07:00:00+00:00", temp=None, wind=7.0, unit=None, name="Second", place=(-3.0, 3.0)),
            feature(at="2024-01-02T08:00:00+00:00", temp=None, wind=None),
            feature(station=None), feature(at="whenever"),
        ]),
        ("2024-01-03", []),
        ("2024-01-03", [feature(station="K2", place=(-5.0,), name="Two")]),
    )
    exploded = observations.explode_features(documents)
    assert exploded.count() == 9
    manifest = spark.createDataFrame(
        [("G1", "Manifest One", "AL", "US", "33.3", "x", "K1"), ("G0", "No id", "AL", "US", "1", "1", None)], MANIFEST
    )
    daily = observations.observations_to_daily(exploded, manifest)
    assert daily.columns == list(DAILY)
    got = {
        (r.source_station_id, r.date.day): (
            r.noaa_station_id, r.station_name, r.latitude, r.longitude, r.obs_count, r.avg_temp_c, r.min_temp_c,
            r.max_temp_c, r.avg_wind_mps, r.max_wind_mps, r.ingest_run_date,
        )
        for r in daily.collect()
    }
    assert got == {
        ("K1", 1): ("G1", "Manifest One", 33.3, -1.0, 1, 1.0, 1.0, 1.0, None, None, "2024-01-03"),
        ("K1", 2): ("G1", "Manifest One", 33.3, -2.0, 3, 2.5, 2.0, 3.0, 7.33, 10.0, "2024-01-03"),
        ("K2", 2): (None, "Two", None, -5.0, 1, 10.0, 10.0, 10.0, 10.0, 10.0, "2024-01-03"),
    }
    reasons = (
        observations.normalize_observations(exploded).groupBy(reason(observations.CHECKS).alias(REASON)).count().collect()
    )
    assert {r[REASON]: r["count"] for r in reasons} == {
        None: 5, "missing_station": 2, "bad_timestamp": 1, "no_measure": 1,
    }


def test_zone_column(spark):
    documents = payloads(spark, ("r", [feature(at="2024-01-02T07:00:00+00:00")]))
    exploded = observations.explode_features(documents).withColumn("zone", F.lit("America/Los_Angeles"))
    assert observations.normalize_observations(exploded, F.col("zone")).first().day == date(2024, 1, 1)


def test_run_date_of_path(spark):
    paths = ["file:/d/raw/nws/run_date=2024-01-03/station=K/nws_raw.json", "file:/d/raw/2024-01-04/nws_raw.json", "x"]
    frame = spark.createDataFrame([(p,) for p in paths], "path string")
    got = [r[0] for r in frame.select(observations.run_date_of_path(F.col("path"))).collect()]
    assert got == ["2024-01-03", "2024-01-04", ""]


def test_raw_documents(spark):
    documents = payloads(spark, ("2024-01-03", [feature(own=None, fid="f9"), feature(own="o1"), feature(own=None, fid=None)]), ("r", []))
    got = observations.raw_observation_documents(observations.explode_features(documents)).collect()
    assert sorted(r._id for r in got) == ["f9", "o1"]
    assert got[0].properties["@id"] in (None, "o1") and got[0].geometry.coordinates == [-86.0, 33.0]
    assert OBSERVATION_PROPERTIES.startswith("struct<`@id`")


def test_observation_samples(spark):
    documents = payloads(spark, ("r", [feature(temp=21.26, wind=36.0), feature(at="2024-01-02T13:00:00+00:00", temp=None, wind=5.0, unit=None)]))
    got = observations.observation_samples(observations.explode_features(documents), 10).collect()
    assert [(r.temperature, r.wind) for r in got] == [("21.3°C", "10.00 m/s"), ("N/A", "5.000")]


def wide(spark, rows, fields=RAW_WIDE):
    base = dict.fromkeys(fields)
    return spark.createDataFrame([tuple((base | row).values()) for row in rows], ddl(fields))


USABLE = {"noaa_station_id": "G1", "meteostat_station_id": "M1", "date": "2024-01-01", "run_date": "r", "latitude": "1.5"}


def test_wide_rows_to_days(spark):
    rows = [
        USABLE | {"temp": 1.0, "wspd": 36.0, "wpgt": 72.0, "snwd": 2.0},
        USABLE | {"wpgt": 3.6}, USABLE, USABLE | {"temp": float("nan")},
        USABLE | {"temp": 1.0, "noaa_station_id": None}, USABLE | {"temp": 1.0, "meteostat_station_id": None},
        USABLE | {"temp": 1.0, "date": "x"},
    ]
    daily = wide_rows.wide_to_daily(wide(spark, rows))
    assert daily.columns == list(DAILY)
    got = sorted((r.avg_temp_c is None, r.avg_wind_mps, r.max_wind_mps, r.snow_mm, r.obs_count) for r in daily.collect())
    assert got == [(False, 10.0, 20.0, 20.0, 1), (True, None, 1.0, None, 1)]
    without_gusts = {k: v for k, v in RAW_WIDE.items() if k != "wpgt"}
    assert wide_rows.wide_to_daily(wide(spark, [USABLE | {"temp": 1.0}], without_gusts)).first().max_wind_mps is None


def test_metrics_add_up(spark):
    rows = [("S1", "r", "2024-01-01", "TMAX", 1.0)] * 3 + [("S2", "r", "2024-01-01", "TMAX", 1.0), (None, "r", "x", "T", 1.0)]
    typed = long_rows.normalize_long(long(spark, *rows))
    metrics = quality.run_metrics(typed, long_rows.CHECKS, "noaa", "r", long_rows.DAILY_KEYS)
    assert tuple(metrics.first()) == ("noaa", "r", 5, 1, 4, 2, 2)
    nothing = quality.run_metrics(typed.limit(0), long_rows.CHECKS, "noaa", "r", long_rows.DAILY_KEYS)
    assert tuple(nothing.first()) == ("noaa", "r", 0, 0, 0, 0, 0)
    one_to_one = quality.run_metrics(
        wide_rows.normalize_wide(wide(spark, [USABLE, USABLE | {"temp": 1.0}])), wide_rows.CHECKS, "meteostat", "r"
    )
    assert tuple(one_to_one.first()) == ("meteostat", "r", 2, 1, 1, 1, 0)
    summary = quality.metrics_summary(curate.unite([metrics, one_to_one]))
    assert tuple(summary.first()) == (7, 2, 5, 3, 2, 2)
    quality.require_some_success(0, 0)
    with pytest.raises(quality.AllStationsFailedError):
        quality.require_some_success(2, 0)


def test_union_and_rollups(spark):
    full = ", ".join(f"{k} {v}" for k, v in DAILY.items())

    def day(source, station, on, temp, rain=None, lat=1.0):
        values = {"source": source, "date": on, "noaa_station_id": station, "source_station_id": station, "station_name": "N",
                  "avg_temp_c": temp, "precip_mm": rain, "latitude": lat, "obs_count": 1}
        return tuple(values.get(name) for name in DAILY)

    noaa = spark.createDataFrame([
        day("noaa", "A", date(2024, 1, 1), 1.0, 0.1, None), day("noaa", "A", date(2024, 1, 2), 2.0, 0.2),
        day("noaa", "A", date(2024, 1, 3), None), day("noaa", "B", date(2024, 1, 1), None),
        day("noaa", None, date(2024, 1, 1), 5.0), day("noaa", None, date(2024, 5, 1), 6.0), day("noaa", "A", date(2023, 1, 1), 9.0),
    ], full)
    narrow = spark.createDataFrame([day("nws", "A", date(2024, 1, 1), 3.0)], full).drop("snow_mm").withColumn("obs_count", F.lit(1))
    daily = curate.climate_daily([noaa, narrow])
    assert daily.count() == 8 and dict(daily.dtypes)["obs_count"] == "bigint"
    years = curate.station_years(daily)
    got = {(r.source, r.noaa_station_id, r.year): (r.latitude, r.days_covered, r.annual_avg_temp_c, r.annual_precip_mm) for r in years.collect()}
    assert got == {
        ("noaa", "A", 2024): (1.0, 3, 1.5, 0.3), ("noaa", "B", 2024): (1.0, 1, None, None),
        ("noaa", None, 2024): (1.0, 2, 5.5, None), ("noaa", "A", 2023): (1.0, 1, 9.0, None), ("nws", "A", 2024): (1.0, 1, 3.0, None),
    }
    sources = {(r.source, r.year): (r.stations_covered, r.mean_station_temp_c) for r in curate.source_years(years).collect()}
    assert sources == {("noaa", 2024): (3, 3.5), ("noaa", 2023): (1, 9.0), ("nws", 2024): (1, 3.0)}
    latest = curate.trend_order(years).take(2)
    assert [(r.year, r.source, r.noaa_station_id) for r in latest] == [(2024, "noaa", None), (2024, "noaa", "A")]
    assert [r["rows"] for r in quality.duplicate_keys(daily).collect()] == []
    assert quality.duplicate_keys(daily.union(daily)).count() == 8
    # The place of a station-year is one that its days state, not the least of each coordinate.
    moved = curate.climate_daily([spark.createDataFrame([
        day("noaa", "A", date(2024, 1, n + 1), 1.0, None, lat) for n, lat in enumerate((20.0, 10.0, None))
    ], full).withColumn("longitude", F.when(F.col("latitude") == 10, 50.0).otherwise(30.0))])
    assert [(r.latitude, r.longitude, r.days_covered) for r in curate.station_years(moved).collect()] == [(10.0, 50.0, 3)]
    with pytest.raises(ValueError):
        curate.unite([])
