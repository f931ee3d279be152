from __future__ import annotations

import json
from datetime import date

import pytest

from skyledger.operators import incremental
from skyledger.operators.quality import AllStationsFailedError
from skyledger.operators.validity import UnusableRowError
from skyledger.plans import runs
from skyledger.schemas import CLIMATE_DAILY, DAILY, SOURCE_YEAR, STATION_YEAR, MissingColumnsError
from skyledger.sources import raw, tables
from test_sources import LONG, lines, payload, put

MANIFEST = (
    "noaa_station_id,station_name,state,country,ingest_enabled,priority_rank,latitude,longitude,nws_station_id,"
    "meteostat_station_id\n"
    "GHCND:U1,One,AL,US,TRUE,1,33.0,-86.0,K1,\nGHCND:U2,Two,AL,US,TRUE,2,33.5,-86.0,K2,M2\n"
    "GHCND:U3,Three,AL,US,TRUE,3,60.0,10.0,K3,\n"
)
START, END, RUN = date(2023, 12, 1), date(2024, 1, 31), "2024-02-01"


def station(id, lat, **extra):
    return {"id": id, "name": {"en": id}, "country": "US", "region": "AL", "location": {"latitude": lat, "longitude": -86.0},
            "inventory": {"daily": {"start": "2000-01-01", "end": "2024-02-01"}}, **extra}


@pytest.fixture
def landing(tmp_path):
    put(tmp_path / "manifest.csv", MANIFEST)
    put(tmp_path / "ghcn" / "U1.csv.gz", "U1,20231231,TMAX,100,,,W,\nU1,20240101,TMAX,120,,,W,\nU1,20240101,TMIN,20,,,W,\nU1,20240301,TMIN,20,,,W,\n")
    put(tmp_path / "ghcn" / "U2.csv.gz", "U2,20240101,PRCP,-9999,,,W,\n")
    put(tmp_path / "lite.json.gz", json.dumps([station("M1", 33.01), station("M2", 33.5)]))
    put(tmp_path / "years" / "2023" / "M1.csv.gz", "date,temp,wspd\n2023-12-31,5,36\n")
    put(tmp_path / "years" / "2024" / "M1.csv.gz", "time,temp,wspd\n2024-01-01,6,\n2024-01-02,,\n")
    put(tmp_path / "years" / "2024" / "M2.csv.gz", "date,temp\n2024-01-01,7\nnever,8\n")
    put(tmp_path / "zones" / "raw" / "nws" / f"run_date={RUN}" / "station=K1" / raw.OBSERVATION_FILE, payload("K1", "K9"))
    return tmp_path


def land(spark, landing, zones, **kwargs):
    manifest = raw.read_manifest(spark, str(landing / "manifest.csv"))
    return (
        runs.land_long(spark, zones, str(landing / "ghcn" / "*.gz"), manifest, START, END, RUN),
        runs.land_wide(spark, zones, str(landing / "lite.json.gz"), str(landing / "years"), manifest, START, END, RUN, **kwargs),
    )


def test_whole_run(spark, landing):
    zones = runs.Zones(str(landing / "zones"))
    assert land(spark, landing, zones) == (1, 2)
    messages = {r.error_message for source in ("noaa", "meteostat") for r in tables.read_failures(spark, zones.failures(source)).collect()}
    assert {m for m in messages if "too far away" not in m} == {
        "no station file landed for GHCND:U3", "unreadable date in a file of GHCND:U2",
    }
    assert len(messages) == 3
    done = runs.run(spark, zones.root, RUN, str(landing / "manifest.csv"))
    assert tuple(done["metrics"].first()) == (9, 1, 8, 7, 1, 3)
    assert tuple(done["published"].first()) == (7, 7, 0, 0)

    daily = tables.read_table(spark, zones.curated("climate_daily"), CLIMATE_DAILY)
    got = sorted((r.source, r.source_station_id, str(r.date), r.avg_temp_c, r.max_temp_c, r.obs_count) for r in daily.collect())
    assert got == [
        ("meteostat", "M1", "2023-12-31", 5.0, None, 1), ("meteostat", "M1", "2024-01-01", 6.0, None, 1),
        ("noaa", "GHCND:U1", "2023-12-31", None, 10.0, 1), ("noaa", "GHCND:U1", "2024-01-01", 7.0, 12.0, 2),
        ("noaa", "GHCND:U2", "2024-01-01", None, None, 1),
        ("nws", "K1", "2024-01-01", 3.0, 3.0, 1), ("nws", "K9", "2024-01-01", 3.0, 3.0, 1),
    ]
    trends = tables.read_table(spark, zones.curated("climate_trends"), STATION_YEAR)
    assert trends.count() == 7
    summary = spark.read.parquet(zones.curated("climate_trends_source_summary"))
    assert summary.columns == list(SOURCE_YEAR) and summary.count() == 5

    # The same run again changes nothing.
    again = runs.run(spark, zones.root, RUN, str(landing / "manifest.csv"))
    assert tuple(again["metrics"].first()) == (9, 1, 8, 7, 1, 3)
    assert tuple(again["published"].first()) == (7, 0, 0, 7)
    # A run of one source leaves the other sources' curated rows in place.
    runs.run(spark, zones.root, RUN, str(landing / "manifest.csv"), ["noaa", "noaa"])
    assert tables.read_table(spark, zones.curated("climate_daily"), CLIMATE_DAILY).count() == 7
    with pytest.raises(ValueError):
        runs.run(spark, zones.root, RUN, str(landing / "manifest.csv"), ["radar"])


def test_wide_landing_resumes(spark, landing):
    zones = runs.Zones(str(landing / "zones"))
    land(spark, landing, zones)
    before = raw.read_wide(spark, zones.raw("meteostat"), RUN).count()
    assert before == 3
    put(landing / "years" / "2024" / "M2.csv.gz", "date,temp\n2024-01-01,7\n2024-01-02,8\n")
    assert land(spark, landing, zones)[1] == 1
    rows = raw.read_wide(spark, zones.raw("meteostat"), RUN)
    assert rows.count() == 5
    assert sorted(r.done for r in incremental.completed_stations(rows).collect()) == ["GHCND:U1", "GHCND:U2"]
    assert land(spark, landing, zones, resume=False)[1] == 1
    assert raw.read_wide(spark, zones.raw("meteostat"), RUN).count() == 5
    with pytest.raises(runs.StationError):
        land(spark, landing, zones, on_error="fail")


def test_run_in_which_every_station_fails(spark, landing):
    zones = runs.Zones(str(landing / "zones"))
    put(landing / "ghcn" / "U1.csv.gz", "X,20240101,TMAX,1,,,,\n")
    put(landing / "ghcn" / "U2.csv.gz", "")
    with pytest.raises(AllStationsFailedError):
        land(spark, landing, zones)


def test_raw_observations_are_published_once(spark, landing):
    zones = runs.Zones(str(landing / "zones"))
    assert tuple(runs.publish_raw_observations(spark, zones, RUN).first()) == (2, 2, 0, 0)
    assert tuple(runs.publish_raw_observations(spark, zones, RUN).first()) == (2, 0, 0, 2)


def test_rejects_are_kept_with_their_reason(spark, landing):
    zones = runs.Zones(str(landing / "zones"))
    put(landing / "zones" / "raw" / "noaa" / f"run_date={RUN}" / raw.LONG_FILE,
        lines(LONG | {"date": "x"}, "{broken", LONG | {"value": 1}))
    manifest = raw.read_manifest(spark, str(landing / "manifest.csv"))
    metrics = runs.process_source(spark, zones, "noaa", RUN, manifest)
    assert tuple(metrics.first())[2:] == (3, 2, 1, 1, 0)
    rejects = spark.read.parquet(zones.rejects("noaa"))
    assert sorted(r.reject_reason for r in rejects.collect()) == ["bad_date", "missing_station"]
    written = sorted(tables.read_table(spark, zones.daily("noaa"), DAILY).collect())
    with pytest.raises(UnusableRowError, match="unusable row"):
        runs.process_source(spark, zones, "noaa", RUN, manifest, on_error="fail")
    # What failed has replaced nothing.
    assert written and sorted(tables.read_table(spark, zones.daily("noaa"), DAILY).collect()) == written


def test_only_enabled_stations_are_landed(spark, landing):
    zones = runs.Zones(str(landing / "zones"))
    put(landing / "manifest.csv", MANIFEST.replace("GHCND:U1,One,AL,US,TRUE", "GHCND:U1,One,AL,US,FALSE"))
    manifest = raw.read_manifest(spark, str(landing / "manifest.csv"))
    assert runs.land_long(spark, zones, str(landing / "ghcn" / "*.gz"), manifest, START, END, RUN) == 1
    assert {r.noaa_station_id for r in raw.read_long(spark, zones.raw("noaa"), RUN).collect()} == {"GHCND:U2"}


def test_a_field_that_no_line_states_ends_the_run(spark, landing):
    zones = runs.Zones(str(landing / "zones"))
    put(landing / "zones" / "raw" / "noaa" / f"run_date={RUN}" / raw.LONG_FILE, lines({k: v for k, v in LONG.items() if k != "value"}))
    with pytest.raises(MissingColumnsError, match="value"):
        runs.process_source(spark, zones, "noaa", RUN, raw.read_manifest(spark, str(landing / "manifest.csv")))


def test_payloads_of_stations_off_the_manifest_are_left_out(spark, landing):
    zones = runs.Zones(str(landing / "zones"))
    put(landing / "zones" / "raw" / "nws" / f"run_date={RUN}" / "station=K8" / raw.OBSERVATION_FILE, payload("K8"))
    runs.process_source(spark, zones, "nws", RUN, raw.read_manifest(spark, str(landing / "manifest.csv")))
    daily = tables.read_table(spark, zones.daily("nws"), DAILY)
    assert {r.source_station_id for r in daily.collect()} == {"K1", "K9"}


def test_ledger_begins_anew_without_resume(spark, landing):
    zones = runs.Zones(str(landing / "zones"))
    land(spark, landing, zones)
    land(spark, landing, zones, resume=False)
    assert tables.read_failures(spark, zones.failures("meteostat")).count() == 2


def test_years_that_a_run_lost_leave_the_curated_data(spark, landing):
    zones = runs.Zones(str(landing / "zones"))
    land(spark, landing, zones)
    manifest = str(landing / "manifest.csv")
    runs.run(spark, zones.root, RUN, manifest)
    # A later window: the line of 2023 is no longer there.
    put(landing / "ghcn" / "U1.csv.gz", "U1,20240101,TMAX,120,,,W,\n")
    runs.land_long(spark, zones, str(landing / "ghcn" / "*.gz"), raw.read_manifest(spark, manifest), START, END, RUN)
    runs.run(spark, zones.root, RUN, manifest, ["noaa"])
    daily = tables.read_table(spark, zones.curated("climate_daily"), CLIMATE_DAILY)
    years = {(r.source, r.year) for r in daily.select("source", "year").collect()}
    assert years == {("noaa", 2024), ("meteostat", 2023), ("meteostat", 2024), ("nws", 2024)}
    trends = tables.read_table(spark, zones.curated("climate_trends"), STATION_YEAR)
    assert {(r.source, r.year) for r in trends.select("source", "year").collect()} == years


def test_windows_still_to_fetch(spark, landing):
    zones = runs.Zones(str(landing / "zones"))
    manifest = raw.read_manifest(spark, str(landing / "manifest.csv"))

    def pending():
        rows = runs.pending_windows(spark, zones, "noaa", RUN, manifest, date(2023, 12, 30), date(2024, 1, 3)).collect()
        return sorted((r.noaa_station_id[-2:], str(r.missing_start)[5:], str(r.missing_end)[5:]) for r in rows)

    nothing_yet = [(s, a, b) for s in ("U1", "U2", "U3") for a, b in (("01-01", "01-03"), ("12-30", "12-31"))]
    assert pending() == nothing_yet
    # U1 has the last of December and the first of January, two datatypes of it; U2 the first of January.
    runs.land_long(spark, zones, str(landing / "ghcn" / "*.gz"), manifest, START, END, RUN)
    assert pending() == [
        ("U1", "01-02", "01-03"), ("U1", "12-30", "12-30"), ("U2", "01-02", "01-03"), ("U2", "12-30", "12-31"),
        ("U3", "01-01", "01-03"), ("U3", "12-30", "12-31"),
    ]
