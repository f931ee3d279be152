from __future__ import annotations

import gzip
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from skyledger.operators import observations, stations, wide_rows
from skyledger.schemas import DAILY, MANIFEST, RAW_LONG, RAW_WIDE, MissingColumnsError, ddl
from skyledger.session import scratch_dir
from skyledger.sources import raw, tables


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.suffix == ".gz":
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_text(text)


def lines(*records):
    return "".join((record if isinstance(record, str) else json.dumps(record)) + "\n" for record in records)


LONG = dict.fromkeys(RAW_LONG) | {"noaa_station_id": "G:1", "date": "2024-01-01", "datatype": "TMAX"}


def test_long_lines_by_run_date(spark, tmp_path):
    for run in ("2024-01-01", "2024-01-02"):
        put(tmp_path / f"run_date={run}" / raw.LONG_FILE, lines(LONG | {"run_date": run, "value": 3, "latitude": "1.5"}, "{broken", LONG))
        put(tmp_path / f"run_date={run}" / "noaa_failed_stations.jsonl", lines({"noaa_station_id": "X"}))
    put(tmp_path / "run_date=2024-01-03" / raw.LONG_FILE, "")
    root = str(tmp_path)
    assert raw.read_long(spark, root).count() == 6
    one = raw.read_long(spark, root, "2024-01-02")
    assert one.columns == list(RAW_LONG) and one.count() == 3
    assert {(r.run_date, r.value) for r in one.collect()} == {("2024-01-02", 3.0), ("2024-01-02", None)}
    broken = raw.read_long(spark, root, malformed=True).filter(F.col("malformed").isNotNull())
    assert {r.malformed for r in broken.collect()} == {"{broken"}
    assert all("run_date=2024-01-02" in name for name in one.inputFiles())
    assert raw.optional(lambda: raw.read_long(spark, root + "/none")) is None


def test_required_fields_of_files(spark, tmp_path):
    put(tmp_path / "run_date=r" / raw.LONG_FILE, lines({"date": 1}, {"value": 2}))
    raw.check_fields(spark, str(tmp_path), raw.LONG_FILE, ["date", "value"])
    with pytest.raises(MissingColumnsError, match="station_name"):
        raw.check_fields(spark, str(tmp_path), raw.LONG_FILE, ["date", "station_name"])


def payload(*stations_):
    return json.dumps({"type": "FeatureCollection", "features": [
        {"id": f"f-{s}", "geometry": {"type": "Point", "coordinates": [-86.0, 33.0]},
         "properties": {"@id": f"o-{s}", "stationId": s, "timestamp": "2024-01-01T12:00:00+00:00", "temperature": {"value": 3}}}
        for s in stations_
    ]}, indent=2)


def test_payload_layouts(spark, tmp_path):
    root = tmp_path / "raw" / "nws"
    put(root / "run_date=2024-01-01" / "station=KA" / raw.OBSERVATION_FILE, payload("KA", "KA"))
    put(root / "run_date=2024-01-01" / "station=KB" / raw.OBSERVATION_FILE, payload())
    put(root / "run_date=2024-01-02" / raw.OBSERVATION_FILE, payload("KC"))
    put(root / "run_date=2024-01-02" / "nws_failed_stations.jsonl", lines({"a": 1}))

    def got(run_date=None):
        rows = observations.explode_features(raw.read_payloads(spark, str(root), run_date))
        return sorted((r.run_date, r.stationId or "", r.temperature and r.temperature.value) for r in rows.collect())

    assert got("2024-01-01") == [("2024-01-01", "", None), ("2024-01-01", "KA", 3.0), ("2024-01-01", "KA", 3.0)]
    assert got("2024-01-02") == [("2024-01-02", "KC", 3.0)]
    assert len(got()) == 4
    with pytest.raises(FileNotFoundError):
        raw.read_payloads(spark, str(root), "2024-01-09")


def test_legacy_payloads_only_without_present_ones(spark, tmp_path):
    put(tmp_path / "raw" / "2023-12-31" / raw.OBSERVATION_FILE, payload("KL"))
    rows = observations.explode_features(raw.read_payloads(spark, str(tmp_path / "raw" / "nws")))
    assert [(r.run_date, r.stationId) for r in rows.collect()] == [("2023-12-31", "KL")]


def test_manifest_by_header(spark, tmp_path):
    put(tmp_path / "m.csv", "station_name,noaa_station_id,priority_rank,latitude\n\"One, AL\",G:1,2,33.5\nTwo,G:2,x,\n")
    frame = raw.read_manifest(spark, str(tmp_path / "m.csv"))
    assert frame.columns == list(MANIFEST)
    assert [(r.station_name, r.noaa_station_id, r.priority_rank, r.latitude, r.state) for r in frame.collect()] == [
        ("One, AL", "G:1", 2, "33.5", None), ("Two", "G:2", None, None, None),
    ]


def test_ghcn_lines(spark, tmp_path):
    put(tmp_path / "USW1.csv.gz", "USW1,20240101,TMAX,123,,,W,2400\nUSW1,20240102,TMAX\n\nUSW1,20240103,TMIN,5,,,W,,extra\n")
    got = raw.read_ghcn_lines(spark, str(tmp_path / "*.csv.gz")).collect()
    assert [(r.raw_day, r.raw_value, r.mflag, r.obs_time) for r in got] == [("20240101", "123", "", "2400"), ("20240103", "5", "", "")]


def test_station_year_files_with_different_headers(spark, tmp_path):
    put(tmp_path / "2023" / "M1.csv.gz", "date,temp,tmin,wpgt\n2023-01-01,1.5,,9\n")
    put(tmp_path / "2024" / "M1.csv.gz", "year,month,day,tmin,temp\n2024,1,2,-1,2.5\n2024,1,,0,0\n")
    put(tmp_path / "2024" / "M2.csv", "time,temp\n2024-02-30,3\n")
    put(tmp_path / "2022" / "M1.csv.gz", "date,temp\n2022-01-01,1\n")
    rows = wide_rows.dated_rows(raw.read_station_years(spark, str(tmp_path), date(2023, 5, 1), date(2025, 1, 1)))
    got = sorted((r.meteostat_station_id, r.date_status, str(r.observed_on), r.temp, r.tmin or "", r.wpgt) for r in rows.collect())
    assert got == [
        ("M1", "ok", "2023-01-01", "1.5", "", "9"), ("M1", "ok", "2024-01-02", "2.5", "-1", None),
        ("M1", "skip", "None", "0", "0", None), ("M2", "bad", "None", "3", "", None),
    ]


def test_station_year_headers_are_first_lines(spark, tmp_path):
    put(tmp_path / "2024" / "A.csv.gz", "temp,date\n1.5,2024-01-01\n")
    put(tmp_path / "2024" / "B.csv.gz", '"date","temp"\n"2024-01-01","2,5"\n2024-01-02,3\n')
    put(tmp_path / "2024" / "C.csv.gz", "humidity,temp\n50,7\n")
    put(tmp_path / "2024" / "D.csv.gz", "")
    rows = raw.read_station_years(spark, str(tmp_path), date(2024, 1, 1), date(2024, 12, 31))
    got = sorted((r.meteostat_station_id, r.date or "", r.temp) for r in rows.collect())
    # A file without a date keeps its rows; their date is missing.
    assert got == [("A", "2024-01-01", "1.5"), ("B", "2024-01-01", "2,5"), ("B", "2024-01-02", "3"), ("C", "", "7")]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_a_catalogue_is_one_file(spark, tmp_path):
    put(tmp_path / "c" / "a.json", "[]")
    put(tmp_path / "c" / "b.json", "[]")
    with pytest.raises(ValueError, match="one file"):
        raw.read_catalog(spark, str(tmp_path / "c"))


def test_scratch_is_shared_or_refused():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        def __init__(self, master):
            self.sparkContext = type("Context", (), {"master": master})()

    assert scratch_dir(Session("local[4]"), "x")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="checkpoint"):
            scratch_dir(Session(master), "x")


def test_catalog(spark, tmp_path):
    put(tmp_path / "lite.json.gz", json.dumps([
        {"id": "M1", "name": {"en": "One", "de": "Eins"}, "country": "US", "region": "AL", "identifiers": {"national": "U1", "icao": None},
         "location": {"latitude": 33, "longitude": -86.5, "elevation": 5}, "inventory": {"daily": {"start": "2000-01-01", "end": "2024-01-01"}}},
        {"id": "M2", "name": "Two"},
    ]))
    flat = stations.flatten_catalog(raw.read_catalog(spark, str(tmp_path / "lite.json.gz"))).orderBy("position").collect()
    assert [(r.id, r.name, r.latitude, r.daily_start, r.national) for r in flat] == [
        ("M1", "One", 33.0, date(2000, 1, 1), "U1"), ("M2", "Two", None, None, None),
    ]
    assert flat[0].position < flat[1].position


def test_pages(spark, tmp_path):
    put(tmp_path / "noaa_station_id=GHCND%3AU1" / "page-1.json", json.dumps(
        {"metadata": {"resultset": {"count": 1}}, "results": [{"date": "2024-01-01T00:00:00", "datatype": "TMAX", "value": 2.5, "attributes": ",,W,"}]}, indent=1))
    put(tmp_path / "noaa_station_id=GHCND%3AU2" / "page-1.json", "{}")
    from skyledger.operators import long_rows
    manifest = spark.createDataFrame([("GHCND:U1", "One", "AL", "US", "1", "2", "K1")],
                                     "noaa_station_id string, station_name string, state string, country string, latitude string, longitude string, nws_station_id string")
    rows = long_rows.page_rows(raw.read_pages(spark, str(tmp_path)), manifest, date(2023, 6, 1), date(2024, 2, 1), "r").collect()
    assert [(r.noaa_station_id, r.date, r.value, r.request_window_start, r.request_window_end) for r in rows] == [
        ("GHCND:U1", "2024-01-01", 2.5, "2024-01-01", "2024-02-01")
    ]


def test_json_lines_are_sorted_and_keep_nulls(spark, tmp_path):
    path = tmp_path / "out"
    tables.write_json_lines(spark.createDataFrame([(1, None)], "z int, a string"), str(path))
    written = [line for part in path.glob("part-*") for line in part.read_text().splitlines()]
    assert written == ['{"a":null,"z":1}']


def test_failure_ledger_grows(spark, tmp_path):
    path = str(tmp_path / "ledger")
    failed = spark.createDataFrame([("r", "meteostat", "G1", "boom")], "run_date string, source string, noaa_station_id string, error_message string")
    tables.append_failures(failed, path)
    tables.append_failures(failed, path)
    rows = tables.read_failures(spark, path).collect()
    assert len(rows) == 2 and rows[0].logged_at.startswith("20") and rows[0].nws_station_id is None


def test_metrics_files(spark, tmp_path):
    assert tables.read_metrics(spark, str(tmp_path), "noaa", "2024-01-01") is None
    metrics = spark.createDataFrame([("noaa", "2024-01-01", 5, 1, 4, 2, 2)],
                                    "source string, run_date string, raw_input_rows bigint, invalid_rows_removed bigint, valid_input_rows bigint, output_rows bigint, rows_consolidated_by_aggregation bigint")
    tables.write_metrics(metrics, str(tmp_path), "noaa", "2024-01-01")
    assert tuple(tables.read_metrics(spark, str(tmp_path), "noaa", "2024-01-01").first()) == ("noaa", "2024-01-01", 5, 1, 4, 2, 2)


def test_optional_datasets(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_existing(spark, str(tmp_path), ["noaa", "other"], DAILY)
    spark.createDataFrame([], ddl(DAILY)).write.parquet(str(tmp_path / "noaa_daily" / "parquet"))
    assert len(tables.read_existing(spark, str(tmp_path), ["noaa", "nws", "other"], DAILY)) == 1


def test_partition_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_partitions(spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], "source string, year int, v int"), path, "source", "year")
    tables.overwrite_partitions(spark.createDataFrame([("a", 1, 9)], "source string, year int, v int"), path, "source", "year")
    got = tables.read_table(spark, path, {"source": "string", "year": "int", "v": "int"}).collect()
    assert sorted(map(tuple, got)) == [("a", 1, 9), ("b", 1, 2)]


def test_raw_schemas_keep_published_fields():
    assert len(RAW_LONG) == 16 and len(RAW_WIDE) == 25 and len(DAILY) == 18 and len(MANIFEST) == 14


def test_station_year_files_are_read_once(spark, tmp_path):
    """One scan of whole files serves headers and lines; cells behind a short line's end are missing."""
    put(tmp_path / "2024" / "A.csv.gz", "temp,temp,date,wspd\r\n1,2,2024-01-01\r\n \r\n,5,2024-01-02,7,8\r\n")
    rows = raw.read_station_years(spark, str(tmp_path), date(2024, 1, 1), date(2024, 12, 31))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert sorted((r.date, r.temp, r.wspd) for r in rows.collect()) == [("2024-01-01", "1", None), ("2024-01-02", None, "7")]
