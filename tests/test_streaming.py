from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.operators import observations
from skyledger.schemas import RAW_LONG, ddl
from skyledger.sources import raw
from skyledger.streaming import closing, landing
from test_sources import LONG, lines, put

FIELDS = (
    "run_date string, stationId string, stationName string, timestamp string, "
    "temperature struct<value:double>, windSpeed struct<value:double,unitCode:string>, "
    "geometry struct<type:string,coordinates:array<double>>"
)


def observed(spark, path, *rows):
    frame = spark.createDataFrame(
        [("r", s, "N", f"2024-01-{at}+00:00", (t,), (None, None), None) for s, at, t in rows], FIELDS
    )
    frame.coalesce(1).write.mode("append").parquet(str(path))


def run_stream(spark, tmp_path, checkpoint="checkpoint", publish=None):
    stream = landing.stream_parquet(spark, str(tmp_path / "in"))
    landing.stream_days(observations.normalize_observations(stream), str(tmp_path / "out"), str(tmp_path / checkpoint), publish)


def days(spark, tmp_path):
    run_stream(spark, tmp_path)
    like = observations.summarize_days(observations.normalize_observations(spark.read.parquet(str(tmp_path / "in"))))
    out = landing.read_days(spark, str(tmp_path / "out"), like)
    return sorted((r.station_id, r.day.day, r.obs_count, r.avg_temp_c) for r in out.collect())


def test_days_grow_and_late_rows_count(spark, tmp_path):
    observed(spark, tmp_path / "in", ("K1", "02T12:00:00", 1.0), ("K1", "02T13:00:00", 2.0), ("K2", "03T04:30:00", 5.0))
    assert days(spark, tmp_path) == [("K1", 2, 2, 1.5), ("K2", 2, 1, 5.0)]
    observed(spark, tmp_path / "in", ("K2", "05T07:30:00", 9.0))
    # Long after, rows of an earlier day arrive: the day comes out again, and is listed.
    observed(spark, tmp_path / "in", ("K1", "02T15:00:00", 6.0), ("K2", "04T12:00:00", 1.0))
    assert days(spark, tmp_path) == [("K1", 2, 3, 3.0), ("K2", 2, 1, 5.0), ("K2", 4, 1, 1.0), ("K2", 5, 1, 9.0)]
    late = spark.read.option("basePath", str(tmp_path / "out" / "late")).parquet(str(tmp_path / "out" / "late"))
    assert [(r.station_id, r.day.day) for r in late.collect()] == [("K1", 2)]


def test_repeated_batches_change_nothing(spark, tmp_path):
    observed(spark, tmp_path / "in", ("K1", "02T12:00:00", 1.0), ("K2", "03T04:30:00", 5.0))
    seen = []
    run_stream(spark, tmp_path, publish=lambda batch, number: seen.append((number, batch.count())))
    before = days(spark, tmp_path)
    # Without its checkpoint a stream begins again at batch 0 and meets what it wrote.
    run_stream(spark, tmp_path, "lost", lambda batch, number: seen.append((number, batch.count())))
    assert seen == [(0, 2), (0, 2)] and days(spark, tmp_path) == before


def test_days_do_not_depend_on_the_session_zone(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        observed(spark, tmp_path / "in", ("K1", "02T04:30:00", 1.0), ("K1", "02T05:30:00", 2.0), ("K1", "04T05:30:00", 2.0))
        assert days(spark, tmp_path) == [("K1", 1, 1, 1.0), ("K1", 2, 1, 2.0), ("K1", 4, 1, 2.0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_streamed_days_equal_the_batch_result(spark, tmp_path):
    rows = [(f"K{i % 7}", f"{1 + i // 24:02}T{i % 24:02}:10:00", float(i % 13)) for i in range(240)]
    observed(spark, tmp_path / "in", *rows)
    streamed = days(spark, tmp_path)
    batch = observations.summarize_days(observations.normalize_observations(spark.read.parquet(str(tmp_path / "in"))))
    assert streamed == sorted((r.station_id, r.day.day, r.obs_count, r.avg_temp_c) for r in batch.collect())


def test_new_files_are_landed_once(spark, tmp_path):
    def run():
        stream = landing.stream_json_lines(spark, str(tmp_path / "raw"), ddl(RAW_LONG), raw.LONG_FILE)
        landing.land(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), ("run_date",))
        return spark.read.schema(ddl(RAW_LONG)).parquet(str(tmp_path / "out")).groupBy("run_date").count().orderBy("run_date").collect()

    put(tmp_path / "raw" / "run_date=2024-01-01" / raw.LONG_FILE, lines(LONG, LONG))
    assert [tuple(r) for r in run()] == [("2024-01-01", 2)]
    put(tmp_path / "raw" / "run_date=2024-01-02" / raw.LONG_FILE, lines(LONG))
    assert [tuple(r) for r in run()] == [("2024-01-01", 2), ("2024-01-02", 1)]
    assert [tuple(r) for r in run()] == [("2024-01-01", 2), ("2024-01-02", 1)]


def closing_run(spark, tmp_path, batches, **kwargs):
    """Batches of (station, day and time, temperature) closed one after the other; returns days, late rows, open days."""
    folder = str(tmp_path / "closing")
    for number, rows in enumerate(batches):
        frame = spark.createDataFrame(
            [("r", s, "N", f"2024-01-{at}+00:00", (t,), (None, None), None) for s, at, t in rows], FIELDS
        )
        closing.close_days(observations.normalize_observations(frame, "UTC"), number, folder, **kwargs)
    days = sorted((r.batch, r.station_id, r.day.day, r.obs_count, r.avg_temp_c) for r in closing.read_closed_days(spark, folder).collect())
    late = sorted((r.batch, r.station_id, r.day.day) for r in closing.read_late_rows(spark, folder).collect())
    still = sorted((r.station_id, r.day.day, r.obs_count) for r in closing.read_open_days(spark, folder).collect())
    return days, late, still


CLOSING = [
    [("K1", "02T12:00:00", 1.0), ("K2", "03T04:30:00", 5.0)],
    [("K1", "02T15:00:00", 3.0), ("K2", "04T23:59:59", 7.0), (None, "29T00:00:00", 1.0)],
    [("K1", "05T00:00:00", 9.0)],
    [],
    [("K1", "02T16:00:00", 50.0), ("K1", "07T00:00:00", 1.0), ("K2", "04T01:00:00", 9.0)],
]


def test_days_close_once_and_late_rows_are_listed(spark, tmp_path):
    """Two days after the newest time a day is closed; a row of an open day counts, however far behind it comes."""
    days, late, still = closing_run(spark, tmp_path, CLOSING)
    assert days == [(2, "K1", 2, 2, 2.0), (4, "K2", 3, 1, 5.0), (4, "K2", 4, 2, 8.0)]
    assert late == [(4, "K1", 2)]
    assert still == [("K1", 5, 1), ("K1", 7, 1)]


def test_a_repeated_batch_closes_the_same_days(spark, tmp_path):
    seen = []
    publish = lambda days, number: seen.append((number, sorted((r.station_id, r.day.day) for r in days.collect())))
    before = closing_run(spark, tmp_path, CLOSING, publish=publish)
    folder = str(tmp_path / "closing")
    frame = spark.createDataFrame(
        [("r", s, "N", f"2024-01-{at}+00:00", (t,), (None, None), None) for s, at, t in CLOSING[-1]], FIELDS
    )
    closing.close_days(observations.normalize_observations(frame, "UTC"), 4, folder, publish=publish)
    again = sorted((r.batch, r.station_id, r.day.day, r.obs_count, r.avg_temp_c) for r in closing.read_closed_days(spark, folder).collect())
    assert again == before[0] and seen[-1] == seen[-2]
    # The tables of open days do not pile up.
    assert len(list((tmp_path / "closing" / "state").iterdir())) == 2


def test_closing_reads_no_earlier_rows(spark, tmp_path):
    """Files of earlier batches may be gone: what is open is kept as partial days."""
    folder, source = str(tmp_path / "closing"), tmp_path / "in"
    for number, rows in enumerate((CLOSING[0], CLOSING[1], CLOSING[2])):
        observed(spark, source / str(number), *[row for row in rows if row[0]])
        stream = spark.readStream.schema(FIELDS).parquet(f"{source}/*")
        closing.stream_closed_days(observations.normalize_observations(stream, "UTC"), folder, str(tmp_path / "checkpoint"))
        for file in (source / str(number)).iterdir():
            file.unlink()
    days = closing.read_closed_days(spark, folder).collect()
    assert [(r.batch, r.station_id, r.day.day, r.obs_count, r.avg_temp_c) for r in days] == [(2, "K1", 2, 2, 2.0)]


def test_records_come_out_once(spark, tmp_path):
    """By id, else by another id, else by content; old rows in a new file are not too late."""
    schema = "`@id` string, feature_id string, timestamp string, value double"
    arrivals = [
        [("a", "f", "2024-01-09", 1.0), ("", "g", "2024-01-09", 2.0), (None, None, "2024-01-09", 3.0), (None, None, "2024-01-09", 4.0)],
        [("a", "x", "2024-01-09", 1.0), (None, "g", "2024-01-09", 2.0), (None, None, "2024-01-09", 3.0), ("old", None, "1999-01-01", 5.0)],
        [("h", None, "2024-01-10", 6.0), ("old", None, "1999-01-01", 5.0)],
    ]
    for number, rows in enumerate(arrivals):
        spark.createDataFrame(rows, schema).write.json(str(tmp_path / "in" / str(number)))
        stream = spark.readStream.schema(schema).json(f"{tmp_path}/in/*")
        once = landing.first_arrivals(stream, landing.record_key("@id", "feature_id"))
        landing.land(once, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
