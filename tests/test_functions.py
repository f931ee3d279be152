from __future__ import annotations

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from skyledger.functions import dates, display, geo, values


def column(spark, data, kind, expression):
    """Values of an expression over single-column rows."""
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {kind}")
    return [row.y for row in frame.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_number(spark):
    got = column(spark, ["1.5", " 2 ", "", "abc", "nan", None, "-0.25"], "string", values.number)
    assert got == [1.5, 2.0, None, None, None, None, -0.25]


def test_scaled_measure(spark):
    rows = [("TMAX", "123"), ("SNOW", "123"), ("TAVG", "-9999"), ("PRCP", ""), ("AWND", "abc"), ("TMIN", None),
            ("TMAX", "nan"), (None, "10")]
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, d string, r string")
    got = frame.select("i", values.scaled_measure(F.col("d"), F.col("r")).alias("v")).orderBy("i").collect()
    assert [row.v for row in got] == [12.3, 123.0, None, None, None, None, None, 10.0]


def test_wind_units(spark):
    rows = [(36.0, "wmoUnit:km_h-1"), (36.0, "wmoUnit:m_s-1"), (36.0, None), (None, "wmoUnit:km_h-1")]
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, w double, u string")
    got = frame.select("i", values.wind_to_mps(F.col("w"), F.col("u")).alias("v")).orderBy("i").collect()
    assert [row.v for row in got] == [10.0, 36.0, 36.0, None]


def test_truthy(spark):
    got = column(spark, ["TRUE", " yes ", "Y", "1", "", None, "0", "no", " ", "false"], "string", values.truthy)
    assert got == [True, True, True, True, True, True, False, False, False, False]


def test_station_ids(spark):
    ids = ["GHCND:USW1", "USW1", "A:B:C", None]
    assert column(spark, ids, "string", values.station_code) == ["USW1", "USW1", "B:C", None]
    assert column(spark, ids, "string", values.qualified_station_id) == ["GHCND:USW1", "GHCND:USW1", "A:B:C", None]


def test_document_key(spark):
    rows = [("noaa", "S1", "N1", "2024-01-01"), ("noaa", "", "N1", "2024-01-01"), (None, None, "", None)]
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, a string, b string, c string, d string")
    got = frame.select("i", values.document_key(*[F.col(c) for c in "abcd"]).alias("k")).orderBy("i").collect()
    assert [row.k for row in got] == [
        "noaa|S1|2024-01-01", "noaa|N1|2024-01-01", "unknown|unknown_station|unknown_date",
    ]


def test_flag_text(spark):
    frame = spark.range(1).select(values.flag_text(mflag=F.lit("P"), qflag=F.lit(None).cast("string"), sflag=F.lit("")))
    assert frame.first()[0] == "mflag=P,qflag=,sflag="


def test_round_aggregate_takes_off_summation_noise(spark):
    assert column(spark, [1.005, 1.0049999999999999, 2.675, None], "double", values.round_aggregate) == [
        1.01, 1.01, 2.68, None,
    ]


def test_dates(spark):
    texts = ["2024-02-29", "2023-02-29", "bad", "", None, "2024-01-05T10:00:00"]
    assert column(spark, texts, "string", dates.day_date) == [date(2024, 2, 29), None, None, None, None, None]
    assert column(spark, texts, "string", dates.leading_date)[-1] == date(2024, 1, 5)
    compact = ["20240229", "20230229", "2024-02-29", "2024", "", None]
    assert column(spark, compact, "string", dates.compact_date) == [date(2024, 2, 29), None, None, None, None, None]


def test_stated_date(spark):
    rows = [
        ("2024-01-02", None, None, None, None), (None, "2024-01-03", None, None, None),
        ("", "2024-01-04", None, None, None), (None, None, "2024", "1", "5"), (None, None, "2024", "1", ""),
        (None, None, "2024", "13", "1"), ("2024-02-31", None, "2024", "1", "5"), (None, None, None, None, None),
    ]
    frame = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)], "i int, date string, time string, year string, month string, day string"
    )
    parts = [F.col(c) for c in ("date", "time", "year", "month", "day")]
    stated = dates.stated_date(*parts)
    day = dates.day_date(stated)
    got = frame.select("i", day.alias("d"), dates.date_status(stated, day).alias("s")).orderBy("i").collect()
    assert [(row.d and row.d.isoformat(), row.s) for row in got] == [
        ("2024-01-02", "ok"), ("2024-01-03", "ok"), ("2024-01-04", "ok"), ("2024-01-05", "ok"), (None, "skip"),
        (None, "bad"), (None, "bad"), (None, "skip"),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_local_day_does_not_depend_on_session_zone(spark, zone):
    texts = ["2024-01-02T04:59:00+00:00", "2024-01-02T05:00:00+00:00", "2024-07-02T03:59:00+00:00",
             "2024-07-02T04:00:00+00:00", "2024-03-10T07:30:00+00:00"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = column(spark, texts, "string", lambda x: F.to_date(dates.local_time(x.try_cast("timestamp"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [date(2024, 1, 1), date(2024, 1, 2), date(2024, 7, 1), date(2024, 7, 2), date(2024, 3, 10)]


def test_trailing_start_clamps_month_end(spark):
    got = column(spark, [date(2024, 2, 29), date(2025, 6, 30)], "date", dates.trailing_start)
    assert got == [date(2014, 3, 1), date(2015, 7, 1)]


def test_intervals_with_open_bounds(spark):
    start, end = F.lit(date(2010, 1, 1)), F.lit(None).cast("date")
    day = F.lit(date(2015, 1, 1))
    row = spark.range(1).select(
        dates.covers_day(start, end, day), dates.covers_range(start, end, day, day),
        dates.overlaps_range(start, end, day, day),
    ).first()
    assert tuple(row) == (False, False, False)


def test_haversine(spark):
    # Spherical law of cosines, as a second way to the same distance.
    p1, p2, dl = math.radians(40.7), math.radians(51.5), math.radians(73.9)
    km = 6371 * math.acos(math.sin(p1) * math.sin(p2) + math.cos(p1) * math.cos(p2) * math.cos(dl))
    row = spark.range(1).select(
        F.round(geo.haversine_km(F.lit(40.7), F.lit(-74.0), F.lit(51.5), F.lit(-0.1)), 6),
        geo.haversine_km(F.lit(10.0), F.lit(20.0), F.lit(10.0), F.lit(20.0)),
        F.round(geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)), 1),
    ).first()
    assert tuple(row) == (round(km, 6), 0.0, 20015.1)


def test_display(spark):
    seconds = [0.4, 59.5, 61.0, 3600.0, 3725.2, 0.5, 1.5]
    assert column(spark, seconds, "double", display.duration_text) == [
        "0s", "1m 0s", "1m 1s", "1h 0m 0s", "1h 2m 5s", "0s", "2s",
    ]
    assert column(spark, [1234567], "bigint", display.count_text) == ["1,234,567"]
    assert column(spark, ["nws", "other", None], "string", display.source_name) == ["NWS", "other", None]
    assert column(spark, [" nws,noaa ,,nws"], "string", display.listed) == [["nws", "noaa"]]
    assert column(spark, [datetime(2024, 1, 2, 3, 4, 5)], "timestamp", display.timestamp_text) == ["2024-01-02 03:04:05"]
