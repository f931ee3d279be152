"""Dates and times: parsing, zones, windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.values import present

# Fixed value: the zone in which observation days are counted unless another is given.
DEFAULT_ZONE = "America/New_York"


def iso_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text as a date; anything unparseable gives null."""
    return text.try_cast("date")


def day_date(text: Column) -> Column:
    """As ``iso_date``, but the text must hold year, month and day and nothing else."""
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date"))


def leading_date(text: Column) -> Column:
    """The date in the first ten characters of a date-time text."""
    return day_date(F.substring(text, 1, 10))


def compact_date(text: Column) -> Column:
    """``yyyyMMdd`` text as a date; anything unparseable gives null."""
    parts = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return F.when(text.rlike(r"^\d{8}$"), parts.try_cast("date"))


def stated_date(date: Column, time: Column, year: Column, month: Column, day: Column) -> Column:
    """The text of a date that a row states as ``date``, as ``time``, or in three parts; else null."""
    has_parts = present(year).isNotNull() & present(month).isNotNull() & present(day).isNotNull()
    parts = F.concat_ws("-", F.lpad(F.trim(year), 4, "0"), F.trim(month), F.trim(day))
    return F.coalesce(present(date), present(time), F.when(has_parts, parts))


def date_status(stated: Column, day: Column) -> Column:
    """``ok``, ``skip`` (no date stated at all) or ``bad`` (stated, but not a date)."""
    return F.when(stated.isNull(), F.lit("skip")).when(day.isNull(), F.lit("bad")).otherwise(F.lit("ok"))


def local_time(instant: Column, zone: str | Column = DEFAULT_ZONE) -> Column:
    """Wall-clock time in ``zone`` of a timestamp, whatever the session's own zone."""
    return F.convert_timezone(None, F.lit(zone) if isinstance(zone, str) else zone, instant)


def local_time_of_utc(wall: Column, zone: str | Column = DEFAULT_ZONE) -> Column:
    """Wall-clock time in ``zone`` of a zone-less timestamp that states UTC."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone) if isinstance(zone, str) else zone, wall)


def shift_years(day: Column, years: int) -> Column:
    """The same day some years away, the last of February where it does not exist."""
    return F.add_months(day, 12 * years)


def trailing_start(end: Column, years: int = 10) -> Column:
    """First day of the window of whole years that ends on ``end``."""
    return F.date_add(shift_years(end, -years), 1)


def calendar_years(start: Column, end: Column) -> Column:
    """The calendar years a date range touches, as an array; empty if it ends before it starts."""
    return F.when(start <= end, F.sequence(F.year(start), F.year(end))).otherwise(
        F.array().cast("array<int>")
    )


def year_window(year: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """The part of a date range that lies in one calendar year."""
    first = F.greatest(start, F.make_date(year, F.lit(1), F.lit(1)))
    last = F.least(end, F.make_date(year, F.lit(12), F.lit(31)))
    return first, last


def covers_day(start: Column, end: Column, day: Column) -> Column:
    """Whether an interval holds a day; an open bound counts as no."""
    return F.coalesce((start <= day) & (end >= day), F.lit(False))


def covers_range(start: Column, end: Column, first: Column, last: Column) -> Column:
    """Whether an interval holds a whole range; an open bound counts as no."""
    return F.coalesce((start <= first) & (end >= last), F.lit(False))


def overlaps_range(start: Column, end: Column, first: Column, last: Column) -> Column:
    """Whether an interval and a range share a day; an open bound counts as no."""
    return F.coalesce((start <= last) & (end >= first), F.lit(False))
