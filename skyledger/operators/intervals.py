"""Joining intervals of days that overlap, by equality of bins.

Two intervals overlap if one starts within the other. An interval is a handful of dyadic bins (of 1, 2, 4, ... days,
``TOP`` doublings at most), a day lies in one bin of each size, and a day lies within an interval exactly if one of
its bins is one of the interval's. So an overlap join is two equi-joins, which meet each pair once and which Spark
may shuffle, sort and split like any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins have up to 2^14 days (45 years); longer intervals take several of the largest.
TOP = 14
#: Days are counted from 4900 BC, so that none is negative.
_FIRST = 2_500_000
#: A bin with more rows than this of either side is split, so that a task pairs no more than the square of it at once.
SPLIT = 5_000


def _day(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date")) + _FIRST


def _bin(size: Column, place: Column) -> Column:
    """One number for the bin's size (as a power of 2) and its place among those."""
    return place * (TOP + 1) + size


def bins_of_day(day: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(TOP)), lambda j: _bin(j, F.call_function("shiftright", day, j)))


def bins_of_interval(first: Column, last: Column) -> Column:
    """The fewest bins that make up the days from ``first`` to ``last``."""
    def at(j: Column) -> Column:
        # Of the bins of a size that lie within, those at the ends whose neighbour does not belong to their pair.
        low = F.call_function("shiftright", first + F.call_function("shiftleft", F.lit(1), j) - 1, j)
        high = F.call_function("shiftright", last + 1, j)
        left = F.when((low < high) & (low % 2 == 1), _bin(j, low))
        right = F.when((low < high) & (high % 2 == 1), _bin(j, high - 1))
        whole = F.when(low < high, F.transform(F.sequence(low, high - 1), lambda place: _bin(j, place)))
        return F.when(j == TOP, F.coalesce(whole, F.array().cast("array<int>"))).otherwise(F.array(left, right))

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(TOP)), at)))


def _meet(starts: DataFrame, intervals: DataFrame, on: list[str], split: int) -> DataFrame:
    """Pairs of rows of ``starts`` (with ``day``) and of ``intervals`` (with ``first``, ``last``) that hold the day.

    Days are put in their bins once, whatever the number of rows that have them, and a bin that one side has no row in
    is left out. The rows of a bin are dealt out to a grid of parts, by what they hold.
    """
    keys = [*on, "bin"]

    def binned(rows: DataFrame, bins: Column, *days: str) -> DataFrame:
        return rows.groupBy(*on, *days).agg(F.count(F.lit(1)).alias("n")).select("*", F.explode(bins).alias("bin"))

    def parts(bins: DataFrame, name: str) -> DataFrame:
        return bins.groupBy(*keys).agg(F.ceil(F.sum("n") / split).cast("int").alias(name))

    start_bins = binned(starts, bins_of_day(F.col("day")), "day")
    interval_bins = binned(intervals, bins_of_interval(F.col("first"), F.col("last")), "first", "last")
    met = parts(start_bins, "start_parts").join(parts(interval_bins, "interval_parts"), keys)
    # As many tasks as the session states: few rows make many pairs, so their bytes do not tell how many tasks they need.
    cell, tasks = [*keys, "start_part", "interval_part"], int(starts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(rows: DataFrame, bins: DataFrame, days: list[str], own: str, other: str) -> DataFrame:
        stay = [name for name in rows.columns if name not in days]
        part = F.pmod(F.xxhash64(*stay), F.col(f"{own}_parts")).cast("int").alias(f"{own}_part")
        to_all = F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)).alias(f"{other}_part")
        bins_met = bins.join(met, keys).groupBy(*on, *days).agg(
            F.collect_list(F.struct("bin", "start_parts", "interval_parts")).alias("bins")
        )
        rows = rows.join(bins_met, [*on, *days]).select(*stay, F.inline("bins"))
        return rows.select(*stay, "bin", part, to_all).repartition(tasks, *cell)

    dealt_starts = dealt(starts, start_bins, ["day"], "start", "interval")
    return dealt_starts.join(dealt(intervals, interval_bins, ["first", "last"], "interval", "start"), cell)


def overlap_join(
    left: DataFrame, right: DataFrame, left_bounds: tuple[str, str], right_bounds: tuple[str, str], on: tuple[str, ...] = (),
    split: int = SPLIT,
) -> DataFrame:
    """All pairs of rows whose date intervals share a day and whose ``on`` columns are equal.

    The result has ``on``, the other columns of both sides, whose names must differ, and the days shared, as
    ``overlap_start`` and ``overlap_end``. Bounds belong to their interval. An interval that lacks a bound, or ends
    before it starts, meets nothing. Result and time grow with the pairs, that is with the square of the rows that
    share days and ``on`` columns; memory does not, and neither do the pairs that one key of the join makes.
    """
    clash = (set(left.columns) & set(right.columns)) - set(on)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    # Columns go by their place meanwhile, side by side: a struct would be opened anew for each column of each pair.
    keys = {name: f"on_{at}" for at, name in enumerate(on)}
    names = {
        side: keys | {name: f"{side}_{at}" for at, name in enumerate(df.columns) if name not in on}
        for side, df in (("left", left), ("right", right))
    }

    def columns(side: str) -> list[str]:
        return [name for name in names[side].values() if name not in keys.values()]

    def rows(df: DataFrame, bounds: tuple[str, str], side: str) -> DataFrame:
        first, last = (F.col(bound) for bound in bounds)
        stated = reduce(Column.__and__, [F.col(f"`{name}`").isNotNull() for name in on], first <= last)
        own = [F.col(f"`{name}`").alias(place) for name, place in names[side].items()]
        # Generated, as days that a plan knows beforehand would be no key of a join any more.
        days = F.inline(F.array(F.struct(_day(first).alias("first"), _day(last).alias("last"))))
        return df.filter(stated).select(*own, days)

    def starting(df: DataFrame) -> DataFrame:
        return df.withColumnRenamed("first", "day").drop("last")

    def holding(df: DataFrame, later: int) -> DataFrame:
        return df.withColumn("first", F.col("first") + later).filter(F.col("first") <= F.col("last"))

    one, other = rows(left, left_bounds, "left"), rows(right, right_bounds, "right")
    both = [*keys.values(), *columns("left"), *columns("right")]
    # Pairs that start on one day are met by the first join only.
    pairs = (
        _meet(starting(one), holding(other, 0), list(keys.values()), split).select(*both)
        .unionByName(_meet(starting(other), holding(one, 1), list(keys.values()), split).select(*both))
    )
    bounds = [[names[side][bound] for bound in pair] for side, pair in (("left", left_bounds), ("right", right_bounds))]
    return pairs.select(
        *[F.col(names["left"][name]).alias(name) for name in left.columns],
        *[F.col(names["right"][name]).alias(name) for name in right.columns if name not in on],
        F.greatest(*[first for first, _ in bounds]).alias("overlap_start"),
        F.least(*[last for _, last in bounds]).alias("overlap_end"),
    )
