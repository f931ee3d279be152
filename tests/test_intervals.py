"""Joining intervals by bins, and the parts of windows that nothing covers, against brute force."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from skyledger.operators import incremental, intervals

DAY0 = date(1999, 12, 1)


def some_interval(rng):
    first = DAY0 + timedelta(days=rng.randrange(900))
    last = first + timedelta(days=rng.choice((-3, 0, 1, 7, 30, 400)))
    return rng.choice((first, first, first, None)), rng.choice((last, last, last, None))


def test_bins_of_an_interval_hold_its_days_and_no_others(spark):
    rng = random.Random(1)
    cases = [(a, a + rng.choice((0, 1, 2, 63, 64, 5000, 40_000))) for a in (rng.randrange(2_400_000, 2_600_000) for _ in range(60))]
    days = [(a, b, d) for a, b in cases for d in {a - 1, a, (a + b) // 2, b, b + 1}]
    frame = spark.createDataFrame(days, "a int, b int, d int")
    own, bins = intervals.bins_of_day(F.col("d")), intervals.bins_of_interval(F.col("a"), F.col("b"))
    rows = frame.select("*", F.size(F.array_intersect(own, bins)).alias("met"), F.size(bins).alias("n")).collect()
    assert all(r.met == (r.a <= r.d <= r.b) for r in rows)
    assert all(r.n <= 2 * intervals.TOP + (r.b - r.a) // 2**intervals.TOP for r in rows)


@pytest.mark.parametrize("split", [intervals.SPLIT, 2])
def test_overlaps_equal_all_pairs(spark, split):
    rng = random.Random(2)
    left = [(i, rng.choice("ab"), *some_interval(rng)) for i in range(60)] + [(60 + i, "a", DAY0, date(9999, 12, 31)) for i in range(15)]
    right = [(i, rng.choice(("a", "b", None)), *some_interval(rng)) for i in range(60)] + [(60 + i, "a", DAY0, DAY0) for i in range(15)]
    right += right[:4]
    l = spark.createDataFrame(left, "x int, k string, s date, e date")
    r = spark.createDataFrame(right, "y int, k string, f date, t date")
    got = intervals.overlap_join(l, r, ("s", "e"), ("f", "t"), ("k",), split)
    assert got.columns == ["x", "k", "s", "e", "y", "f", "t", "overlap_start", "overlap_end"]
    want = [
        (x, k, s, e, y, f, t, max(s, f), min(e, t)) for x, k, s, e in left for y, k2, f, t in right
        if k == k2 and None not in (s, e, f, t) and s <= e and f <= t and s <= t and f <= e
    ]
    assert sorted(tuple(row) for row in got.collect()) == sorted(want)
    free = intervals.overlap_join(l.drop("k"), r.drop("k"), ("s", "e"), ("f", "t"), (), split)
    assert free.count() == sum(
        None not in (s, e, f, t) and s <= e and f <= t and s <= t and f <= e for _, _, s, e in left for _, _, f, t in right
    )


def test_overlap_plan_is_made_of_equi_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        l = spark.range(5).selectExpr("id x", "date '2020-01-01' s", "date '2020-02-01' e")
        r = spark.range(5).selectExpr("id y", "date '2020-01-01' f", "date '2020-02-01' t")
        text = intervals.overlap_join(l, r, ("s", "e"), ("f", "t"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not re.search("Cartesian|NestedLoop|Python", text)
    with pytest.raises(ValueError, match="x"):
        intervals.overlap_join(l, l, ("s", "e"), ("s", "e"))


def test_missing_windows_equal_days_counted_out(spark):
    rng = random.Random(3)
    day = lambda n: DAY0 + timedelta(days=n)
    landed = [(rng.choice("abc"), day(rng.randrange(60))) for _ in range(70)] + [("d", day(d)) for d in range(60)] + [(None, DAY0), ("a", None)]
    landed += landed[:9]
    asked = [(rng.choice("abcdx"), *(day(rng.randrange(-5, 65)) for _ in range(2))) for _ in range(50)] + [("a", None, DAY0)]
    asked += asked[:5]
    have = set(landed)
    want = set()
    for key, start, end in asked:
        if start is None or end is None:
            continue
        open_days = [d for d in (start + timedelta(days=n) for n in range((end - start).days + 1)) if (key, d) not in have]
        for at, d in enumerate(open_days):
            if at == 0 or open_days[at - 1] != d - timedelta(days=1):
                first = d
            if at + 1 == len(open_days) or open_days[at + 1] != d + timedelta(days=1):
                want.add((key, start, end, first, d))
    frame = spark.createDataFrame(landed, "k string, day date")
    got = incremental.missing_windows(
        spark.createDataFrame(asked, "k string, window_start date, window_end date"), incremental.landed_islands(frame, "k"), "k"
    ).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_pairs_of_one_bin_are_dealt_out_by_either_side(spark):
    """Few days that very many intervals hold, or the other way round, do not make all their pairs in one task."""
    few = spark.range(8).selectExpr("id x", "date '2020-01-01' s", "date '2020-01-01' e")
    many = spark.range(4000).selectExpr("id y", "date '2010-01-01' f", "date '2024-01-01' t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for got in (
            intervals.overlap_join(few, many, ("s", "e"), ("f", "t"), (), 100),
            intervals.overlap_join(many, few, ("f", "t"), ("s", "e"), (), 100),
        ):
            sizes = got.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
            assert sum(sizes) == 32_000 and max(sizes) < 16_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
