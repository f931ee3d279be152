"""Station-days that come out once, when no more of their observations are awaited.

Event time is the local time of an observation. The watermark of a batch is the newest local time of all batches
before it, less a delay; a day that ends by the watermark is closed. What a stream keeps are mergeable partial
station-days of the days still open, one small table per batch that replaces the one before: a batch reads its
own rows and that table, never the rows of earlier batches. Rows of a day already closed change nothing and are
listed. Everything is filed under the batch's number and replaced when Spark repeats the batch.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.observations import CHECKS, day_partials, finish_days, merge_partials
from skyledger.operators.validity import accepted
from skyledger.session import remove_folder

DELAY = timedelta(days=2)
#: Before every observation.
EVER = date(1000, 1, 1)


def _place(folder: str, kind: str, number: int) -> str:
    return f"{folder}/{kind}/batch={number}"


def _closed_before(newest: datetime | None, delay: timedelta) -> date:
    """The first day that is still open under a newest local time."""
    return EVER if newest is None else (newest - delay).date()


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def close_days(
    batch: DataFrame, number: int, folder: str, delay: timedelta = DELAY,
    publish: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """One batch of normalised observations: closes days, keeps open ones, lists late rows.

    ``marks`` holds the newest local time after each batch and is written last but for the hand-over to
    ``publish``, which gets the closed days and must be repeatable (a merge by key is).
    """
    spark = batch.sparkSession

    def earlier(kind: str) -> DataFrame | None:
        return spark.read.parquet(_place(folder, kind, number - 1)) if number else None

    mark = earlier("marks")
    newest = mark.first().newest if mark is not None else None
    opened = _closed_before(newest, delay)

    usable = accepted(batch, CHECKS)
    found = usable.agg(F.max("local_time").alias("newest"), F.min("day").alias("day")).first()
    newest = max((time for time in (newest, found.newest) if time is not None), default=None)
    open_from = _closed_before(newest, delay)

    on_time = usable.filter(F.col("day") >= F.lit(opened))
    if found.day is not None and found.day < opened:
        late = usable.filter(F.col("day") < F.lit(opened))
    else:
        late = spark.createDataFrame([], usable.schema)
    _write(late, _place(folder, "late", number))
    state = earlier("state")
    partials = day_partials(on_time)
    merged = _write(
        partials if state is None else merge_partials(state.unionByName(partials)), _place(folder, "merged", number)
    )
    days = _write(finish_days(merged.filter(F.col("day") < F.lit(open_from))), _place(folder, "days", number))
    _write(merged.filter(F.col("day") >= F.lit(open_from)), _place(folder, "state", number))
    _write(spark.createDataFrame([(newest,)], "newest timestamp_ntz"), _place(folder, "marks", number))
    remove_folder(spark, _place(folder, "merged", number))
    if number > 1:
        # A repeated batch reads the one before it, never an older one.
        remove_folder(spark, _place(folder, "state", number - 2))
    if publish is not None:
        publish(days, number)


def stream_closed_days(
    normalized: DataFrame, folder: str, checkpoint: str, delay: timedelta = DELAY,
    publish: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Feeds what a stream of normalised observations has to ``close_days``, and waits."""
    query = (
        normalized.writeStream.foreachBatch(lambda batch, number: close_days(batch, number, folder, delay, publish))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _read_all(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """All batches' rows of a kind, with the number of the batch."""
    path = f"{folder}/{kind}"
    return spark.read.option("basePath", path).parquet(f"{path}/batch=*")


def read_closed_days(spark: SparkSession, folder: str) -> DataFrame:
    """Every closed station-day, once, with the batch that closed it."""
    return _read_all(spark, folder, "days")


def read_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Usable rows that came when their day was closed, with the batch they came in."""
    return _read_all(spark, folder, "late")


def read_open_days(spark: SparkSession, folder: str) -> DataFrame:
    """Station-days as far as they have come, of the days that are still open."""
    states = _read_all(spark, folder, "state")
    newest = _read_all(spark, folder, "marks").agg(F.max("batch").alias("batch"))
    return finish_days(states.join(newest, "batch", "left_semi"))
