"""Continuing with what has arrived since the last run, and summarising days as they grow.

Streams read files, run once over everything available and stop; the checkpoint remembers which
files are done.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from skyledger.functions.values import first_present
from skyledger.operators.observations import DAY_KEYS, day_partials, finish_days


def stream_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A stream over a Parquet dataset (a file or a folder), with the schema it has now."""
    schema = spark.read.parquet(path).schema
    # Named as a pattern, since a stream takes a plain path for a folder.
    folder, _, name = path.rstrip("/").rpartition("/")
    return spark.readStream.schema(schema).parquet(f"{folder}/{{{name}}}")


def stream_json_lines(spark: SparkSession, root: str, schema: str, file_glob: str) -> DataFrame:
    """A stream over landed JSON lines below ``root``."""
    return spark.readStream.schema(schema).option("pathGlobFilter", file_glob).json(root)


#: How long after its arrival a record is known.
REMEMBER = "7 days"


def land(stream: DataFrame, out: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> None:
    """Appends what has newly arrived to a Parquet dataset, once per input file, and waits."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = (
        writer.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def record_key(*names: str) -> Column:
    """What identifies a record: the first of the ids that is stated, else all it says.

    Rows that state nothing that tells them apart are one record.
    """
    stated = F.concat(F.lit("id:"), first_present(*[F.col(f"`{name}`") for name in names]))
    return F.coalesce(stated, F.concat(F.lit("row:"), F.sha2(F.to_json(F.struct("*")), 256)))


def first_arrivals(stream: DataFrame, key: Column, remember: str = REMEMBER) -> DataFrame:
    """The records of a stream of files without those that came before.

    Event time is the arrival of a record's file, not the time of the observation: a record is
    forgotten ``remember`` after it came, however old it is, and a file that holds old observations is
    never too late. Of the records of one key the first to come stays.
    """
    columns = stream.columns
    return (
        stream.select("*", key.alias("_record"), F.col("_metadata.file_modification_time").alias("_arrived"))
        .withWatermark("_arrived", remember)
        .dropDuplicatesWithinWatermark(["_record"])
        .select(*[F.col(f"`{name}`") for name in columns])
    )


def _numbered(df: DataFrame) -> StructType:
    """The frame's schema with the number of the batch."""
    return StructType([*df.schema.fields, StructField("batch", LongType())])


def stream_days(
    normalized: DataFrame, folder: str, checkpoint: str, publish: Callable[[DataFrame, int], None] | None = None
) -> None:
    """Station-day summaries of a stream of normalised observations, complete at any moment.

    Each micro-batch adds its partial station-days to ``folder/partials``, a row per station-day and batch whatever
    the number of its observations, and finishes every station-day it touches anew from all partials of those
    days. So a day needs no closing and a late row is never lost: its day simply comes out again. Days that
    had been summarised before are listed in ``folder/late``. Everything is written under the batch's number and
    replaced when Spark repeats the batch. ``publish`` gets the batch's days and its number, and must be
    repeatable too (a merge by key is). Where a day is to come out once, see ``closing``.
    """
    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        partials = f"{folder}/partials"
        own = day_partials(batch)
        own.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("day").parquet(f"{partials}/batch={number}")
        landed = spark.read.schema(_numbered(own)).option("basePath", partials).parquet(partials).filter(F.col("batch") <= number)
        # The dates of one batch are few, and named in the scan; its stations may be many, and are joined.
        dates = [row.day for row in landed.filter(F.col("batch") == number).select("day").distinct().collect()]
        touched = landed.filter(F.col("batch") == number).select(*DAY_KEYS).distinct()
        found = landed.filter(F.col("day").isin(dates)).join(touched, list(DAY_KEYS), "left_semi")
        days = finish_days(found.drop("batch"))
        days.write.mode("overwrite").parquet(f"{folder}/days/batch={number}")
        late = found.filter(F.col("batch") < number).select(*DAY_KEYS).distinct()
        late.write.mode("overwrite").parquet(f"{folder}/late/batch={number}")
        if publish is not None:
            publish(spark.read.schema(days.schema).parquet(f"{folder}/days/batch={number}"), number)

    query = (
        normalized.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_days(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """The newest summary of each station-day, in the columns of ``like``."""
    path = f"{folder}/days"
    days = spark.read.schema(_numbered(like)).option("basePath", path).parquet(path)
    newest = days.groupBy(*DAY_KEYS).agg(F.max("batch").alias("batch"))
    return days.join(newest, [*DAY_KEYS, "batch"], "left_semi").select(*like.columns)
