"""Documents, and keyed snapshots that can be published again without duplicates."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from skyledger.functions.values import document_key

KEY = "_id"

# What happened to a document, and the record type.
KEPT, INSERTED, UNCHANGED, REPLACED = "kept", "inserted", "unchanged", "replaced"
LOST = "lost"
RECORD_TYPE = "climate_daily"


def to_documents(daily: DataFrame, level: str = "curated") -> DataFrame:
    """Daily rows as documents: key, ISO text date, data level and record type."""
    return daily.withColumn("date", F.col("date").cast("string")).select(
        document_key(
            F.col("source"), F.col("source_station_id"), F.col("noaa_station_id"), F.col("date")
        ).alias(KEY),
        "*",
        F.lit(level).alias("dataLevel"),
        F.lit(RECORD_TYPE).alias("recordType"),
    )


def latest_per_key(documents: DataFrame, key: str = KEY, order: str = "ingest_run_date") -> DataFrame:
    """The newest document of each key; between equally new ones, the greatest by content.

    An aggregate rather than a window, so that copies of a key are combined within each task and
    a key with any number of copies is never gathered in one place. Documents without key go.
    """
    rest = [name for name in documents.columns if name not in (key, order)]
    newest = F.max(F.struct(order, *rest)).alias("newest")
    return (
        documents.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(newest)
        .select(key, "newest.*")
        .select(*documents.columns)
    )


def merge_snapshot(
    existing: DataFrame, incoming: DataFrame, key: str = KEY, replaced: tuple[str, ...] = ()
) -> DataFrame:
    """The next snapshot: every incoming document replaces the one with its key, or is added.

    Both sides must be unique by key. ``action`` tells what happened to each document; with names ``replaced``, a
    struct of that name has those fields of the document that another took the place of.
    """
    fields = [name for name in incoming.columns if name != key]
    old = existing.select(key, F.struct(*fields).alias("old"))
    new = incoming.filter(F.col(key).isNotNull()).select(key, F.struct(*fields).alias("new"))
    action = (
        F.when(F.col("new").isNull(), F.lit(KEPT))
        .when(F.col("old").isNull(), F.lit(INSERTED))
        .when(F.col("old") == F.col("new"), F.lit(UNCHANGED))
        .otherwise(F.lit(REPLACED))
    )
    told = {"action": action}
    if replaced:
        fields_before = F.struct(*[F.col(f"old.{name}").alias(name) for name in replaced])
        told["replaced"] = F.when(action == REPLACED, fields_before)
    return (
        old.join(new, key, "full_outer")
        .select(key, F.coalesce("new", "old").alias("document"), *[value.alias(name) for name, value in told.items()])
        .select(key, "document.*", *told)
        .select(*incoming.columns, *told)
    )


def snapshot_changes(merged: DataFrame) -> DataFrame:
    """What a merge adds (``sign`` 1) and takes away (-1), in the fields it has as ``replaced``.

    Added are new documents, taken away old ones that they replace; documents that come as they were change nothing.
    """
    names = merged.schema["replaced"].dataType.names

    def signed(prefix: str, sign: int) -> Column:
        return F.struct(*[F.col(prefix + name).alias(name) for name in names], F.lit(sign).alias("sign"))

    sides = F.array(
        F.when(F.col("action").isin(INSERTED, REPLACED), signed("", 1)),
        F.when(F.col("action") == REPLACED, signed("replaced.", -1)),
    )
    return merged.select(F.inline(F.array_compact(sides)))


def compare_snapshots(before: DataFrame, after: DataFrame, key: str = KEY, handed: DataFrame | None = None) -> DataFrame:
    """What became of each document between two whole snapshots; ``lost`` ones come as they were.

    With the keys of the documents ``handed`` over in between (repeats count once), those that are as they were
    are told apart: ``unchanged`` if they were handed over again, else ``kept``.
    """
    fields = [name for name in after.columns if name != key]
    old = before.select(key, F.struct(*fields).alias("old"))
    new = after.select(key, F.struct(*fields).alias("new"))
    both = old.join(new, key, "full_outer")
    same = F.lit(UNCHANGED)
    if handed is not None:
        both = both.join(handed.select(key).distinct().withColumn("handed", F.lit(True)), key, "left")
        same = F.when(F.col("handed"), same).otherwise(F.lit(KEPT))
    action = (
        F.when(F.col("new").isNull(), F.lit(LOST))
        .when(F.col("old").isNull(), F.lit(INSERTED))
        .when(F.col("old") == F.col("new"), same)
        .otherwise(F.lit(REPLACED))
    )
    return (
        both.select(key, F.coalesce("new", "old").alias("document"), action.alias("action"))
        .select(key, "document.*", "action")
        .select(*after.columns, "action")
    )


def upsert_counts(merged: DataFrame, documents: DataFrame, key: str = KEY) -> DataFrame:
    """Processed, upserted, modified and matched documents of a merge.

    Processed are all ``documents`` with a key that were handed over, copies of a key included.
    """
    names = ("to_process", "upserted", "modified", "matched")

    def count(*actions: str) -> Any:
        return F.count_if(F.col("action").isin(*actions))

    nothing = F.lit(0).cast("bigint")
    handed = documents.agg(F.count(key), nothing, nothing, nothing).toDF(*names)
    done = merged.agg(nothing, count(INSERTED), count(REPLACED), count(REPLACED, UNCHANGED)).toDF(*names)
    return handed.unionByName(done).agg(*[F.sum(name).alias(name) for name in names])


def publish_batches(
    documents: DataFrame, write_batch: Callable[[list[dict[str, Any]]], None], batch_size: int = 1000
) -> None:
    """Hands documents with a key to ``write_batch`` on the executors, in batches.

    ``write_batch`` must replace by key: a task that is run again hands over its batches again.
    """
    def send(rows: Iterator[Row]) -> None:
        while batch := [row.asDict(recursive=True) for row in islice(rows, batch_size)]:
            write_batch(batch)

    documents.filter(F.col(KEY).isNotNull()).foreachPartition(send)
