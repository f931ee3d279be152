"""Reading and writing processed and curated datasets, ledgers, metrics and snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import rollup_view
from skyledger.operators.curate import cell_order, publication_order
from skyledger.operators.publish import KEY, latest_per_key, merge_snapshot, snapshot_changes, upsert_counts
from skyledger.schemas import CLIMATE_DAILY, FAILURES, PROCESSED_DATASETS, RUN_METRICS, conform, ddl
from skyledger.session import has_mark, remove_folder, set_mark, settle, shuffles_freed
from skyledger.sources.raw import optional

#: As many touched partitions are named in the scan of a snapshot; beyond that they are found by a join.
NAMED_PARTITIONS = 2000
#: Touched partitions are merged together up to this many documents, so that no more are shuffled at a time; a larger
#: partition is merged by itself.
SLICE = 25_000_000


def read_table(spark: SparkSession, path: str, schema: Mapping[str, str]) -> DataFrame:
    """A Parquet dataset in the schema's column order; partition columns keep its types."""
    return spark.read.schema(ddl(schema)).parquet(path).select(*schema)


def read_by_footers(spark: SparkSession, path: str, schema: Mapping[str, str]) -> DataFrame:
    """As ``read_table``, for counts, minima and maxima of whole partitions, which come from the files' footers.

    Of such aggregates over partition columns no data page is read. The frame belongs to a session of its own, whose
    reader pushes aggregates down; other readers of the calling session stay as they are.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own.read.schema(ddl(schema)).parquet(path)


def read_existing(spark: SparkSession, root: str, sources: list[str], schema: Mapping[str, str]) -> list[DataFrame]:
    """Processed datasets of the named sources; unknown names and missing datasets are passed over."""
    frames = [
        optional(lambda path=f"{root}/{PROCESSED_DATASETS[source]}": read_table(spark, path, schema))
        for source in sources
        if source in PROCESSED_DATASETS
    ]
    found = [frame for frame in frames if frame is not None]
    if not found:
        raise FileNotFoundError(f"no processed datasets found for sources {sources}")
    return found


def overwrite_partitions(df: DataFrame, path: str, *partition_by: str, ordered: bool = False) -> None:
    """Writes Parquet, replacing just the partitions that ``df`` has rows for.

    ``ordered`` lays rows out by newest date, source and station, at the cost of a range
    shuffle. Otherwise partitions are rebalanced: small ones merged, large ones cut up.
    """
    rows = publication_order(df) if ordered else df.hint("rebalance", *partition_by)
    with shuffles_freed(rows.sparkSession):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by)
            .parquet(path)
        )


def write_in_cells(df: DataFrame, path: str, files: int) -> None:
    """Writes daily rows so that files hold few dates and few stations each; see ``curate.cell_order``."""
    cell_order(df, files).write.mode("overwrite").parquet(path)


def overwrite_run(
    df: DataFrame, path: str, partition: str, run_date: str, ordered: bool = False, staged: bool = False
) -> None:
    """Replaces one run's partition of a Parquet dataset, also with nothing; ``ordered`` as above.

    ``staged`` writes the rows beside the dataset first: if that fails, the run's earlier rows stay.
    """
    target = f"{path}/{partition}={run_date}"
    rows = (publication_order(df) if ordered else df.hint("rebalance")).drop(partition)
    beside = f"{path.rstrip('/')}_staged/{uuid.uuid4().hex}"
    if staged:
        rows = settle(rows, "run", beside)
    rows.write.mode("overwrite").parquet(target)
    if staged:
        remove_folder(df.sparkSession, beside)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replaces a small unpartitioned Parquet dataset."""
    df.write.mode("overwrite").parquet(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines with sorted keys; nulls are written."""
    df.select(*sorted(df.columns)).write.mode(mode).option("ignoreNullFields", False).json(path)


def append_failures(failures: DataFrame, path: str) -> None:
    """Adds ledger rows with the time they were logged."""
    logged = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    write_json_lines(conform(failures, FAILURES, logged_at=logged), path, "append")


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ddl(FAILURES)).json(path)


def write_metrics(metrics: DataFrame, root: str, source: str, run_date: str) -> None:
    write_json_lines(metrics.coalesce(1), f"{root}/{source}_daily/metrics/run_date={run_date}")


def read_metrics(spark: SparkSession, root: str, source: str, run_date: str) -> DataFrame | None:
    """One source's metrics of one run, or nothing if it wrote none."""
    path = f"{root}/{source}_daily/metrics/run_date={run_date}"
    return optional(lambda: spark.read.schema(ddl(RUN_METRICS)).json(path))


def publish_snapshot(
    spark: SparkSession,
    path: str,
    documents: DataFrame,
    partition_by: tuple[str, ...] = ("source", "year"),
    order: str = "ingest_run_date",
    replaced: tuple[str, ...] = (),
    changed: Callable[[DataFrame], object] | None = None,
) -> DataFrame:
    """Merges documents into the snapshot at ``path`` and returns what was done, as counts.

    Only partitions with incoming documents are read and rewritten, so a document's key must fix
    its partition. Their values, at most ``NAMED_PARTITIONS``, are named in the scan. The merge
    result is written beside the snapshot first: the snapshot's files are replaced only once it is
    whole, and counts need no second merge. What was staged is removed at the end.

    The documents are computed once, into folders by partition, and merged by slices of those. So beside the snapshot
    lie, of each slice, its documents or its merge result, and what a single slice shuffles. ``changed`` is handed the
    changes of the merge, in the fields ``replaced``, before any file is replaced.
    """
    beside = f"{path.rstrip('/')}_staged/{uuid.uuid4().hex}"
    handed = settle(documents.filter(F.col(KEY).isNotNull()), "handed", f"{beside}/handed", partition_by, freed=True)
    existing = optional(lambda: spark.read.schema(documents.schema).parquet(path).select(*documents.columns))
    if existing is None:
        existing = spark.createDataFrame([], documents.schema)
    staged, done = {}, []
    for number, (part, folders) in enumerate(slices(handed, partition_by, f"{beside}/handed")):
        merged = merge_snapshot(
            touched_rows(existing, part, partition_by, None), latest_per_key(part, order=order), replaced=replaced
        )
        folder = f"{beside}/merged/{number}"
        staged[folder] = settle(merged, "merged", folder, freed=True)
        done.append(upsert_counts(staged[folder], part).first())
        for spent in folders:
            remove_folder(spark, spent)
    if changed:
        changed(reduce(DataFrame.unionByName, map(snapshot_changes, staged.values())))
    for folder, merged in staged.items():
        overwrite_partitions(merged.select(*documents.columns), path, *partition_by)
        remove_folder(spark, folder)
    remove_folder(spark, beside)
    counts = tuple(map(sum, zip(*done)))
    return spark.createDataFrame([counts], "to_process bigint, upserted bigint, modified bigint, matched bigint")


def slices(handed: DataFrame, partition_by: tuple[str, ...], path: str) -> list[tuple[DataFrame, list[str]]]:
    """Rows that lie at ``path`` in a folder per partition, and their folders: partitions together up to ``SLICE`` rows.

    All at once if there are no more rows than that, or very many partitions.
    """
    folder = F.regexp_replace(F.input_file_name(), "/[^/]*$", "").alias("_folder")
    counted = handed.select(*partition_by, folder).groupBy(*partition_by, "_folder").agg(F.count(F.lit(1)).alias("_rows"))
    found = counted.limit(NAMED_PARTITIONS + 1).collect()
    if len(found) > NAMED_PARTITIONS or sum(row["_rows"] for row in found) <= SLICE:
        return [(handed, [path])]
    groups, size = [], SLICE
    for row in sorted(found, key=lambda row: row["_rows"]):
        if size + row["_rows"] > SLICE:
            groups.append([])
            size = 0
        groups[-1].append(row)
        size += row["_rows"]
    # File names come as URIs, folders are removed by their path.
    jvm = handed.sparkSession._jvm
    return [
        (
            handed.filter(one_of(group, partition_by)),
            [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row["_folder"])).toString() for row in group],
        )
        for group in groups
    ]


def publish_bucketed(
    spark: SparkSession, table: str, path: str, documents: DataFrame, buckets: int, order: str = "ingest_run_date"
) -> DataFrame:
    """Merges documents into a snapshot kept as a table in buckets of its key; returns what was done, as counts.

    For snapshots whose keys do not tell their partition. The documents are dealt out to the buckets once, before the
    newest of each key is taken; the snapshot, whatever its size, is read bucket by bucket and not moved, and the
    merged rows are written by the tasks that hold their bucket. The table's ``action`` is that of the last
    publish. Files lie below ``path``; the table is exchanged when the new one is whole.
    """
    incoming = latest_per_key(documents.repartition(buckets, KEY), order=order)
    held = spark.catalog.tableExists(table)
    existing = spark.table(table).select(*incoming.columns) if held else spark.createDataFrame([], incoming.schema)
    following = f"{table}_next"
    spark.sql(f"DROP TABLE IF EXISTS {following}")
    (
        merge_snapshot(existing, incoming).write.bucketBy(buckets, KEY).sortBy(KEY)
        .option("path", f"{path.rstrip('/')}/{uuid.uuid4().hex}").saveAsTable(following)
    )
    counts = upsert_counts(spark.table(following), documents).first()
    if held:
        old = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first().data_type
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
    if held:
        remove_folder(spark, old)
    return spark.createDataFrame([counts], "to_process bigint, upserted bigint, modified bigint, matched bigint")


def publish_with_view(
    spark: SparkSession, path: str, view_path: str, documents: DataFrame, order: str = "ingest_run_date"
) -> DataFrame:
    """``publish_snapshot``, with the view of yearly sums at ``view_path`` kept up to date.

    Only station-years of documents that are added or replaced change, and only partitions with such are read and
    rewritten. While a publish is under way a mark lies beside the view; a publish that finds the mark of
    one that did not end builds the view anew from the snapshot first.
    """
    mark, beside = f"{view_path.rstrip('/')}_unfinished", f"{view_path.rstrip('/')}_staged/{uuid.uuid4().hex}"
    if has_mark(spark, mark):
        rebuild_view(spark, path, view_path)
    set_mark(spark, mark)
    partition_by, changes = ("source", "year"), f"{beside}/changes"
    counts = publish_snapshot(
        spark, path, documents, partition_by, order, rollup_view.STATED,
        lambda rows: settle(rollup_view.change_sums(rows), "changes", changes, freed=True),
    )
    sums = read_table(spark, changes, rollup_view.VIEW)
    view = optional(lambda: read_table(spark, view_path, rollup_view.VIEW))
    if view is not None:
        view = touched_rows(view, sums, partition_by, None)
        sums = settle(rollup_view.add_changes(view, sums), "view", f"{beside}/view", freed=True)
    overwrite_partitions(sums, view_path, *partition_by)
    remove_folder(spark, beside)
    remove_folder(spark, mark)
    return counts


def rebuild_view(spark: SparkSession, path: str, view_path: str) -> None:
    """Sums the whole snapshot, if there is one, into a new view."""
    snapshot = optional(lambda: read_table(spark, path, CLIMATE_DAILY))
    remove_folder(spark, view_path)
    if snapshot is not None:
        overwrite_partitions(rollup_view.change_sums(snapshot.withColumn("sign", F.lit(1))), view_path, "source", "year")


def touched_rows(
    existing: DataFrame, documents: DataFrame, partition_by: tuple[str, ...], key: str | None = KEY
) -> DataFrame:
    """Rows of the partitions that the documents belong to: named in the scan, or joined where they are many."""
    keyed = documents if key is None else documents.filter(F.col(key).isNotNull())
    touched = keyed.select(*partition_by).distinct()
    found = touched.limit(NAMED_PARTITIONS + 1).collect()
    if len(found) > NAMED_PARTITIONS:
        others = touched.select(*[F.col(name).alias(f"_{name}") for name in partition_by])
        same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in partition_by]
        return existing.join(others, reduce(Column.__and__, same), "left_semi")
    return existing.filter(one_of(found, partition_by))


def one_of(partitions: list[Row], partition_by: tuple[str, ...]) -> Column:
    """Whether a row's partition is one of those, null being a value."""
    held = F.lit(False)
    for row in partitions:
        same = F.lit(True)
        for name in partition_by:
            same = same & (F.col(name).isNull() if row[name] is None else F.col(name) == F.lit(row[name]))
        held = held | same
    return held


def overwrite_source(df: DataFrame, path: str, source: str, ordered: bool = False) -> None:
    """Replaces one source's part of a dataset partitioned by source and year, years that ``df`` lacks included."""
    rows = df.filter(F.col("source") == source).drop("source")
    rows = publication_order(rows.withColumn("source", F.lit(source))).drop("source") if ordered else rows.hint("rebalance", "year")
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("year")
        .parquet(f"{path}/source={source}")
    )
