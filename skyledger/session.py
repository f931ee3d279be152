"""Session settings for runs that own their session; operators take any session."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "skyledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution, for scripts and tests.

    On a cluster, leave ``master`` unset and size executors and
    ``spark.sql.shuffle.partitions`` at submission; adaptive execution then coalesces small
    partitions and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.showConsoleProgress": "false",
        # Recording the Python line of every column expression makes up most of the time it takes
        # to build a large plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def runs_here(master: str) -> bool:
    """Whether tasks run in the driver's process."""
    return master == "local" or master.startswith("local[")


#: Whether what an action shuffles is removed with its end, not when the driver happens to collect its garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes within leave no shuffle files; for those whose frame is not used again."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder that a finished job has staged, in whatever store it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def set_mark(spark: SparkSession, path: str) -> None:
    """Makes an empty folder that says something is under way, in whatever store it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)


def has_mark(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def scratch_dir(spark: SparkSession, prefix: str) -> str:
    """A new folder path below the cluster's shared ``spark.checkpoint.dir``.

    Where that is unset, a local temporary folder is used if all tasks run in this very process, as
    in tests; on a cluster it is an error, as executors would each write to their own disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not runs_here(spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        return tempfile.mkdtemp(prefix=f"{prefix}-")
    run = spark.sql("SELECT uuid()").first()[0]
    return f"{shared.rstrip('/')}/{prefix}-{run}"


def settle(
    df: DataFrame, prefix: str, path: str | None = None, partition_by: tuple[str, ...] = (), freed: bool = False
) -> DataFrame:
    """Writes a frame that a plan would otherwise compute many times, and reads it back.

    Below the shared scratch folder, or at ``path``; in folders by ``partition_by``, if any. What was shuffled for it
    is removed at once if ``freed``.
    """
    spark = df.sparkSession
    path = path or f"{scratch_dir(spark, prefix)}/table"
    with shuffles_freed(spark) if freed else nullcontext():
        df.write.partitionBy(*partition_by).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    return table.select(*df.columns) if partition_by else table
