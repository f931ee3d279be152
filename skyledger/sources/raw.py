"""Readers of landed raw files. All give lazy DataFrames with fixed schemas."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.values import whole_number
from skyledger.schemas import (
    CATALOG,
    LONG_PAGE,
    MANIFEST,
    RAW_LONG,
    RAW_OBSERVATIONS,
    RAW_WIDE,
    MissingColumnsError,
    conform,
    ddl,
    missing_columns,
)

# Names of landed files.
LONG_FILE = "noaa_daily.jsonl"
WIDE_FILE = "meteostat_daily.jsonl"
OBSERVATION_FILE = "nws_raw.json"

# Landed by an outside client under its fixed name, or by ``plans.runs`` as part files.
ANY_PART = "part-*"

GHCN_FIELDS = ("station_id", "raw_day", "datatype", "raw_value", "mflag", "qflag", "sflag", "obs_time")
STATION_YEAR_FIELDS = (
    "date", "time", "year", "month", "day", "temp", "tmin", "tmax", "prcp", "snwd", "wspd", "wpgt",
)
STATION_YEAR_COLUMNS = 32


def optional(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or nothing if its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _json_lines(
    spark: SparkSession, root: str, schema: dict[str, str], file_name: str, run_date: str | None, malformed: bool
) -> DataFrame:
    fields = schema | {"malformed": "string"} if malformed else schema
    rows = (
        spark.read.schema(ddl(fields))
        .option("pathGlobFilter", f"{{{file_name},{ANY_PART}}}")
        .option("columnNameOfCorruptRecord", "malformed")
        .option("basePath", root)
        # Only the run's own folder is listed.
        .json(root if run_date is None else f"{root}/run_date={run_date}")
        .select(*fields)
    )
    return rows


def read_long(spark: SparkSession, root: str, run_date: str | None = None, malformed: bool = False) -> DataFrame:
    """Raw long rows below ``root/run_date=…``; other runs' folders are pruned.

    A malformed line gives a row of nulls, with its text in ``malformed`` if asked for.
    """
    return _json_lines(spark, root, RAW_LONG, LONG_FILE, run_date, malformed)


def read_wide(spark: SparkSession, root: str, run_date: str | None = None, malformed: bool = False) -> DataFrame:
    """Raw wide rows, laid out as for ``read_long``."""
    return _json_lines(spark, root, RAW_WIDE, WIDE_FILE, run_date, malformed)


def stated_fields(lines: DataFrame, required: list[str]) -> DataFrame:
    """Those of the required fields that some JSON line in ``value`` states; broken lines state none."""
    return (
        lines.select(F.explode(F.json_object_keys("value")).alias("field"))
        .filter(F.col("field").isin(required))
        .distinct()
    )


def check_fields(spark: SparkSession, root: str, file_name: str, required: Iterable[str]) -> None:
    """Fails if some required field is stated by no line at all. Reads the files once."""
    required = list(required)
    stated = stated_fields(spark.read.option("pathGlobFilter", f"{{{file_name},{ANY_PART}}}").text(root), required)
    # At most one row per required field.
    missing = missing_columns([row.field for row in stated.collect()], required)
    if missing:
        raise MissingColumnsError(f"{root}: missing required columns: {', '.join(missing)}")


def read_payloads(spark: SparkSession, root: str, run_date: str | None = None) -> DataFrame:
    """Raw observation payloads with their path, one document per file.

    Files lie below ``root/run_date=…``, with or without a folder per station. Without a run
    date and without any such folder, the legacy layout beside ``root`` is read.
    """
    def read(path: str) -> DataFrame:
        return (
            spark.read.schema(ddl(RAW_OBSERVATIONS))
            .option("multiLine", True)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", OBSERVATION_FILE)
            .json(path)
            .select(F.col("_metadata.file_path").alias("path"), "features")
        )

    landed = optional(lambda: read(f"{root}/run_date={run_date or '*'}"))
    if landed is not None:
        return landed
    if run_date is not None:
        raise FileNotFoundError(f"no observations landed for run date {run_date} below {root}")
    above = root.rstrip("/").rpartition("/")[0]
    return read(f"{above}/*/{OBSERVATION_FILE}")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The station manifest, by column names of its header; columns it lacks are null."""
    rows = spark.read.option("header", True).csv(path)
    rank = whole_number(F.col("priority_rank")) if "priority_rank" in rows.columns else None
    return conform(rows, MANIFEST, priority_rank=rank)


def read_ghcn_lines(spark: SparkSession, path: str) -> DataFrame:
    """By-station file lines; shorter ones than eight fields go, longer ones lose the rest.

    Split as text: a CSV reader treats long lines like short ones.
    """
    return split_ghcn_lines(spark.read.text(path))


def split_ghcn_lines(lines: DataFrame) -> DataFrame:
    """The eight fields of each line in ``value`` that has as many."""
    fields = lines.select(F.split("value", ",").alias("fields")).filter(F.size("fields") >= 8)
    return fields.select(*[F.col("fields")[i].alias(name) for i, name in enumerate(GHCN_FIELDS)])


def read_station_years(spark: SparkSession, root: str, start: date, end: date) -> DataFrame:
    """Lines of the station-year files ``root/<year>/<station>.csv.gz`` of a window's years.

    Years without files are passed over. A file holds a station's days of one year, so it is read whole, as a row of
    its own: its first line is at hand wherever it is parsed, and files are read once, in one plan for all layouts.
    """
    years = ",".join(str(year) for year in range(start.year, end.year + 1))
    files = spark.read.text(f"{root}/{{{years}}}/*.csv*", wholetext=True)
    return split_station_years(files.select(F.col("_metadata.file_path").alias("path"), "value"))


def split_station_years(files: DataFrame) -> DataFrame:
    """The known fields of each line behind the first of whole files (``path``, ``value``).

    The station is named by the path, the fields by the file's first line, quoted or not, of which the first
    ``STATION_YEAR_COLUMNS`` count. Blank lines go; a line that ends early lacks its last fields. A file without
    any known field gives rows of nulls, whose date counts as missing.
    """
    columns = ", ".join(f"c{i} string" for i in range(STATION_YEAR_COLUMNS))

    def cells(line: Column) -> Column:
        row = F.from_csv(line, columns)
        return F.array(*[row[f"c{i}"] for i in range(STATION_YEAR_COLUMNS)])

    station = F.regexp_extract("path", r"([^/]+)\.csv(\.gz)?$", 1).alias("meteostat_station_id")
    lines = files.select(station, F.split("value", "\r?\n").alias("lines")).select(
        "meteostat_station_id", F.transform(cells(F.col("lines")[0]), lambda name: F.lower(F.trim(name))).alias("names"),
        F.explode(F.slice("lines", F.lit(2), F.greatest(F.size("lines") - 1, F.lit(0)))).alias("line"),
    )
    rows = lines.filter(F.trim("line") != "").select("meteostat_station_id", "names", cells(F.col("line")).alias("cells"))

    def field(name: str) -> Column:
        place = F.array_position(F.transform("names", lambda stated: F.coalesce(stated, F.lit(""))), name)
        return F.when(place > 0, F.get("cells", (place - 1).cast("int"))).alias(name)

    return rows.select("meteostat_station_id", *[field(name) for name in STATION_YEAR_FIELDS])


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue stations with their position in the file, of which there must be one.

    A multi-line document is read by one task in its order; several files have no order among them.
    """
    stations = spark.read.schema(ddl(CATALOG)).option("multiLine", True).json(path)
    if len(files := stations.inputFiles()) > 1:
        raise ValueError(f"a catalogue is one file, found {len(files)} at {path}")
    return stations.select(F.monotonically_increasing_id().alias("position"), *CATALOG)


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """Landed result pages below ``root/noaa_station_id=…``."""
    return (
        spark.read.schema(ddl(LONG_PAGE | {"noaa_station_id": "string"}))
        .option("multiLine", True)
        .json(root)
        .select("noaa_station_id", *LONG_PAGE)
    )
