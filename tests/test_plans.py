"""Properties of physical plans that must hold for large inputs."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from skyledger.plans import inputs, registry

SF_DIR = "/root/testdata/sf0.001"
BATCH = sorted(name for name in registry.QUERIES if not name.startswith("streaming_"))


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", BATCH)
def test_no_pairing_and_no_python(spark, no_broadcast, name):
    """Without broadcasts, every join is still an equi-join, and no row passes through Python."""
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert not re.search("CartesianProduct|NestedLoopJoin|PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas", text)
    assert "ResolvedHint" not in text


@pytest.mark.parametrize("name", ["long_to_wide_daily", "obs_daily_summary", "yearly_station", "yearly_source", "run_metrics"])
def test_raw_rows_are_combined_in_hash_maps(spark, name):
    """The aggregates next to the scans keep their partial results in hash maps."""
    text = plan(contract.queries()[name](spark, SF_DIR))
    branches = text.split("FileScan parquet")[:-1]
    for branch in branches:
        aggregates = re.findall(r"(\w+Aggregate)", branch)
        assert not aggregates or aggregates[-1] == "HashAggregate"


def test_wide_rows_do_not_shuffle(spark):
    assert "Exchange" not in plan(registry.wide_daily(spark, SF_DIR))


def test_pivot_shuffles_once(spark):
    assert plan(registry.long_to_wide_daily(spark, SF_DIR)).count("Exchange") == 1


def test_rollup_reads_only_what_it_needs(spark):
    text = plan(registry.yearly_station(spark, SF_DIR))
    lineitem = next(m for m in re.findall(r"ReadSchema: struct<[^\n]*", text) if "l_suppkey" in m)
    assert "l_partkey" not in lineitem and "l_returnflag" not in lineitem


def test_checks_reach_the_scan(spark, tmp_path):
    from skyledger.operators import wide_rows
    path = str(tmp_path / "raw")
    inputs.raw_wide(spark, SF_DIR).write.parquet(path)
    text = plan(wide_rows.wide_to_daily(spark.read.parquet(path)))
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(noaa_station_id\), IsNotNull\(meteostat_station_id\)", text)


def test_partition_writes_are_rebalanced(spark):
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(registry.unified(spark, SF_DIR).hint("rebalance", "source", "year"))


def test_report_filters_reach_the_scan(spark):
    from skyledger.operators import curate
    from skyledger.sources import tables
    import tempfile
    path = tempfile.mkdtemp()
    daily = registry.unified(spark, SF_DIR)
    tables.overwrite_partitions(daily, path, "source", "year")
    from skyledger.schemas import CLIMATE_DAILY
    read = tables.read_table(spark, path, CLIMATE_DAILY)
    text = plan(curate.warmest_stations(read, 1998))
    assert re.search(r"PartitionFilters: \[[^\]]*year[^\]]*1998", text)
    assert "TakeOrderedAndProject" in text
    assert re.search(r"ReadSchema: struct<station_name:string,avg_temp_c:double>", text)


def test_top_rows_are_taken_per_task(spark):
    assert "TakeOrderedAndProject" in plan(registry.warmest_stations(spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan(registry.observation_samples(spark, SF_DIR))


def test_publication_order_splits_a_hot_day(spark):
    from skyledger.operators.curate import publication_order
    hot = inputs.table(spark, SF_DIR, "lineitem").selectExpr(
        "date '2024-01-01' AS date", "'x' AS source", "'s' AS source_station_id", "l_orderkey", "l_linenumber"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = publication_order(hot).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 0.4 * sum(sizes)


def test_folders_of_other_stations_are_not_read(spark, tmp_path):
    """The manifest's stations are looked up when the query runs, and only their folders are scanned."""
    from skyledger.operators import incremental
    path = str(tmp_path / "landed")
    spark.range(40).selectExpr("id AS v", "concat('K', id) AS station").write.partitionBy("station").parquet(path)
    landed = spark.read.schema("v long, station string").parquet(path)
    kept = incremental.prune_to_manifest(landed, inputs.manifest(spark, SF_DIR).filter("nws_station_id IN ('K3', 'K5', 'K7')"))
    assert "dynamicpruning" in plan(kept)
    assert kept.count() == len({"K3", "K5", "K7"} & {r.nws_station_id for r in inputs.manifest(spark, SF_DIR).collect()})


def test_extents_come_from_footers(spark, tmp_path):
    from skyledger.operators import curate
    from skyledger.schemas import CLIMATE_DAILY
    from skyledger.sources import tables
    path = str(tmp_path / "daily")
    tables.overwrite_partitions(registry.unified(spark, SF_DIR), path, "source", "year")
    found = curate.extent_by_year(tables.read_by_footers(spark, path, CLIMATE_DAILY))
    text = plan(found)
    assert re.search(r"PushedAggregation: \[COUNT\(\*\), COUNT\(avg_temp_c\), MIN\(date\), MAX\(date\)\]", text)
    assert re.search(r"PushedGroupBy: \[source, year\]", text)
    # The calling session reads as before.
    assert "PushedAggregation" not in plan(curate.extent_by_year(tables.read_table(spark, path, CLIMATE_DAILY)))
