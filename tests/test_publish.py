from __future__ import annotations

import time
import uuid
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from skyledger import session
from skyledger.operators import curate, publish, rollup_view
from skyledger.schemas import CLIMATE_DAILY, ddl
from skyledger.sources import tables


def daily(spark, *rows):
    base = dict.fromkeys(CLIMATE_DAILY) | {"source": "noaa", "obs_count": 1, "ingest_run_date": "2024-02-01"}
    full = []
    for station, day, temp, *extra in rows:
        row = base | {"source_station_id": station, "date": day, "avg_temp_c": temp, "year": day.year, "month": day.month}
        full.append(tuple((row | (extra[0] if extra else {})).values()))
    return spark.createDataFrame(full, ddl(CLIMATE_DAILY))


D1, D2, D3 = date(2023, 12, 31), date(2024, 1, 1), date(2024, 1, 2)


def test_documents(spark):
    document = publish.to_documents(daily(spark, ("S", D2, 1.0)), "processed").first()
    assert (document._id, document.date, document.dataLevel, document.recordType) == (
        "noaa|S|2024-01-01", "2024-01-01", "processed", "climate_daily",
    )


def test_latest_per_key(spark):
    documents = publish.to_documents(daily(
        spark, ("S", D2, 1.0), ("S", D2, 2.0, {"ingest_run_date": "2024-03-01"}), ("S", D2, None, {"ingest_run_date": "2024-03-01"}),
        ("T", D2, 5.0), ("T", D2, 6.0), ("T", D2, 6.0),
    )).union(publish.to_documents(daily(spark, ("U", D2, 1.0))).withColumn("_id", F.lit(None).cast("string")))
    got = {r._id: r.avg_temp_c for r in publish.latest_per_key(documents).collect()}
    assert got == {"noaa|S|2024-01-01": 2.0, "noaa|T|2024-01-01": 6.0}


def actions(merged):
    return {r._id.split("|")[1]: (r.action, r.avg_temp_c) for r in merged.collect()}


def test_merge(spark):
    old = publish.to_documents(daily(spark, ("A", D2, 1.0), ("B", D2, 2.0), ("C", D2, None)))
    new = publish.to_documents(daily(spark, ("B", D2, 2.5), ("C", D2, None), ("D", D2, 4.0)))
    merged = publish.merge_snapshot(old, new)
    assert actions(merged) == {
        "A": ("kept", 1.0), "B": ("replaced", 2.5), "C": ("unchanged", None), "D": ("inserted", 4.0),
    }
    assert tuple(publish.upsert_counts(merged, new.unionAll(new)).first()) == (6, 1, 1, 2)
    again = publish.merge_snapshot(merged.drop("action"), new)
    assert {a for a, _ in actions(again).values()} == {"kept", "unchanged"}
    assert again.drop("action").exceptAll(merged.drop("action")).count() == 0


@pytest.mark.parametrize("named", [tables.NAMED_PARTITIONS, 0])
def test_snapshot_on_disk(spark, tmp_path, monkeypatch, named):
    monkeypatch.setattr(tables, "NAMED_PARTITIONS", named)
    path = str(tmp_path / "snapshot")
    first = publish.to_documents(daily(spark, ("A", D1, 1.0), ("A", D2, 2.0), ("B", D2, 3.0)))
    assert tuple(tables.publish_snapshot(spark, path, first).first()) == (3, 3, 0, 0)
    untouched = {p.name for p in (tmp_path / "snapshot" / "source=noaa" / "year=2023").iterdir()}
    second = publish.to_documents(daily(spark, ("A", D2, 2.5), ("C", D3, 4.0), ("B", D2, 3.0)))
    assert tuple(tables.publish_snapshot(spark, path, second).first()) == (3, 1, 1, 2)
    rows = {(r._id, r.avg_temp_c) for r in spark.read.parquet(path).collect()}
    assert rows == {
        ("noaa|A|2023-12-31", 1.0), ("noaa|A|2024-01-01", 2.5), ("noaa|B|2024-01-01", 3.0), ("noaa|C|2024-01-02", 4.0),
    }
    assert {p.name for p in (tmp_path / "snapshot" / "source=noaa" / "year=2023").iterdir()} == untouched
    assert tuple(tables.publish_snapshot(spark, path, second).first()) == (3, 0, 0, 3)
    assert not list((tmp_path / "snapshot_staged").iterdir())
    touched = tables.touched_rows(spark.read.parquet(path), second, ("source", "year"))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert ("2024" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]) == (named > 0)
    assert {r.year for r in touched.collect()} == {2024}


def test_publish_batches_on_executors(spark, tmp_path):
    folder = str(tmp_path)

    def write(batch):
        import json
        import uuid
        with open(f"{folder}/{uuid.uuid4()}.json", "w") as out:
            json.dump([document["_id"] for document in batch], out)

    documents = spark.range(0, 25, 1, 2).select(F.when(F.col("id") != 3, F.col("id").cast("string")).alias("_id"))
    publish.publish_batches(documents, write, batch_size=10)
    import json
    batches = [json.loads(p.read_text()) for p in tmp_path.iterdir()]
    assert sorted(map(int, sum(batches, []))) == [i for i in range(25) if i != 3]
    assert max(map(len, batches)) <= 10


def rounded_years(frame):
    return sorted((r.source, r.noaa_station_id, r.year, r.days_covered, r.annual_avg_temp_c, r.annual_precip_mm, r.latitude) for r in frame.collect())


def test_view_follows_the_snapshot(spark, tmp_path):
    path, view = str(tmp_path / "snapshot"), str(tmp_path / "view")

    def at(station, day, temp, **extra):
        return station, day, temp, {"noaa_station_id": station, "latitude": 1.0, "avg_wind_mps": 10 / 3.6, **extra}

    publishes = [
        [at("A", D1, 1.0, precip_mm=0.1), at("A", D2, 2.0, precip_mm=0.2), at("B", D2, 3.0)],
        [at("A", D2, None, precip_mm=0.4), at("C", D3, 4.0), at("B", D2, 3.0)],
        # B moves to another state: its old station-year loses its last day.
        [at("B", D2, 3.5, state="AL", latitude=0.5), at("A", D3, 0.005, latitude=0.25)],
    ]
    for rows in publishes:
        tables.publish_with_view(spark, path, view, publish.to_documents(daily(spark, *rows)))
        whole = tables.read_table(spark, path, CLIMATE_DAILY)
        kept = rollup_view.read_years(tables.read_table(spark, view, rollup_view.VIEW))
        assert rounded_years(kept) == rounded_years(curate.station_years(whole))
    untouched = {p.name for p in (tmp_path / "view" / "source=noaa" / "year=2023").iterdir()}
    tables.publish_with_view(spark, path, view, publish.to_documents(daily(spark, *publishes[2])))
    assert {p.name for p in (tmp_path / "view" / "source=noaa" / "year=2023").iterdir()} == untouched
    # A publish that was broken off between snapshot and view: the next one sums the snapshot anew.
    session.set_mark(spark, f"{view}_unfinished")
    tables.publish_snapshot(spark, path, publish.to_documents(daily(spark, at("Z", D1, 9.0))))
    tables.publish_with_view(spark, path, view, publish.to_documents(daily(spark, at("Y", D1, 8.0))))
    whole = tables.read_table(spark, path, CLIMATE_DAILY)
    kept = rollup_view.read_years(tables.read_table(spark, view, rollup_view.VIEW))
    assert rounded_years(kept) == rounded_years(curate.station_years(whole))
    assert not session.has_mark(spark, f"{view}_unfinished")


@pytest.mark.parametrize("size", [tables.SLICE, 1, 3])
def test_slices_publish_what_the_whole_does(spark, tmp_path, monkeypatch, size):
    """Slice after slice of the partitions: the same counts, documents and sums; nothing stays beside the snapshot."""
    monkeypatch.setattr(tables, "SLICE", size)
    path, view = str(tmp_path / "snapshot"), str(tmp_path / "view")
    odd, none = {"source": "a b%20=c/d"}, {"source": None, "year": None}
    first = publish.to_documents(daily(spark, ("A", D1, 1.0), ("A", D2, 2.0), ("B", D2, 3.0, odd), ("C", D3, 4.0, none)))
    second = publish.to_documents(daily(
        spark, ("A", D2, 2.5), ("A", D2, 2.0), ("B", D2, 3.0, odd), ("C", D3, 5.0, none), ("C", D3, 4.5, none), ("D", D1, 6.0, odd),
    )).union(publish.to_documents(daily(spark, ("E", D2, 7.0))).withColumn("_id", F.lit(None).cast("string")))
    assert tuple(tables.publish_with_view(spark, path, view, first).first()) == (4, 4, 0, 0)
    assert tuple(tables.publish_with_view(spark, path, view, second).first()) == (6, 1, 2, 3)
    whole = tables.read_table(spark, path, CLIMATE_DAILY).select("source", "source_station_id", "year", "avg_temp_c")
    assert {(r.source, r.source_station_id, r.year, r.avg_temp_c) for r in whole.collect()} == {
        ("noaa", "A", 2023, 1.0), ("noaa", "A", 2024, 2.5), ("a b%20=c/d", "B", 2024, 3.0), (None, "C", None, 5.0), ("a b%20=c/d", "D", 2023, 6.0),
    }
    kept = tables.read_table(spark, view, rollup_view.VIEW).filter("days > 0")
    assert {(r.source, r.year, float(r.avg_temp_c_sum), r.days) for r in kept.collect()} == {
        ("noaa", 2023, 1.0, 1), ("noaa", 2024, 2.5, 1), ("a b%20=c/d", 2024, 3.0, 1), (None, None, 5.0, 1), ("a b%20=c/d", 2023, 6.0, 1),
    }
    assert not list((tmp_path / "snapshot_staged").iterdir()) and not list((tmp_path / "view_staged").iterdir())


def test_a_slice_is_merged_when_the_one_before_is_spent(spark, tmp_path, monkeypatch):
    """Of a slice that is merged its documents are gone, so documents and merge results do not lie side by side."""
    monkeypatch.setattr(tables, "SLICE", 1)
    left, merge = [], tables.merge_snapshot

    def watched(*args, **options):
        left.append(len({p.parent for p in (tmp_path / "snapshot_staged").glob("*/handed/*/*/part-*")}))
        return merge(*args, **options)

    monkeypatch.setattr(tables, "merge_snapshot", watched)
    documents = publish.to_documents(daily(spark, ("A", D1, 1.0), ("A", D2, 2.0), ("B", D2, 3.0, {"source": "a b%20=c/d"})))
    tables.publish_snapshot(spark, str(tmp_path / "snapshot"), documents)
    assert left == [3, 2, 1]


def test_publishing_leaves_no_large_shuffle(spark, tmp_path):
    """What the writes of a publish shuffle is gone when it ends, not when the driver collects its garbage."""
    rows = spark.range(20_000).selectExpr("concat('S', id) AS source_station_id", "rand(7) AS avg_temp_c").withColumns({
        name: F.lit({"source": "noaa", "date": D2, "year": 2024, "month": 1}.get(name)).cast(kind)
        for name, kind in CLIMATE_DAILY.items() if name not in ("source_station_id", "avg_temp_c")
    }).select(*CLIMATE_DAILY)

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {str(f) for f in map(files.apply, range(files.size())) if "shuffle_" in str(f) and f.length() > 20_000}

    before, settings = shuffled(), spark.conf.get(session.FREED, None)
    tables.publish_with_view(spark, str(tmp_path / "snapshot"), str(tmp_path / "view"), publish.to_documents(rows))
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(session.FREED, None) == settings


def test_compared_snapshots_show_lost_documents(spark):
    before = publish.to_documents(daily(spark, ("A", D2, 1.0), ("B", D2, 2.0), ("C", D2, None)))
    after = publish.to_documents(daily(spark, ("B", D2, 2.5), ("C", D2, None), ("D", D2, 4.0)))
    assert actions(publish.compare_snapshots(before, after)) == {
        "A": ("lost", 1.0), "B": ("replaced", 2.5), "C": ("unchanged", None), "D": ("inserted", 4.0),
    }


def test_compared_snapshots_tell_kept_from_unchanged(spark):
    """A document that was handed over again as it was, twice even, is not one that nobody handed over."""
    before = publish.to_documents(daily(spark, ("A", D2, 1.0), ("B", D2, 2.0), ("C", D2, None), ("E", D2, 5.0)))
    after = publish.to_documents(daily(spark, ("A", D2, 1.0), ("B", D2, 2.5), ("C", D2, None), ("D", D2, 4.0)))
    handed = publish.to_documents(daily(spark, ("B", D2, 2.5), ("C", D2, None), ("D", D2, 4.0), ("C", D2, None)))
    assert actions(publish.compare_snapshots(before, after, handed=handed)) == {
        "A": ("kept", 1.0), "B": ("replaced", 2.5), "C": ("unchanged", None), "D": ("inserted", 4.0), "E": ("lost", 5.0),
    }


def test_bucketed_snapshot_is_not_moved(spark, tmp_path):
    """Like a merge of frames, publish after publish; only the documents that come are shuffled."""
    table = "snapshot_" + uuid.uuid4().hex
    old = publish.to_documents(daily(spark, ("A", D2, 1.0), ("B", D2, 2.0), ("C", D2, None)))
    new = publish.to_documents(daily(spark, ("B", D2, 2.5), ("C", D2, None), ("D", D2, 4.0), ("D", D2, 3.0)))
    assert tuple(tables.publish_bucketed(spark, table, str(tmp_path), old, 4).first()) == (3, 3, 0, 0)
    assert tuple(tables.publish_bucketed(spark, table, str(tmp_path), new, 4).first()) == (4, 1, 1, 2)
    assert actions(spark.table(table)) == {
        "A": ("kept", 1.0), "B": ("replaced", 2.5), "C": ("unchanged", None), "D": ("inserted", 4.0),
    }
    assert tuple(tables.publish_bucketed(spark, table, str(tmp_path), new, 4).first()) == (4, 0, 0, 3)
    assert len(list(tmp_path.iterdir())) == 1
    incoming = publish.latest_per_key(new.repartition(4, publish.KEY))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = publish.merge_snapshot(spark.table(table).select(*incoming.columns), incoming)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan


def test_cells_serve_filters_by_date_and_by_station(spark, tmp_path):
    """Either filter leaves out most files; in published order a station is in every file."""
    rows = spark.range(64 * 64).selectExpr(
        "'x' AS source", "date_add(date '2024-01-01', cast(id % 64 AS int)) AS date", "format_string('S%03d', id div 64) AS source_station_id", "id AS v"
    )
    path = str(tmp_path / "cells")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_in_cells(rows, path, 16)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(path).exceptAll(rows).count() == 0 and spark.read.parquet(path).count() == 4096

    def touched(column, value):
        files = [pq.ParquetFile(file) for file in (tmp_path / "cells").glob("*.parquet")]
        held = 0
        for file in files:
            at = file.schema_arrow.names.index(column)
            stats = [file.metadata.row_group(g).column(at).statistics for g in range(file.metadata.num_row_groups)]
            held += any(s.min <= value <= s.max for s in stats)
        return held, len(files)

    for column, value in (("source_station_id", "S040"), ("date", date(2024, 2, 9))):
        held, files = touched(column, value)
        assert files >= 12 and held <= files / 2
    empty = rows.filter("v < 0")
    assert curate.cell_order(empty, 4).count() == 0
