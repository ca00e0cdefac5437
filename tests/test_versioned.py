"""Versioned tables, the fingerprint index, concurrent loads and resumed runs."""

from __future__ import annotations

import glob
import os

import pytest
from conftest import bronze_df, raw_row
from pyspark.sql import functions as F
from test_csv_bronze import write

from innkeep.operators import bronze as B
from innkeep.operators import fingerprint_index as index
from innkeep.plans import pipeline as P
from innkeep.session import staging_path
from innkeep.sources.tables import read_layer, write_layer
from innkeep.sources.versioned import Conflict, VersionedTable


def keys(n, first=0, salt="k"):
    return [raw_row(company=f"{salt}{i}") for i in range(first, first + n)]


def staged_rows(spark, tmp, rows):
    path = str(tmp / f"batch-{len(glob.glob(str(tmp / '*')))}")
    bronze_df(spark, rows).write.parquet(path)
    return spark.read.parquet(path)


def companies(df):
    return sorted(r.company for r in df.collect())


# ---------------------------------------------------------------- the log
def test_a_taken_version_is_a_conflict(spark, tmp_path):
    one, other = (VersionedTable(spark, str(tmp_path / "t")) for _ in range(2))
    base = other.latest()
    assert base.version == -1 and one.frame() is None
    one.replace(spark.range(3))
    with pytest.raises(Conflict):
        other.publish(base, ("data/x",), 1)
    assert one.latest().version == 0 and one.frame().count() == 3


def test_a_failed_refresh_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "layer")
    write_layer(spark.range(5).withColumn("p", F.col("id") % 2), path, partition_by=["p"])
    held = read_layer(spark, path)
    broken = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_layer(broken, path)
    assert read_layer(spark, path).count() == 5
    assert len(os.listdir(tmp_path / "layer" / "data")) == 1  # nothing of the failed one stays
    write_layer(read_layer(spark, path).where("id > 2"), path)  # a refresh may read its own table
    assert read_layer(spark, path).count() == 2 and held.count() == 5
    write_layer(spark.range(1), path, mode="append")
    table = VersionedTable(spark, path)
    assert table.versions() == [0, 1, 2] and table.frame(table.entry(0)).count() == 5
    assert len(table.vacuum(keep=1)) == 1 and read_layer(spark, path).count() == 3
    with pytest.raises(FileNotFoundError):
        read_layer(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError):
        write_layer(spark.range(1), path, mode="ignore")


# ---------------------------------------------------------------- two loads at once
def test_interleaved_loads_store_a_fingerprint_once(spark, tmp_path):
    path = str(tmp_path / "bronze")
    table = VersionedTable(spark, path)
    B.append_absent(table, staged_rows(spark, tmp_path, keys(4)))
    decided_on = table.latest()
    # both loads look at the same version; the second publishes after the first
    B.append_absent(table, staged_rows(spark, tmp_path, keys(5, 2)), base=decided_on)
    entry, inserted, folder = B.append_absent(table, staged_rows(spark, tmp_path, keys(7, 3)), base=decided_on)
    assert companies(B.read_bronze(spark, path)) == sorted(f"k{i}" for i in range(10))
    assert (inserted, entry.rows, entry.version) == (3, 10, 2)
    assert companies(spark.read.parquet(table.at(folder))) == ["k7", "k8", "k9"]
    assert len(os.listdir(f"{path}/data")) == 3  # the rows that were decided on too early are gone
    # a load that finds all its rows taken meanwhile adds nothing
    entry, inserted, folder = B.append_absent(table, staged_rows(spark, tmp_path, keys(3, 7)), base=decided_on)
    assert (entry.version, inserted, folder) == (2, 0, None)


def test_loads_of_other_ranges_do_not_check_again(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "bronze"))
    base = table.latest()
    first = staged_rows(spark, tmp_path, keys(1))
    taken = B._count_and_ranges(first)[1]
    other = next(i for i in range(1, 50) if B._count_and_ranges(bronze_df(spark, keys(1, i)))[1] != taken)
    B.append_absent(table, first, base=base)
    calls = []
    absent = index.absent
    monkeypatch.setattr(index, "absent", lambda *a: calls.append(a) or absent(*a))
    B.append_absent(table, staged_rows(spark, tmp_path, keys(1, other)), base=base)
    assert len(calls) == 1 and B.read_bronze(spark, table.path).count() == 2


def test_readers_see_whole_loads_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bronze")
    table = VersionedTable(spark, path)
    B.append_absent(table, staged_rows(spark, tmp_path, keys(2)))

    def lost(*args, **notes):
        assert B.read_bronze(spark, path).count() == 2  # the new rows are written, not published
        raise OSError("driver lost")

    monkeypatch.setattr(VersionedTable, "publish", lost)
    with pytest.raises(OSError):
        B.append_absent(table, staged_rows(spark, tmp_path, keys(9)))
    monkeypatch.undo()
    assert B.read_bronze(spark, path).count() == 2
    assert B.append_absent(table, staged_rows(spark, tmp_path, keys(9)))[1] == 7
    table.vacuum(keep=1)
    assert B.read_bronze(spark, path).count() == 9
    assert B.append_absent(table, staged_rows(spark, tmp_path, keys(10)))[1] == 1


# ---------------------------------------------------------------- the index
def bytes_read(spark, run):
    """Bytes of input and rows that the tasks of ``run`` have read, by Spark's own counters."""
    store = spark.sparkContext._jsc.sc().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    seen = {s.stageId() for s in _stages(store)}
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    new = [s for s in _stages(store) if s.stageId() not in seen]
    return sum(s.inputBytes() for s in new), sum(s.inputRecords() for s in new)


def _stages(store):
    found = store.stageList(None, False, False, getattr(store, "stageList$default$4")(), None)
    return [found.apply(i) for i in range(found.size())]


def test_index_reads_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index, "BUCKET_ROWS", 64)
    batch = staged_rows(spark, tmp_path, keys(3) + keys(5, salt="new"))
    read = {}
    for n in (1000, 8000):
        table = VersionedTable(spark, str(tmp_path / f"bronze{n}"))
        rows = bronze_df(spark, [raw_row()]).select(*[c for c in bronze_df(spark, [raw_row()]).columns if c != "_row_hash"])
        many = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("_row_hash"))
        many = many.crossJoin(rows).unionByName(bronze_df(spark, keys(3))).select(*batch.columns)
        many.write.parquet(str(tmp_path / f"many{n}"))
        B.append_absent(table, spark.read.parquet(str(tmp_path / f"many{n}")))
        segments = index.segments_of(table.latest())
        assert [s["depth"] for s in segments] == [index.depth_for(n + 3)]
        stored = index.stored_keys(table, segments, batch)
        read[n] = bytes_read(spark, lambda s=stored: s.write.format("noop").mode("overwrite").save())
        found = index.absent(table, segments, batch)
        assert companies(found) == [f"new{i}" for i in range(5)]
    assert read[8000][1] <= 1.5 * read[1000][1] <= 8 * 64 * 3
    assert read[8000][0] <= 1.5 * read[1000][0]


def test_segments_merge_and_equal_a_plain_anti_join(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index, "BUCKET_ROWS", 8)
    table = VersionedTable(spark, str(tmp_path / "bronze"))
    seen: set[str] = set()
    for first, n in ((0, 40), (35, 10), (0, 3), (45, 1), (30, 30), (100, 2), (101, 2), (102, 2)):
        batch = staged_rows(spark, tmp_path, keys(n, first) * 2)
        own = {f"k{i}" for i in range(first, first + n)}
        assert B.append_absent(table, batch)[1] == len(own - seen)
        seen |= own
        segments = index.segments_of(table.latest())
        assert len(segments) <= 4 and sum(s["rows"] for s in segments) == len(seen)
        assert all(a["rows"] > b["rows"] for a, b in zip(segments, segments[1:], strict=False))
    assert companies(B.read_bronze(spark, table.path)) == sorted(seen)
    before = B.read_bronze(spark, table.path).select("_row_hash").distinct().count()
    made = index.rebuild(spark, table)
    assert [s["rows"] for s in index.segments_of(made)] == [before] == [len(seen)]
    assert B.append_absent(table, staged_rows(spark, tmp_path, keys(41)))[1] == 0


# ---------------------------------------------------------------- resumed runs
def test_a_resumed_run_begins_at_the_failed_stage(spark, tmp_path, monkeypatch):
    path = write(tmp_path / "drop.csv", [raw_row(arrival_date_day_of_month=str(d)) for d in (1, 2, 3)])
    layout = P.Layout(staging_path(spark, "wh"))
    built = []
    for name in ("build_silver", "quality_report"):
        monkeypatch.setattr(P, name, lambda *a, f=getattr(P, name), name=name: built.append(name) or f(*a))
    monkeypatch.setattr(P, "load_csv", lambda *a, f=P.load_csv, **k: built.append("load") or f(*a, **k))
    with monkeypatch.context() as m:
        m.setattr(P.gold, "popular_countries", lambda df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            P.run_pipeline(spark, path, layout, min_rows=1, resume=True)
    assert built == ["load", "build_silver"]
    run = P.run_pipeline(spark, path, layout, min_rows=1, resume=True)
    assert built == ["load", "build_silver", "quality_report"]
    metrics = run.load.metrics.first()
    assert (metrics.rows_read, metrics.inserted, metrics.total) == (3, 3, 3) and run.load.inserted.count() == 3
    fresh = P.run_pipeline(spark, path, P.Layout(staging_path(spark, "wh")), min_rows=1)
    rows = lambda r: sorted(map(tuple, r.summary.collect()))
    assert rows(run) == rows(fresh)
    # nothing has changed: no stage runs; a new extract: all of them
    built.clear()
    P.run_pipeline(spark, path, layout, min_rows=1, resume=True)
    assert built == []
    write(tmp_path / "drop.csv", [raw_row(arrival_date_day_of_month="9", company="longer")])
    P.run_pipeline(spark, path, layout, min_rows=1, resume=True)
    assert built == ["load", "build_silver", "quality_report"]
    assert read_layer(spark, layout.silver).count() == 4
