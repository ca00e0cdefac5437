"""Steps that must not grow faster than their input (findings of round 3)."""

from __future__ import annotations

import os

import pytest
from conftest import SF_SMALL, bronze_df, raw_row
from innkeep.operators import quality as Q
from innkeep.plans import catalog, datasets as D
from innkeep.schema import RAW_COLUMNS
from innkeep.sources import csv_source as S


def test_raw_checks_do_not_build_the_cleaned_layer(spark, monkeypatch):
    def unused(*_):
        raise AssertionError("the cleaned layer is not read")

    monkeypatch.setattr(D, "silver_table", unused)
    checks = catalog.quality_checks(spark, SF_SMALL)
    assert checks["dq_hash_format"]().count() == 0
    assert checks["dq_value_set"]().count() >= 0


def test_hash_format_tells_format_from_mismatch(spark):
    rows = bronze_df(spark, [raw_row(agent=str(i)) for i in range(4)])
    good = sorted(r[0] for r in rows.select("_row_hash").collect())
    wrong = {good[0]: "ab" * 32, good[1]: good[1].upper(), good[2]: None}
    from pyspark.sql import functions as F

    changed = F.col("_row_hash")
    for old, new in wrong.items():
        changed = F.when(F.col("_row_hash") == old, F.lit(new).cast("string")).otherwise(changed)
    found = Q.hash_format(rows.withColumn("_row_hash", changed)).collect()
    assert {(r["_row_hash"], r["problem"]) for r in found} == {("ab" * 32, "mismatch"), (good[1].upper(), "format"), (None, "format")}


@pytest.fixture
def two_layouts(spark, tmp_path):
    values = {c: f"v{i}" for i, c in enumerate(RAW_COLUMNS)}
    orders = [RAW_COLUMNS, [*RAW_COLUMNS[5:], "more", *RAW_COLUMNS[:5]], RAW_COLUMNS[::-1]]
    for k, cols in enumerate(orders):
        (tmp_path / f"f{k}.csv").write_text(",".join(cols) + "\n" + ",".join(values.get(c, "x") for c in cols) + "\n")
    return str(tmp_path), values


@pytest.mark.parametrize("chosen", [16, 1])
def test_values_follow_the_layout_of_their_file(spark, two_layouts, monkeypatch, chosen):
    path, values = two_layouts
    monkeypatch.setattr(S, "CHOSEN_LAYOUTS", chosen)
    found = S.scan_expected(spark, path).collect()
    assert len(found) == 3
    assert all({c: r[c] for c in RAW_COLUMNS} == values and not r["_malformed"] for r in found)


def test_staged_records_are_not_sorted_into_folders(spark, two_layouts):
    batch = S.CsvBatch(spark, two_layouts[0], expected=RAW_COLUMNS)
    try:
        # folders by a column would sort all rows of a task before they are written
        assert not [n for n in os.listdir(batch.staged[0].removeprefix("file:")) if n.startswith("maybe_head=")]
        assert batch.rows.where("maybe_head").count() == 3
    finally:
        batch.remove()


def test_kinds_of_values(spark):
    texts = {
        None: 0, "": 0, "  ": 0, "7": S._INT, " +7\t": S._INT, "-2147483649": S._LONG, "9" * 20: S._DECIMAL, "9" * 60: S._DOUBLE,
        "1.5": S._DOUBLE, ".5e3": S._DOUBLE, "5.": S._DOUBLE, "e5": S._TEXT, "2020-02-29": S._DATE, "2021-02-29": S._TEXT,
        "2020-02-29 10:00:00": S._TIME, "True": S._BOOL, "true ": S._TEXT, "A1": S._TEXT, ".": S._TEXT, "٥": S._TEXT,
    }
    names = [f"c{i}" for i in range(len(texts))]
    frame = spark.createDataFrame([tuple(texts)], ", ".join(f"{n} string" for n in names))
    assert S._kinds(frame, names).first()["kinds"] == list(texts.values())


def test_staged_bytes_grow_with_the_rows(spark, tmp_path):
    # repeated values: with dictionaries 20,000 such rows take a few bytes each, so that one split holds millions
    (tmp_path / "same.csv").write_text(",".join(RAW_COLUMNS) + "\n" + (",".join(f"{c}-value" for c in RAW_COLUMNS) + "\n") * 20_000)
    batch = S.CsvBatch(spark, str(tmp_path), expected=RAW_COLUMNS)
    try:
        folder = batch.staged[0].removeprefix("file:")
        size = sum(os.path.getsize(os.path.join(folder, n)) for n in os.listdir(folder) if n.endswith(".parquet"))
        assert size > 20_000 * 16
    finally:
        batch.remove()


@pytest.mark.parametrize("staged", [D.landing, D.faulty])
def test_a_split_of_a_staged_extract_holds_few_rows(spark, monkeypatch, staged):
    # cut by bytes alone, a file holds as many rows as its dictionaries allow, and the keep-first limit sorts them all
    monkeypatch.setattr(D, "_STAGED", {})
    monkeypatch.setattr(D, "FILE_ROWS", 100)
    rows = staged(spark, SF_SMALL)
    by_file = [r["count"] for r in rows.groupBy("_metadata.file_path").count().collect()]
    assert len(by_file) > 8 and max(by_file) <= 100
    assert sum(by_file) == D.landing_from_tables(spark, SF_SMALL).count()
