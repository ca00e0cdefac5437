"""Rollup semantics on hand-written rows, and the drop-folder stream."""

from __future__ import annotations

import csv
import os

from conftest import bronze_df, raw_row

from innkeep.operators import rollups as R
from innkeep.operators.bronze import read_bronze
from innkeep.operators.silver import build_silver
from innkeep.schema import RAW_COLUMNS
from innkeep.session import staging_path
from innkeep.streaming.ingest import ingest_available


def test_value_counts_order_and_top_k(spark):
    rows = [raw_row(board=b, arrival_date_day_of_month=str(i)) for i, b in enumerate(["BB", "HB", "BB", "FB", "HB", "SC"], 1)]
    silver = build_silver(bronze_df(spark, rows))
    got = [(r.board, r.n) for r in R.value_counts(silver, "board", top=3).collect()]
    assert got == [("BB", 2), ("HB", 2), ("FB", 1)]


def test_filter_status_and_null_years(spark):
    rows = [raw_row(), raw_row(is_canceled="1", arrival_date_day_of_month="2"), raw_row(arrival_date_year="NA", arrival_date_day_of_month="3")]
    silver = build_silver(bronze_df(spark, rows))
    assert R.BookingFilter().apply(silver).count() == 2
    assert R.BookingFilter(status="Canceled").apply(silver).count() == 1
    assert R.BookingFilter(years=[2015]).apply(silver).count() == 0


def test_histogram_last_bin_closed(spark):
    rows = [raw_row(booking_to_arrival_time=str(v), arrival_date_day_of_month=str(i + 1)) for i, v in enumerate([0, 5, 10])]
    silver = build_silver(bronze_df(spark, rows))
    got = {r.bin: r.n for r in R.histogram(silver, "lead_time", 2).collect()}
    assert got == {0: 1, 1: 2}


def test_null_profile_and_crosstab(spark):
    rows = [raw_row(children="NA"), raw_row(children="", is_canceled="1", arrival_date_day_of_month="2")]
    raw_t = R.raw_typed(bronze_df(spark, rows))
    prof = {r.column_name: r.null_count for r in R.null_profile(raw_t).collect()}
    assert prof == {"children": 2, "company": 2}
    ct = {(r.hotel, r.is_canceled): r.share for r in R.cancel_crosstab(raw_t).collect()}
    assert ct == {("Hotel", 0): 0.5, ("Hotel", 1): 0.5}


def test_crosstab_has_every_flag(spark):
    rows = [raw_row(is_canceled=f, arrival_date_day_of_month=str(i + 1)) for i, f in enumerate("0122")]
    ct = {r.is_canceled: r.share for r in R.cancel_crosstab(R.raw_typed(bronze_df(spark, rows))).collect()}
    assert ct == {0: 0.25, 1: 0.25, 2: 0.5}


def test_value_counts_returns_all_values(spark):
    rows = [raw_row(country=f"C{i:02d}", arrival_date_day_of_month=str(1 + i % 28), adr=f"{i}.00") for i in range(30)]
    assert R.value_counts(bronze_df(spark, rows), "country").count() == 30


def test_outliers_test_the_rate_as_written(spark):
    rows = [raw_row(adr=a, arrival_date_day_of_month=str(i + 1)) for i, a in enumerate(["-0.004", "0", "0.00", "NA", "", "-5"])]
    r = R.outlier_counts(bronze_df(spark, rows)).first()
    assert (r.negative_rate_rows, r.zero_rate_rows, r.zero_night_rows) == (2, 2, 0)


def test_orders_of_presentation(spark):
    from innkeep.operators import gold

    rows = [raw_row(arrival_date_month=m, country=c, arrival_date_day_of_month=str(i + 1)) for i, (m, c) in enumerate([("July", "PRT"), ("March", "ESP"), ("December", "PRT"), ("March", "FRA")])]
    silver = build_silver(bronze_df(spark, rows))
    ranked = gold.presentation_order_countries(gold.popular_countries(silver)).collect()
    assert [r.country for r in ranked][0] == "PRT" and [r.popularity_rank for r in ranked] == [1, 2, 2]
    months = [r.year_month for r in gold.presentation_order_mom(gold.mom_growth(silver)).collect()]
    assert months == sorted(months)
    assert [r.arrival_date_month for r in R.seasonality_ordered(silver).collect()] == ["March", "July", "December"]


def test_catalog_sink_is_bucketed(spark):
    from innkeep.session import cluster_conf
    from innkeep.sources.tables import ensure_layers, save_layer_table

    ensure_layers(spark)
    assert {"bronze", "silver", "gold"} <= {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    name = save_layer_table(bronze_df(spark, [raw_row(), raw_row(adr="2.00")]), "bronze", "t_bucketed", bucket_by=(4, "_row_hash"))
    try:
        table = spark.table(name)
        assert table.count() == 2
        assert "Exchange hashpartitioning" not in table.groupBy("_row_hash").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql(f"DROP TABLE {name}")
    assert int(cluster_conf(1000, 1 << 40)["spark.sql.shuffle.partitions"]) >= 3000


def test_numeric_summary_quartiles(spark):
    rates = ["10.00", "20.00", "30.00", "40.00"]
    rows = [raw_row(adr=a, arrival_date_day_of_month=str(i + 1)) for i, a in enumerate(rates)]
    silver = build_silver(bronze_df(spark, rows))
    out = {r.column_name: r for r in R.numeric_summary(silver).collect()}
    adr = out["adr"]
    assert (adr["count"], adr.mean, adr.min, adr.max) == (4, 25.0, 10.0, 40.0)
    assert (adr.p25, adr.p50, adr.p75) == (17.5, 25.0, 32.5)
    assert adr.std == 12.91


def _drop(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(RAW_COLUMNS)
        for r in rows:
            w.writerow([r[c] for c in RAW_COLUMNS])


def test_stream_ingests_each_file_once_and_skips_known_rows(spark, tmp_path):
    drop = tmp_path / "drop"
    os.makedirs(drop)
    bronze, ckpt = staging_path(spark, "t-bronze"), staging_path(spark, "t-ckpt")
    _drop(drop / "day1.csv", [raw_row(), raw_row(arrival_date_day_of_month="2"), raw_row()])
    ingest_available(spark, str(drop), bronze, ckpt)
    assert read_bronze(spark, bronze).count() == 2
    _drop(drop / "day2.csv", [raw_row(arrival_date_day_of_month="2"), raw_row(arrival_date_day_of_month="3")])
    ingest_available(spark, str(drop), bronze, ckpt)
    ingest_available(spark, str(drop), bronze, ckpt)
    stored = read_bronze(spark, bronze)
    assert stored.count() == 3 and stored.select("_row_hash").distinct().count() == 3


def test_stream_reads_any_header_order_and_ignores_extras(spark, tmp_path):
    from test_csv_bronze import write

    drop = tmp_path / "drop-order"
    os.makedirs(drop)
    bronze, ckpt = staging_path(spark, "t-bronze-o"), staging_path(spark, "t-ckpt-o")
    write(drop / "a.csv", [raw_row()])
    write(drop / "b.csv", [raw_row(hotel="Apartment")], columns=list(reversed(RAW_COLUMNS)), extra=["note"])
    ingest_available(spark, str(drop), bronze, ckpt)
    assert sorted(r.hotel for r in read_bronze(spark, bronze).collect()) == ["Apartment", "Hotel"]


def test_stream_keeps_quoted_newlines(spark, tmp_path):
    drop = tmp_path / "drop-ml"
    os.makedirs(drop)
    bronze, ckpt = staging_path(spark, "t-bronze-ml"), staging_path(spark, "t-ckpt-ml")
    _drop(drop / "day1.csv", [raw_row(company="Line one\nline two"), raw_row(arrival_date_day_of_month="5")])
    ingest_available(spark, str(drop), bronze, ckpt)
    stored = read_bronze(spark, bronze)
    assert stored.count() == 2
    assert stored.where(stored.company == "Line one\nline two").count() == 1
