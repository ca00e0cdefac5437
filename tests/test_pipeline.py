"""CSV-to-gold runs: layer tables, summary counts, and the quality gate."""

from __future__ import annotations

import pytest
from conftest import raw_row
from test_csv_bronze import write

from innkeep.operators.quality import QualityGateError
from innkeep.plans.pipeline import Layout, run_pipeline
from innkeep.session import staging_path
from innkeep.sources.tables import read_layer


def test_pipeline_builds_layers_and_summary(spark, tmp_path):
    rows = [raw_row(arrival_date_day_of_month=str(d), country=c) for d, c in [(1, "PRT"), (2, "ESP"), (3, "PRT")]]
    path = write(tmp_path / "drop.csv", rows + rows[:1])
    layout = Layout(staging_path(spark, "wh"))
    run = run_pipeline(spark, path, layout, min_rows=1)
    summary = {(r.layer, r.table_name): r.rows for r in run.summary.collect()}
    assert summary == {
        ("raw", "extract"): 4,
        ("bronze", "raw_bookings"): 3,
        ("silver", "stg_bookings"): 3,
        ("gold", "popular_countries"): 2,
        ("gold", "mom_growth"): 1,
        ("check", "silver_unique_row_hash"): 0,
        ("check", "silver_not_null"): 0,
        ("check", "silver_accepted_values"): 0,
        ("check", "silver_volume"): 0,
        ("check", "countries_unique"): 0,
        ("check", "countries_not_null"): 0,
        ("check", "mom_not_null"): 0,
    }
    assert all(r.passed for r in run.quality.collect())
    top = read_layer(spark, layout.countries).orderBy("popularity_rank").first()
    assert top.country == "PRT" and top.popularity_rank == 1


def test_pipeline_gate_stops_on_violations(spark, tmp_path):
    path = write(tmp_path / "drop.csv", [raw_row(hotel="Resort")])
    with pytest.raises(QualityGateError, match="silver_accepted_values=1"):
        run_pipeline(spark, path, Layout(staging_path(spark, "wh")), min_rows=1)
    run = run_pipeline(spark, path, Layout(staging_path(spark, "wh")), min_rows=1, gate_quality=False)
    found = {r.table_name: r.rows for r in run.summary.where("layer = 'check'").collect()}
    assert found["silver_accepted_values"] == 1 and found["silver_volume"] == 0


def test_fused_checks_count_like_the_single_ones(spark):
    from conftest import bronze_df

    from innkeep.operators import quality as Q
    from innkeep.operators.silver import build_silver

    rows = [raw_row(hotel=h, adr=a, is_canceled=c, arrival_date_day_of_month=str(i + 1)) for i, (h, a, c) in enumerate([("Resort", "1.00", "0"), ("Hotel", "NA", "2"), ("Resort", "NA", "3"), ("Hotel", "1.00", "1")])]
    silver = build_silver(bronze_df(spark, rows))
    fused = {r.check_name: r.violations for r in Q.row_check_counts(silver, "s", Q.SILVER_NOT_NULL, Q.ACCEPTED_VALUES, 5).collect()}
    assert fused == {
        "s_not_null": Q.not_null(silver, Q.SILVER_NOT_NULL, "s", "_row_hash").count(),
        "s_accepted_values": Q.accepted_values(silver, Q.ACCEPTED_VALUES, "s").count(),
        "s_volume": Q.volume(silver, 5).count(),
    } == {"s_not_null": 2, "s_accepted_values": 3, "s_volume": 1}
