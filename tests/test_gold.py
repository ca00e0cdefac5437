"""Analytical tables on hand-written rows: ranks, shares, MoM gaps, exact rounding."""

from __future__ import annotations

from decimal import Decimal

from conftest import bronze_df, raw_row

from innkeep.operators import gold
from innkeep.operators.silver import build_silver


def silver_of(spark, rows):
    return build_silver(bronze_df(spark, rows))


def test_ranks_share_and_means(spark):
    rows = (
        [raw_row(country="PRT", arrival_date_day_of_month=str(d)) for d in range(1, 4)]
        + [raw_row(country="ESP", arrival_date_day_of_month=str(d)) for d in range(1, 4)]
        + [raw_row(country="FRA", adr="1.00", is_repeated_guest="1")]
        + [raw_row(country="GBR", adr="1.01")]
        + [raw_row(country="NULL")]
        + [raw_row(country="DEU", is_canceled="1")]
    )
    out = {r.country: r for r in gold.popular_countries(silver_of(spark, rows)).collect()}
    assert set(out) == {"PRT", "ESP", "FRA", "GBR"}
    assert out["PRT"].popularity_rank == out["ESP"].popularity_rank == 1
    assert out["FRA"].popularity_rank == out["GBR"].popularity_rank == 3
    assert out["PRT"].booking_share_pct == Decimal("37.5")
    assert out["FRA"].booking_share_pct == Decimal("12.5")
    assert out["FRA"].repeat_guest_pct == Decimal("100.0")
    assert out["PRT"].total_revenue == Decimal("900.00")
    assert out["PRT"].avg_stay_nights == Decimal("3.0")


def test_mean_exactly_on_a_half_rounds_away_from_zero(spark):
    rows = [raw_row(country="X", adr="1.00"), raw_row(country="X", adr="1.01", arrival_date_day_of_month="2")]
    (r,) = gold.country_stats(silver_of(spark, rows)).collect()
    assert r.avg_daily_rate == Decimal("1.01")


def test_mom_uses_previous_existing_month_and_guards_zero(spark):
    rows = [
        raw_row(arrival_date_month="January"),
        raw_row(arrival_date_month="March", adr="200.00"),
        raw_row(arrival_date_month="April", is_canceled="1"),
        raw_row(arrival_date_month="May"),
    ]
    out = {r.year_month: r for r in gold.mom_growth(silver_of(spark, rows)).collect()}
    assert out["2016-01"].prev_month_amount is None and out["2016-01"].mom_pct_change is None
    assert out["2016-03"].prev_month_amount == Decimal("300.00")
    assert out["2016-03"].mom_pct_change == Decimal("100.0")
    assert out["2016-04"].total_booking_amount == Decimal("0.00")
    assert out["2016-04"].mom_pct_change == Decimal("-100.0")
    assert out["2016-05"].prev_month_amount == Decimal("0.00") and out["2016-05"].mom_pct_change is None
    assert out["2016-04"].canceled_bookings == 1 and out["2016-04"].completed_bookings == 0


def test_mom_excludes_rows_without_year_month(spark):
    rows = [raw_row(), raw_row(arrival_date_year="NA")]
    out = gold.mom_growth(silver_of(spark, rows)).collect()
    assert len(out) == 1 and out[0].total_bookings == 1
