"""Edge rows for the cleaning rules (missing markers, strict/lenient casts, dates)."""

from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import bronze_df, raw_row

from innkeep.operators.silver import build_silver


def one(spark, strict=True, **values):
    rows = build_silver(bronze_df(spark, [raw_row(**values)]), strict=strict).collect()
    assert len(rows) == 1
    return rows[0]


def test_valid_row_types_and_derivations(spark):
    r = one(spark)
    assert r.hotel_type == "Hotel" and r.lead_time == 10
    assert r.adr == Decimal("100.00")
    assert r.total_nights == 3 and r.revenue == Decimal("300.00")
    assert str(r.arrival_date) == "2016-07-01" and r.year_month == "2016-07"
    assert r.was_room_changed is False and r.company is None
    assert len(build_silver(bronze_df(spark, [raw_row()])).columns) == 40


def test_sentinels_exact_and_case_sensitive(spark):
    r = one(spark, country="NA", agent="NULL")
    assert r.country is None and r.agent is None
    assert one(spark, country="na").country == "na"
    assert one(spark, country=" NA").country == " NA"


def test_blank_country_stays_empty_text(spark):
    assert one(spark, country="").country == ""


def test_blank_number_fails_strict(spark):
    with pytest.raises(Exception):
        one(spark, adults="")


def test_decimal_text_as_int_strict_fails_lenient_null(spark):
    with pytest.raises(Exception):
        one(spark, babies="1.0")
    assert one(spark, strict=False, babies="1.0").babies is None


def test_impossible_date_strict_fails_lenient_null(spark):
    with pytest.raises(Exception):
        one(spark, arrival_date_month="February", arrival_date_day_of_month="30")
    r = one(spark, strict=False, arrival_date_month="February", arrival_date_day_of_month="30")
    assert r.arrival_date is None and r.year_month == "2016-02"


def test_unknown_month_gives_null_date_and_month(spark):
    r = one(spark, arrival_date_month="Julio")
    assert r.arrival_date is None and r.year_month is None


def test_year_na(spark):
    r = one(spark, arrival_date_year="NA")
    assert r.arrival_date is None and r.year_month is None and r.arrival_date_year is None


def test_year_null_text_with_day_na(spark):
    r = one(spark, arrival_date_year="NULL", arrival_date_day_of_month="NA")
    assert r.year_month == "NULL-07" and r.arrival_date is None


def test_day_padding(spark):
    assert str(one(spark, arrival_date_day_of_month="9").arrival_date) == "2016-07-09"


def test_padded_canceled_flag_types_but_earns_nothing(spark):
    r = one(spark, is_canceled=" 0")
    assert r.is_canceled == 0 and r.revenue == Decimal("0.00")


def test_missing_rate_on_completed_stay(spark):
    r = one(spark, adr="NA")
    assert r.adr is None and r.revenue == Decimal("0.00") and r.total_nights == 3


def test_missing_nights_count_as_zero_only_in_derivations(spark):
    r = one(spark, stays_in_weekend_nights="NA")
    assert r.stays_in_weekend_nights is None and r.total_nights == 2 and r.revenue == Decimal("200.00")


def test_cancelled_earns_nothing(spark):
    assert one(spark, is_canceled="1").revenue == Decimal("0.00")


def test_room_change_flag(spark):
    assert one(spark, assigned_room_type="B").was_room_changed is True
    assert one(spark, assigned_room_type=None).was_room_changed is False


def test_rate_rounds_half_away_from_zero(spark):
    assert one(spark, adr="1.005").adr == Decimal("1.01")
    assert one(spark, adr="-1.005").adr == Decimal("-1.01")


def test_negative_and_zero_rates_kept(spark):
    assert one(spark, adr="-6.38").adr == Decimal("-6.38")
    assert one(spark, adr="0").revenue == Decimal("0.00")


def test_duplicate_fingerprints_keep_earliest_load(spark):
    from pyspark.sql import functions as F

    from innkeep.operators.bronze import with_lineage
    from conftest import raw_df

    raw = raw_df(spark, [raw_row()])
    early = with_lineage(raw, "a.csv", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    late = with_lineage(raw, "b.csv", F.lit("2024-02-01 00:00:00").cast("timestamp"))
    rows = build_silver(late.unionByName(early).unionByName(late)).collect()
    assert len(rows) == 1 and rows[0]._source_file == "a.csv"


def test_strict_parse_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="invalid int"):
            one(spark, adults="two")
        assert one(spark, strict=False, adults="two").adults is None
        assert one(spark).adults == 2
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
