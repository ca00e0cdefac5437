"""Analytical tables built from the cleaned layer.

Each table is one shuffle on its group keys (partial + final hash aggregation,
so a hot key is pre-aggregated in every map task) followed by small
operations on the aggregated rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innkeep.functions.rounding import HUNDRED, exact_mean, pct
from innkeep.operators.ranking import grand_total, rank_desc
from innkeep.session import checkpoint_dir


def n_rows() -> Column:
    return F.count(F.lit(1))


def count_when(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` (0, not NULL, on no match)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def completed(silver: DataFrame) -> DataFrame:
    """Stays that were not cancelled (``is_canceled = 0``; NULL is neither)."""
    return silver.where(F.col("is_canceled") == 0)


def country_stats(silver: DataFrame) -> DataFrame:
    """Per country, completed stays only: volume, revenue, mean rate/stay, repeat %."""
    return (
        completed(silver)
        .where(F.col("country").isNotNull())
        .groupBy("country")
        .agg(
            n_rows().alias("total_bookings"),
            F.sum("revenue").alias("total_revenue"),
            exact_mean(F.col("adr"), 2).alias("avg_daily_rate"),
            exact_mean(F.col("total_nights"), 1).alias("avg_stay_nights"),
            pct(count_when(F.col("is_repeated_guest") == 1), n_rows(), 1).alias("repeat_guest_pct"),
        )
    )


def popular_countries(silver: DataFrame) -> DataFrame:
    """Country ranking by completed bookings with each country's share of all.

    Columns: country, total_bookings, total_revenue, avg_daily_rate,
    avg_stay_nights, repeat_guest_pct, popularity_rank, booking_share_pct.
    """
    # One row per country, used by three branches (output, rank histogram,
    # grand total): checkpoint it to the shared checkpoint folder so silver is
    # scanned and shuffled once and the branches read the small result.
    checkpoint_dir(silver.sparkSession)
    stats = country_stats(silver).checkpoint(eager=True)
    total = grand_total(stats, "total_bookings")
    ranked = rank_desc(stats, "total_bookings", "popularity_rank")
    return ranked.select(
        "country",
        "total_bookings",
        "total_revenue",
        "avg_daily_rate",
        "avg_stay_nights",
        "repeat_guest_pct",
        F.col("popularity_rank").cast("bigint").alias("popularity_rank"),
        pct(F.col("total_bookings"), total, 1).alias("booking_share_pct"),
    )


def monthly_revenue(silver: DataFrame) -> DataFrame:
    """Per hotel type and ``year_month``: volume, revenue, mean rate, completed/cancelled."""
    return (
        silver.where(F.col("year_month").isNotNull())
        .groupBy("hotel_type", "year_month")
        .agg(
            n_rows().alias("total_bookings"),
            F.sum("revenue").alias("total_booking_amount"),
            exact_mean(F.col("adr"), 2).alias("avg_daily_rate"),
            count_when(F.col("is_canceled") == 0).alias("completed_bookings"),
            count_when(F.col("is_canceled") == 1).alias("canceled_bookings"),
        )
    )


def pct_change(cur: Column, prev: Column, digits: int = 1) -> Column:
    """``ROUND(100.0 * (cur - prev) / prev, digits)`` when prev > 0, else NULL."""
    num = (cur - prev).cast("decimal(20,2)")
    den = prev.cast("decimal(20,2)")
    return F.when(prev.isNotNull() & (prev > 0), F.round(F.lit(HUNDRED) * (num / den), digits))


def mom_growth(silver: DataFrame) -> DataFrame:
    """Month-over-month revenue change per hotel type.

    The previous row is the previous *existing* month of the same type (no
    calendar densification). The window runs over the aggregated monthly
    rows: one partition per hotel type holding one row per month.
    """
    monthly = monthly_revenue(silver)
    w = Window.partitionBy("hotel_type").orderBy("year_month")
    with_prev = monthly.withColumn("prev_month_amount", F.lag("total_booking_amount").over(w))
    return with_prev.withColumn(
        "mom_pct_change", pct_change(F.col("total_booking_amount"), F.col("prev_month_amount"))
    )


TOP_RANGE = (5, 50)


def top_countries(ranked: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` best-ranked countries (ties by name), ``n`` in 5..50 like the dashboard slider."""
    lo, hi = TOP_RANGE
    if not lo <= n <= hi:
        raise ValueError(f"n must be between {lo} and {hi}")
    return ranked.orderBy(F.col("popularity_rank").asc_nulls_last(), F.col("country")).limit(n)


def presentation_order_countries(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("popularity_rank").asc_nulls_last(), F.col("country"))


def presentation_order_mom(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("hotel_type").asc_nulls_last(), F.col("year_month").asc_nulls_last())
