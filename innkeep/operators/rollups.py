"""Headline indicators, distributions, cross-tabs and value counts.

Input frames (as in the original dashboard/notebook):

* ``silver`` — the cleaned layer (deduplicated);
* ``filtered`` — silver after a :class:`BookingFilter`;
* ``raw_typed`` — raw rows, *not* deduplicated, with ``NA``/``NULL``/blank
  read as missing and numbers parsed leniently (:func:`raw_typed`).

Every rollup is one aggregation (partial + final, so hot keys are combined in
each map task) over a pruned projection; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innkeep.functions.rounding import pct, plain_mean
from innkeep.operators.gold import completed, count_when, n_rows
from innkeep.schema import INT_COLUMNS, RAW_COLUMNS
from innkeep.sources.dimensions import month_map

STATUSES = ("All", "Completed", "Canceled")


@dataclass(frozen=True)
class BookingFilter:
    """Dashboard filter: hotel types, arrival years, status.

    ``None`` selects every known (non-NULL) value, like a multiselect that
    starts with all options chosen.
    """

    types: Sequence[str] | None = None
    years: Sequence[int] | None = None
    status: str = "All"

    def apply(self, silver: DataFrame) -> DataFrame:
        if self.status not in STATUSES:
            raise ValueError(f"status must be one of {STATUSES}")
        t, y = F.col("hotel_type"), F.col("arrival_date_year")
        cond = (t.isin(list(self.types)) if self.types is not None else t.isNotNull()) & (
            y.isin(list(self.years)) if self.years is not None else y.isNotNull()
        )
        if self.status == "Completed":
            cond = cond & (F.col("is_canceled") == 0)
        elif self.status == "Canceled":
            cond = cond & (F.col("is_canceled") == 1)
        return silver.where(cond)


# --- Raw rows as a notebook reads them ----------------------------------------------

RAW_MISSING = ("NA", "NULL", "")


def raw_missing(c: str) -> Column:
    out = F.col(c)
    for s in RAW_MISSING:
        out = F.nullif(out, F.lit(s))
    return out


def raw_typed(raw: DataFrame) -> DataFrame:
    """Raw rows with missing text -> NULL and lenient numbers (int / rate).

    Keeps the raw column names; duplicates are kept.
    """
    cols = []
    for c in RAW_COLUMNS:
        v = raw_missing(c)
        if c in INT_COLUMNS:
            v = v.try_cast("int")
        elif c == "adr":
            v = v.try_cast("decimal(10,2)")
        cols.append(v.alias(c))
    return raw.select(*cols)


# --- Headline indicators -------------------------------------------------------------


def kpi_summary(raw: DataFrame, silver: DataFrame) -> DataFrame:
    """One row: raw/unique/duplicate rows, completed revenue, cancel %, mean rate,
    mean stay (completed), repeat %, countries with completed stays.

    Rates are unrounded doubles from exact integer sums.
    """
    raw_rows = raw.select(n_rows()).scalar()
    done = F.col("is_canceled") == 0
    agg = silver.agg(
        n_rows().alias("unique_rows"),
        F.sum(F.when(done, F.col("revenue"))).alias("total_revenue"),
        count_when(F.col("is_canceled") == 1).alias("_canceled"),
        plain_mean(F.col("adr"), 2).alias("avg_daily_rate"),
        plain_mean(F.when(done, F.col("total_nights"))).alias("avg_stay_nights"),
        count_when(F.col("is_repeated_guest") == 1).alias("_repeat"),
        F.count_distinct(F.when(done, F.col("country"))).alias("countries"),
    )
    return agg.select(
        raw_rows.alias("raw_rows"),
        "unique_rows",
        (raw_rows - F.col("unique_rows")).alias("duplicate_rows"),
        F.coalesce(F.col("total_revenue"), F.lit(0)).cast("decimal(28,2)").alias("total_revenue"),
        share_pct(F.col("_canceled"), F.col("unique_rows")).alias("cancel_rate_pct"),
        "avg_daily_rate",
        "avg_stay_nights",
        share_pct(F.col("_repeat"), F.col("unique_rows")).alias("repeat_guest_pct"),
        "countries",
    )


def share_pct(num: Column, den: Column) -> Column:
    """Unrounded ``100 * num / den`` as a double (exact product, one division)."""
    return F.when(den != 0, (num * 100).cast("double") / den.cast("double"))


def share(num: Column, den: Column) -> Column:
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def duplicate_count(bronze: DataFrame) -> DataFrame:
    """Rows, distinct fingerprints and duplicates of a raw extract."""
    return bronze.agg(
        n_rows().alias("raw_rows"), F.count_distinct("_row_hash").alias("unique_rows")
    ).select("raw_rows", "unique_rows", (F.col("raw_rows") - F.col("unique_rows")).alias("duplicate_rows"))


# --- Time series ----------------------------------------------------------------------


def monthly_bookings(filtered: DataFrame) -> DataFrame:
    return filtered.groupBy("year_month").agg(n_rows().alias("bookings"))


def monthly_completed_revenue(silver: DataFrame) -> DataFrame:
    return completed(silver).groupBy("year_month").agg(F.sum("revenue").alias("revenue"))


def seasonality(filtered: DataFrame) -> DataFrame:
    """Bookings per (hotel type, month name) with the month's calendar number."""
    counts = filtered.groupBy("hotel_type", "arrival_date_month").agg(n_rows().alias("bookings"))
    months = month_map(filtered.sparkSession).select(
        "month_name", F.col("month_number").cast("int").alias("month_number")
    )
    return counts.join(F.broadcast(months), F.col("arrival_date_month") == F.col("month_name"), "left").select(
        "hotel_type", "arrival_date_month", "month_number", "bookings"
    )


def seasonality_ordered(filtered: DataFrame) -> DataFrame:
    return seasonality(filtered).orderBy(F.col("month_number").asc_nulls_last(), "hotel_type")


# --- Per hotel type --------------------------------------------------------------------


def cancel_rate_by_type(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("hotel_type")
        .agg(F.sum("is_canceled").alias("canceled"), F.count("is_canceled").alias("bookings"))
        .withColumn("cancel_rate_pct", pct(F.col("canceled"), F.col("bookings"), 1))
    )


def type_comparison(silver: DataFrame) -> DataFrame:
    """Volume, cancels, mean rate/stay/lead time, revenue, room changes, repeats and
    three rounded rates per hotel type."""
    agg = silver.groupBy("hotel_type").agg(
        n_rows().alias("bookings"),
        F.sum("is_canceled").alias("canceled"),
        plain_mean(F.col("adr"), 2).alias("avg_daily_rate"),
        plain_mean(F.col("total_nights")).alias("avg_stay_nights"),
        F.sum("revenue").alias("revenue"),
        plain_mean(F.col("lead_time")).alias("avg_lead_time"),
        count_when(F.col("was_room_changed")).alias("room_changes"),
        F.sum("is_repeated_guest").alias("repeat_guests"),
    )
    n = F.col("bookings")
    return agg.select(
        "*",
        pct(F.col("canceled"), n, 1).alias("cancel_rate_pct"),
        pct(F.col("room_changes"), n, 1).alias("room_change_pct"),
        pct(F.col("repeat_guests"), n, 1).alias("repeat_pct"),
    )


# Display labels of the three rates.
RATE_LABELS = {
    "cancel_rate_pct": "Cancel %",
    "room_change_pct": "Room Change %",
    "repeat_pct": "Repeat %",
}


def type_rates_long(silver: DataFrame) -> DataFrame:
    """Wide -> long: one row per (hotel type, rate) with a display label."""
    wide = type_comparison(silver).select("hotel_type", *RATE_LABELS)
    long = wide.unpivot(["hotel_type"], list(RATE_LABELS), "metric", "pct")
    labels = F.create_map(*[F.lit(x) for kv in RATE_LABELS.items() for x in kv])
    return long.select("hotel_type", labels[F.col("metric")].alias("metric"), "pct")


# --- Value counts, distinct values, profiles ----------------------------------------


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Every non-NULL value of ``column`` with its count, most frequent first.

    ``top`` keeps that many (ties ordered by value) as a distributed
    ``TakeOrderedAndProject`` over the counts; by default all are returned.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(n_rows().alias("n"))
    ordered = counts.orderBy(F.col("n").desc(), F.col(column).asc())
    return ordered if top is None else ordered.limit(top)


def distinct_count(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct()


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count per column in one pass, only columns with NULLs."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column_name", "null_count")
    return long.where(F.col("null_count") > 0)


def cancellation_rate(raw_t: DataFrame) -> DataFrame:
    return raw_t.agg(
        F.sum("is_canceled").cast("bigint").alias("canceled"),
        share(F.sum("is_canceled"), F.count("is_canceled")).alias("cancel_rate"),
    )


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str, scale: int = 0) -> DataFrame:
    return df.groupBy(*keys).agg(plain_mean(F.col(value), scale).alias(name))


def cancel_crosstab(raw_t: DataFrame) -> DataFrame:
    """Share of every cancel flag that occurs per hotel, normalised per hotel: one row a hotel and flag."""
    known = raw_t.where(F.col("is_canceled").isNotNull() & F.col("hotel").isNotNull())
    counts = known.groupBy("hotel", "is_canceled").agg(n_rows().alias("n"))
    total = F.sum("n").over(Window.partitionBy("hotel"))
    return counts.select("hotel", "is_canceled", share(F.col("n"), total).alias("share"))


def outlier_counts(raw: DataFrame) -> DataFrame:
    """Negative rates, zero rates and zero-night stays (a missing stay is not 0) of raw rows.

    Rates are tested as written: -0.004 is negative, though it rounds to 0.00.
    """
    rate = raw_missing("adr").try_cast("double")
    nights = raw_missing("stays_in_weekend_nights").try_cast("int") + raw_missing("stays_in_week_nights").try_cast("int")
    return raw.agg(
        F.count_if(rate < 0).alias("negative_rate_rows"),
        F.count_if(rate == 0).alias("zero_rate_rows"),
        F.count_if(nights == 0).alias("zero_night_rows"),
    )


# --- Distributions ----------------------------------------------------------------------

# The columns that the dashboard summarises.
SUMMARY_COLUMNS = ("adr", "total_nights", "revenue", "lead_time")
QUARTILES = (0.25, 0.5, 0.75)


def _cents(c: str) -> Column:
    return (F.col(c) * 100).cast("bigint")


def _round_cents(x: Column) -> Column:
    """Half away from zero to an integer (x is a double holding k/4 exactly)."""
    return F.signum(x) * F.floor(F.abs(x) + 0.5)


BUCKETS_PER_OCTAVE = 16


def value_bucket(v: Column) -> Column:
    """Order-preserving bucket of an integer value: ``sign(v)·floor(16·log2(|v|+1))``.

    Monotonic in ``v`` (so bucket order is value order), pure arithmetic
    (codegen), at most 2·16·64 buckets for 64-bit values, and a bucket never
    holds more distinct integers than its width.
    """
    return (F.signum(v) * F.floor(F.log2(F.abs(v) + 1) * BUCKETS_PER_OCTAVE)).cast("int")


def ranked_histogram(hist: DataFrame) -> DataFrame:
    """Add rank ranges to a value histogram ``(column_name, v, k)``.

    Output adds ``lo``/``hi`` (the 0-based ranks ``[lo, hi)`` the value
    occupies among all rows of its column) and ``n`` (rows of the column).
    The running count is a window per (column, value bucket); each bucket's
    offset comes from a prefix sum over the bucket totals, a table of at most
    a few thousand rows per column.
    """
    spread = hist.withColumn("b", value_bucket(F.col("v")))
    run = Window.partitionBy("column_name", "b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    windowed = spread.withColumn("_run", F.sum("k").over(run))
    # a bucket's total is its last running count: same subplan, shuffles reused
    totals = windowed.groupBy("column_name", "b").agg(F.max("_run").alias("kb"))
    before = Window.partitionBy("column_name").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "column_name",
        "b",
        F.coalesce(F.sum("kb").over(before), F.lit(0)).alias("off"),
        F.sum("kb").over(Window.partitionBy("column_name")).alias("n"),
    )
    # offsets has at most 2*16*64 rows per column: a proven-small broadcast.
    # Every bucket has an offset, so a left join equals an inner one; it also
    # keeps Catalyst from inferring a filter on one branch only, which would
    # stop the two branches from sharing their shuffles.
    return (
        windowed.join(F.broadcast(offsets), ["column_name", "b"], "left")
        .select("column_name", "v", "k", "n", (F.col("off") + F.col("_run")).alias("hi"))
        .withColumn("lo", F.col("hi") - F.col("k"))
    )


def numeric_summary(filtered: DataFrame, columns: Sequence[str] = SUMMARY_COLUMNS) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear interpolation), max — 2 places.

    Exact quartiles without collecting values: the columns are unpivoted into
    (column, cents) pairs, counted per distinct value (partial aggregation,
    so a value repeated in a third of all rows is one histogram row), and
    :func:`ranked_histogram` locates the ranks the quartiles need.
    """
    long = filtered.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), _cents(c).alias("v")) for c in columns])
        ).alias("p")
    ).select("p.column_name", "p.v").where(F.col("v").isNotNull())
    hist = long.groupBy("column_name", "v").agg(n_rows().alias("k"))
    cum = ranked_histogram(hist)

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("lo") <= rank) & (rank < F.col("hi")), F.col("v")))

    aggs: list[Column] = [
        F.first("n").alias("count"),
        (F.sum(F.col("v").cast("decimal(38,0)") * F.col("k"))).alias("_sum"),
        (F.sum(F.col("v").cast("decimal(38,0)") * F.col("v") * F.col("k"))).alias("_sumsq"),
        F.min("v").alias("_min"),
        F.max("v").alias("_max"),
    ]
    for i, q in enumerate(QUARTILES):
        pos = F.lit(q) * (F.col("n") - 1)
        base = F.floor(pos)
        aggs += [
            F.first(pos - base).alias(f"_f{i}"),
            value_at(base).alias(f"_a{i}"),
            value_at(F.least(base + 1, F.col("n") - 1)).alias(f"_b{i}"),
        ]
    stats = cum.groupBy("column_name").agg(*aggs)

    n = F.col("count")

    def money(cents: Column) -> Column:
        return cents.cast("double") / 100.0

    var_num = n * F.col("_sumsq") - F.col("_sum") * F.col("_sum")
    std = F.when(n > 1, F.sqrt(var_num.cast("double") / (n * (n - 1)).cast("double")) / 100.0)
    out = [
        "column_name",
        "count",
        money(_round_half(F.col("_sum"), n)).alias("mean"),
        F.round(std, 2).alias("std"),
        money(F.col("_min")).alias("min"),
    ]
    for i, label in enumerate(("p25", "p50", "p75")):
        a, b, f = F.col(f"_a{i}"), F.col(f"_b{i}"), F.col(f"_f{i}")
        out.append(money(_round_cents(a.cast("double") + f * (b - a).cast("double"))).alias(label))
    out.append(money(F.col("_max")).alias("max"))
    return stats.select(*out)


def _round_half(num: Column, den: Column) -> Column:
    """Integer ``round(num / den)`` half away from zero (exact)."""
    a = (F.abs(num) * 2 + den).cast("decimal(38,0)")
    b = (den * 2).cast("decimal(38,0)")
    return F.signum(num).cast("int") * ((a - a % b) / b).cast("decimal(38,0)")


def histogram(
    df: DataFrame,
    value: str,
    bins: int,
    by: Sequence[str] = (),
    scale: int = 0,
) -> DataFrame:
    """Equal-width histogram from min to max (last bin closed), optionally per group.

    Bins are shared by all groups. Min and max come from one scalar aggregate;
    each row's bin is then computed in place, so only (group, bin) counts are
    shuffled.
    """
    units = F.col(value) if scale == 0 else (F.col(value) * 10**scale).cast("bigint")
    src = df.select(*by, units.alias("_u")).where(F.col("_u").isNotNull())
    lo = src.select(F.min("_u")).scalar()
    hi = src.select(F.max("_u")).scalar()
    width = hi - lo
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.call_function("div", (F.col("_u") - lo) * bins, width), F.lit(bins - 1))
    )
    counted = src.select(*by, b.cast("int").alias("bin")).groupBy(*by, "bin").agg(n_rows().alias("n"))
    step = width.cast("double") / float(bins) / float(10**scale)
    start = lo.cast("double") / float(10**scale)
    return counted.select(
        *by,
        "bin",
        (start + F.col("bin").cast("double") * step).alias("bin_start"),
        (start + (F.col("bin") + 1).cast("double") * step).alias("bin_end"),
        "n",
    )


# --- Explorer --------------------------------------------------------------------------

# The columns that the explorer shows first.
EXPLORER_DEFAULT = (
    "hotel_type",
    "is_canceled",
    "country",
    "adr",
    "total_nights",
    "revenue",
    "arrival_date",
    "year_month",
    "lead_time",
    "market_segment",
    "deposit_type",
)


def explorer_rows(filtered: DataFrame, columns: Sequence[str] = EXPLORER_DEFAULT, limit: int = 500) -> DataFrame:
    """First ``limit`` rows of a column subset in a total order (arrival, fingerprint)."""
    return (
        filtered.select(*columns, "_row_hash")
        .orderBy(F.col("arrival_date").asc_nulls_last(), "_row_hash")
        .limit(limit)
    )
