"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables of ``sf_dir`` (through the derived layers
in :mod:`innkeep.plans.datasets`) and runs over all of their rows. DECIMAL
outputs are presented as DOUBLE so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from innkeep.functions import cleaning as C
from innkeep.functions.fingerprint import row_hash
from innkeep.functions.rounding import exact_mean
from innkeep.operators import gold, quality as Q, rollups as R, silver as silver_ops
from innkeep.operators import bronze as B, check_compiler
from innkeep.operators.ranking import rank_by
from innkeep.plans import datasets as D, pipeline as P
from innkeep.session import checkpoint_dir, staging_path
from innkeep.sources.csv_source import inferred_types, scan_expected, schema_reports
from innkeep.sources.tables import read_layer, write_layer
from innkeep.streaming.ingest import ingest_available
from innkeep.schema import INT_COLUMNS, NULLABLE_TEXT_COLUMNS, RAW_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]
SENTINEL_COLUMNS = set(INT_COLUMNS) | set(NULLABLE_TEXT_COLUMNS) | {"adr", "reservation_status_date"}
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


# --- Flagship tables -----------------------------------------------------------


@query("popular_countries")
def q_popular_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(gold.popular_countries(D.silver_table(spark, sf_dir)))


@query("mom_growth")
def q_mom_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(gold.mom_growth(D.silver_table(spark, sf_dir)))


@query("country_stats")
def q_country_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(gold.country_stats(D.silver_table(spark, sf_dir)))


@query("monthly_revenue")
def q_monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(gold.monthly_revenue(D.silver_table(spark, sf_dir)))


# --- Cleaned layer ----------------------------------------------------------------


@query("silver_bookings")
def q_silver_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    # _loaded_at is the run's load time: not part of the compared output.
    return D.as_doubles(D.silver(spark, sf_dir).drop("_loaded_at"))


@query("silver_dedup")
def q_silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_ops.first_per_fingerprint(D.bronze(spark, sf_dir)).drop("_loaded_at")


@query("row_hash")
def q_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.raw(spark, sf_dir).select(*RAW_COLUMNS, row_hash(RAW_COLUMNS).alias("_row_hash"))


@query("silver_project")
def q_silver_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_ops.project_renamed(D.raw(spark, sf_dir))


@query("month_join")
def q_month_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_ops.with_month_number(D.raw(spark, sf_dir).select("arrival_date_month"))


@query("sentinel_nulls")
def q_sentinel_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = [c for c in RAW_COLUMNS if c in SENTINEL_COLUMNS]
    return D.raw(spark, sf_dir).select(*[C.sentinel_null(c).alias(c) for c in cols])


@query("typed_columns")
def q_typed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(D.raw(spark, sf_dir).select(*silver_ops.typed_columns(strict=True)))


@query("lenient_typed_columns")
def q_lenient_typed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(D.raw(spark, sf_dir).select(*silver_ops.typed_columns(strict=False)))


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_ops.with_month_number(D.raw(spark, sf_dir))


@query("total_nights")
def q_total_nights(spark: SparkSession, sf_dir: str) -> DataFrame:
    nights = C.total_nights(C.typed_int("stays_in_weekend_nights"), C.typed_int("stays_in_week_nights"))
    return D.raw(spark, sf_dir).select("stays_in_weekend_nights", "stays_in_week_nights", nights.alias("total_nights"))


@query("revenue")
def q_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    nights = C.total_nights(C.typed_int("stays_in_weekend_nights"), C.typed_int("stays_in_week_nights"))
    rev = C.revenue(F.col("is_canceled"), C.typed_rate("adr"), nights)
    return D.as_doubles(
        D.raw(spark, sf_dir).select(
            "is_canceled", "adr", "stays_in_weekend_nights", "stays_in_week_nights", rev.alias("revenue")
        )
    )


@query("year_month")
def q_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    ym = C.year_month(F.col("arrival_date_year"), F.col("month_number"))
    return _derived(spark, sf_dir).select("arrival_date_year", "arrival_date_month", ym.alias("year_month"))


@query("arrival_date")
def q_arrival_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    y, d = F.col("arrival_date_year"), F.col("arrival_date_day_of_month")
    ad = C.arrival_date(y, F.col("month_number"), d)
    return _derived(spark, sf_dir).select(
        "arrival_date_year", "arrival_date_month", "arrival_date_day_of_month", ad.alias("arrival_date")
    )


@query("room_changed")
def q_room_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rc = C.room_changed(F.col("reserved_room_type"), F.col("assigned_room_type"))
    return D.raw(spark, sf_dir).select("reserved_room_type", "assigned_room_type", rc.alias("was_room_changed"))


# --- Filters and explorer ------------------------------------------------------------

# Dashboard-style selection used by the filtered-rows query.
EXAMPLE_FILTER = R.BookingFilter(types=["Hotel", "Apartment"], years=[1995, 1996, 1997], status="Canceled")


@query("completed_bookings")
def q_completed_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(gold.completed(D.silver_table(spark, sf_dir)).drop("_loaded_at"))


@query("filtered_bookings")
def q_filtered_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(EXAMPLE_FILTER.apply(D.silver_table(spark, sf_dir)).drop("_loaded_at"))


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.BookingFilter().apply(D.silver_table(spark, sf_dir))


@query("explorer_rows")
def q_explorer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(R.explorer_rows(_filtered(spark, sf_dir)))


@query("mom_nonnull")
def q_mom_nonnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(gold.mom_growth(D.silver_table(spark, sf_dir)).dropna(subset=["mom_pct_change"]))


# --- Top-k -------------------------------------------------------------------------------

TOP_N = 20


@query("top_countries")
def q_top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(gold.top_countries(gold.popular_countries(D.silver_table(spark, sf_dir)), TOP_N))


@query("top_countries_revenue")
def q_top_countries_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = gold.popular_countries(D.silver_table(spark, sf_dir))
    return D.as_doubles(
        ranked.orderBy("popularity_rank", "country").limit(30).select("country", "total_bookings", "total_revenue")
    )


@query("top5_countries")
def q_top5_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = gold.popular_countries(D.silver_table(spark, sf_dir))
    return gold.top_countries(ranked, 5).select("country", "total_bookings", "popularity_rank")


@query("mom_sample")
def q_mom_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    mom = gold.mom_growth(D.silver_table(spark, sf_dir))
    return D.as_doubles(
        mom.where(F.col("hotel_type") == "Hotel")
        .orderBy("year_month")
        .limit(6)
        .select("hotel_type", "year_month", "total_booking_amount", "mom_pct_change")
    )


# --- Rollups -----------------------------------------------------------------------------


@query("kpi_summary")
def q_kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(R.kpi_summary(D.raw(spark, sf_dir), D.silver_table(spark, sf_dir)))


@query("duplicate_count")
def q_duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.duplicate_count(D.bronze(spark, sf_dir))


@query("monthly_bookings")
def q_monthly_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.monthly_bookings(_filtered(spark, sf_dir))


@query("monthly_completed_revenue")
def q_monthly_completed_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(R.monthly_completed_revenue(D.silver_table(spark, sf_dir)))


@query("cancel_rate_by_type")
def q_cancel_rate_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(R.cancel_rate_by_type(D.silver_table(spark, sf_dir)))


@query("type_comparison")
def q_type_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(R.type_comparison(D.silver_table(spark, sf_dir)))


@query("type_rates_long")
def q_type_rates_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_doubles(R.type_rates_long(D.silver_table(spark, sf_dir)))


@query("seasonality")
def q_seasonality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.seasonality(_filtered(spark, sf_dir))


@query("presentation_order")
def q_presentation_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each row in the marts as they are presented: by rank, by type and month, by calendar month."""
    marts = (
        ("popular_countries", gold.presentation_order_countries(D.countries_table(spark, sf_dir)), ("country",)),
        ("mom_growth", gold.presentation_order_mom(D.mom_table(spark, sf_dir)), ("hotel_type", "year_month")),
        ("seasonality", R.seasonality_ordered(_filtered(spark, sf_dir)), ("arrival_date_month", "hotel_type")),
    )
    out = None
    for mart, ordered, key in marts:
        # the rows of a mart (countries, months) in the order in which they come
        placed = ordered.withColumn("_at", F.monotonically_increasing_id())
        place = F.row_number().over(Window.orderBy("_at")).alias("position")
        part = placed.select(F.lit(mart).alias("mart"), place, F.concat_ws("/", *key).alias("row_key"))
        out = part if out is None else out.unionByName(part)
    return out


def _raw_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.raw_typed(D.raw(spark, sf_dir))


@query("value_counts_board")
def q_vc_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.value_counts(_filtered(spark, sf_dir), "board")


@query("value_counts_segment")
def q_vc_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.value_counts(_filtered(spark, sf_dir), "market_segment")


@query("value_counts_country")
def q_vc_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.value_counts(_raw_t(spark, sf_dir), "country")


@query("value_counts_year")
def q_vc_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.value_counts(_raw_t(spark, sf_dir), "arrival_date_year")


@query("value_counts_type")
def q_vc_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.value_counts(_raw_t(spark, sf_dir), "hotel")


@query("distinct_countries")
def q_distinct_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.distinct_count(_raw_t(spark, sf_dir), "country", "distinct_countries")


@query("distinct_types")
def q_distinct_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.distinct_values(D.silver_table(spark, sf_dir), "hotel_type")


@query("null_profile")
def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.null_profile(_raw_t(spark, sf_dir))


@query("cancellation_rate")
def q_cancellation_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.cancellation_rate(_raw_t(spark, sf_dir))


@query("cancel_rate_by_year")
def q_cancel_rate_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.mean_by(_raw_t(spark, sf_dir), ["arrival_date_year"], "is_canceled", "cancel_rate")


@query("avg_rate_by_type")
def q_avg_rate_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.mean_by(_raw_t(spark, sf_dir), ["hotel"], "adr", "avg_daily_rate", scale=2)


@query("avg_rate_by_type_status")
def q_avg_rate_by_type_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.mean_by(_raw_t(spark, sf_dir), ["hotel", "is_canceled"], "adr", "avg_daily_rate", scale=2)


@query("cancel_crosstab")
def q_cancel_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.cancel_crosstab(_raw_t(spark, sf_dir))


@query("outlier_counts")
def q_outlier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.outlier_counts(D.raw(spark, sf_dir))


@query("numeric_summary")
def q_numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.numeric_summary(_filtered(spark, sf_dir))


@query("raw_rate_summary")
def q_raw_rate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.numeric_summary(_raw_t(spark, sf_dir), ["adr"])


@query("lead_time_histogram")
def q_lead_time_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.histogram(_filtered(spark, sf_dir), "lead_time", 50)


@query("rate_histogram")
def q_rate_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.histogram(_filtered(spark, sf_dir), "adr", 80, by=["hotel_type"], scale=2)


@query("silver_profile")
def q_silver_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = D.silver_table(spark, sf_dir)
    return D.as_doubles(
        s.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.lit(len(s.columns)).alias("column_count"),
            exact_mean(F.col("adr"), 2).alias("avg_adr"),
        )
    )


@query("revenue_rank")
def q_revenue_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each booking's place by revenue (ties share a place) and by lead time, shortest first."""
    rows = D.silver_table(spark, sf_dir).select("_row_hash", "revenue", "lead_time")
    ranked = rank_by(rank_by(rows, "revenue", "revenue_rank"), "lead_time", "lead_rank", descending=False)
    return D.as_doubles(ranked)


# --- Data quality ------------------------------------------------------------------------


def quality_checks(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """The declared checks over raw rows, landing, the cleaned layer and gold (built lazily)."""
    raw, bronze = D.raw(spark, sf_dir), D.bronze(spark, sf_dir)
    built: dict[str, DataFrame] = {}

    def silver() -> DataFrame:
        # stored on first use: the checks of the raw rows do not read it
        return D.silver_table(spark, sf_dir)

    def profile() -> DataFrame:
        # one row of raw counts for the three dataset-level checks, stored
        # once (checkpoint folder) so a report scans the raw rows once;
        # sharing the lazy aggregate would not do it, as column pruning
        # gives each check its own narrower copy
        if "profile" not in built:
            checkpoint_dir(spark)
            built["profile"] = Q.raw_profile(raw).checkpoint(eager=True)
        return built["profile"]

    def countries_table() -> DataFrame:
        # built once per check set: building it checkpoints the per-country
        # statistics (one aggregation over silver)
        if "countries" not in built:
            built["countries"] = gold.popular_countries(silver())
        return built["countries"]

    def not_null() -> DataFrame:
        countries = countries_table()
        mom = gold.mom_growth(silver()).withColumn("_key", F.concat_ws("/", "hotel_type", "year_month"))
        return (
            Q.not_null(silver(), Q.SILVER_NOT_NULL, "silver", "_row_hash")
            .unionByName(Q.not_null(countries, Q.COUNTRIES_NOT_NULL, "popular_countries", "country"))
            .unionByName(Q.not_null(mom, Q.MOM_NOT_NULL, "mom_growth", "_key"))
        )

    return {
        "dq_unique": lambda: Q.unique_fingerprint(silver(), "_row_hash", "silver").unionByName(
            Q.unique(countries_table(), "country", "popular_countries")
        ),
        "dq_not_null": not_null,
        "dq_accepted_values": lambda: Q.accepted_values(silver(), Q.ACCEPTED_VALUES, "silver"),
        "dq_value_set": lambda: Q.value_set(raw, Q.RAW_VALUE_SETS),
        "dq_non_negative": lambda: Q.non_negative(silver(), "adr"),
        "dq_volume": lambda: Q.volume(silver()),
        "dq_rate_bounds": lambda: Q.rate_bounds(raw, profile=profile()),
        "dq_diversity": lambda: Q.diversity(raw, profile=profile()),
        "dq_negative_share": lambda: Q.negative_share(raw, profile=profile()),
        "dq_hash_format": lambda: Q.hash_format(bronze),
    }


def _check(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return D.as_doubles(quality_checks(spark, sf_dir)[name]())

    run.__name__ = f"q_{name}"
    return run


for _name in (
    "dq_unique",
    "dq_not_null",
    "dq_accepted_values",
    "dq_value_set",
    "dq_non_negative",
    "dq_volume",
    "dq_rate_bounds",
    "dq_diversity",
    "dq_negative_share",
    "dq_hash_format",
):
    QUERIES[_name] = _check(_name)


DECLARED_CHECKS = (
    check_compiler.Check("dq_unique", "silver", "unique_fingerprint", ("_row_hash",)),
    check_compiler.Check("dq_unique", "countries", "unique", ("country",)),
    check_compiler.Check("dq_not_null", "silver", "not_null", tuple(Q.SILVER_NOT_NULL)),
    check_compiler.Check("dq_not_null", "countries", "not_null", tuple(Q.COUNTRIES_NOT_NULL)),
    check_compiler.Check("dq_not_null", "mom", "not_null", tuple(Q.MOM_NOT_NULL)),
    check_compiler.Check("dq_accepted_values", "silver", "accepted_values", tuple(Q.ACCEPTED_VALUES), Q.ACCEPTED_VALUES),
    check_compiler.Check("dq_value_set", "landing", "value_set", tuple(Q.RAW_VALUE_SETS), Q.RAW_VALUE_SETS),
    check_compiler.Check("dq_non_negative", "silver", "non_negative", ("adr",)),
    check_compiler.Check("dq_volume", "silver", "min_rows", (), Q.MIN_ROWS),
    check_compiler.Check("dq_rate_bounds", "landing", "share_within", ("is_canceled",), ("1", *Q.CANCEL_RATE_BOUNDS)),
    check_compiler.Check("dq_diversity", "landing", "min_distinct", ("country",), (Q.MIN_COUNTRIES, "NULL")),
    check_compiler.Check("dq_negative_share", "landing", "negative_share_below", ("adr",), Q.MAX_NEGATIVE_RATE_PCT),
    check_compiler.Check("dq_hash_format", "landing", "row_hash", ("_row_hash",)),
)


@query("dq_report")
def q_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks, compiled: landing and gold are read once, silver once and once more for uniqueness."""
    return check_compiler.report(
        {
            "landing": D.landing(spark, sf_dir),
            "silver": D.silver_table(spark, sf_dir),
            "countries": D.countries_table(spark, sf_dir),
            "mom": D.mom_table(spark, sf_dir),
        },
        DECLARED_CHECKS,
    )


# --- The same checks, and lenient parsing, on rows with faults ------------------------------


@query("faulty_report")
def q_faulty_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compiled checks of the raw rows, on rows with faults."""
    return check_compiler.report({"landing": D.faulty(spark, sf_dir)}, [*(c for c in DECLARED_CHECKS if c.table == "landing"), check_compiler.Check("dq_unique", "landing", "unique_fingerprint", ("_row_hash",))])


@query("faulty_unique")
def q_faulty_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.unique_fingerprint(D.faulty(spark, sf_dir), "_row_hash", "bronze")


@query("faulty_accepted_values")
def q_faulty_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_ops.build_silver(D.faulty(spark, sf_dir), strict=False, dedup=True)
    return Q.accepted_values(silver, Q.ACCEPTED_VALUES, "silver")


@query("faulty_value_set")
def q_faulty_value_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.value_set(D.faulty(spark, sf_dir), Q.RAW_VALUE_SETS)


@query("faulty_rate_bounds")
def q_faulty_rate_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.rate_bounds(D.faulty(spark, sf_dir))


@query("faulty_negative_share")
def q_faulty_negative_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.negative_share(D.faulty(spark, sf_dir))


@query("faulty_hash_format")
def q_faulty_hash_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.hash_format(D.faulty(spark, sf_dir))


@query("faulty_outlier_counts")
def q_faulty_outlier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.outlier_counts(D.faulty(spark, sf_dir))


@query("faulty_crosstab")
def q_faulty_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.cancel_crosstab(R.raw_typed(D.faulty(spark, sf_dir)))


@query("faulty_silver")
def q_faulty_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned layer of faulty rows, parsed leniently: what does not parse is NULL."""
    silver = silver_ops.build_silver(D.faulty(spark, sf_dir), strict=False, dedup=True)
    return D.as_doubles(silver.drop("_loaded_at"))


@query("faulty_load_metrics")
def q_faulty_load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.load_csv(spark, D.faulty_csv(spark, sf_dir), staging_path(spark, "bronze"), min_rows=1).metrics


# --- CSV source, bronze load, sinks, pipeline -----------------------------------------

# The earlier of two overlapping extracts: stays that arrived up to 1995.
EARLY_EXTRACT = "CAST(arrival_date_year AS INT) <= 1995"


@query("csv_source")
def q_csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_expected(spark, D.csv_extract(spark, sf_dir))
    return scanned.select(*RAW_COLUMNS)


@query("inferred_types")
def q_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type that all values of a column in all files of the extract have in common."""
    kinds = inferred_types(scan_expected(spark, D.csv_extract(spark, sf_dir)), RAW_COLUMNS)
    return spark.createDataFrame(list(kinds.items()), "column_name string, type string")


@query("schema_report")
def q_schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = set()
    for rep in schema_reports(spark, D.csv_extract(spark, sf_dir)):
        status |= {(c, "extra" if c in rep.extra else "expected") for c in rep.columns} | {(c, "missing") for c in rep.missing}
    return spark.createDataFrame(sorted(status), "column_name string, status string")


@query("bronze_lineage")
def q_bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_expected(spark, D.csv_extract(spark, sf_dir))
    stamped = B.with_lineage(scanned, F.col("_file_name"))
    has = F.col("_loaded_at").isNotNull() & F.col("_source_file").endswith(".csv")
    return stamped.select("_row_hash", has.alias("has_lineage"))


def _two_loads(spark: SparkSession, sf_dir: str) -> B.LoadResult:
    bronze_path = staging_path(spark, "bronze")
    B.load_csv(spark, D.csv_extract(spark, sf_dir, "early", EARLY_EXTRACT), bronze_path, min_rows=1)
    return B.load_csv(spark, D.csv_extract(spark, sf_dir), bronze_path, min_rows=1)


@query("bronze_append_new")
def q_bronze_append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_loads(spark, sf_dir).inserted.select(*RAW_COLUMNS, "_row_hash")


@query("load_metrics")
def q_load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_loads(spark, sf_dir).metrics


@query("bronze_load")
def q_bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze_path = staging_path(spark, "bronze")
    B.load_csv(spark, D.csv_extract(spark, sf_dir), bronze_path, min_rows=1)
    return B.read_bronze(spark, bronze_path).select(*RAW_COLUMNS, "_row_hash")


@query("layer_sink")
def q_layer_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "gold-popular_countries")
    write_layer(gold.popular_countries(D.silver_table(spark, sf_dir)), path)
    return D.as_doubles(read_layer(spark, path))


@query("pipeline_summary")
def q_pipeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = P.Layout(staging_path(spark, "warehouse"))
    run = P.run_pipeline(spark, D.csv_extract(spark, sf_dir), layout, min_rows=1, gate_quality=False)
    return run.summary


@query("stream_ingest")
def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop-folder stream into bronze, run twice: the second run finds no new files."""
    drop = D.csv_extract(spark, sf_dir, "ordered", shuffled=False)
    bronze_path, ckpt = staging_path(spark, "bronze-stream"), staging_path(spark, "stream-checkpoint")
    ingest_available(spark, drop, bronze_path, ckpt)
    ingest_available(spark, drop, bronze_path, ckpt)
    return B.read_bronze(spark, bronze_path).select(*RAW_COLUMNS, "_row_hash")


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)
