"""Data-quality checks. Each returns the violating rows; empty means pass.

All checks are distributed aggregations or filters; a report unions the
per-check violation counts (one small row per check) and a gate raises when
any check has violations.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.functions.fingerprint import is_hash_text, row_hash
from innkeep.operators.gold import n_rows
from innkeep.schema import RAW_COLUMNS
from innkeep.session import checkpoint_dir

# Declared expectations of the cleaned and gold layers.
SILVER_NOT_NULL = ["_row_hash", "hotel_type", "is_canceled", "adr", "arrival_date"]
COUNTRIES_NOT_NULL = ["country", "total_bookings", "popularity_rank"]
MOM_NOT_NULL = ["hotel_type", "year_month"]
ACCEPTED_VALUES = {"hotel_type": ["Hotel", "Apartment"], "is_canceled": ["0", "1"]}
RAW_VALUE_SETS = {"hotel": ["Hotel", "Apartment"], "is_canceled": ["0", "1"]}
MIN_ROWS = 80_000
CANCEL_RATE_BOUNDS = (10.0, 50.0)
MIN_COUNTRIES = 50
MAX_NEGATIVE_RATE_PCT = 1.0


def unique(df: DataFrame, column: str, table: str) -> DataFrame:
    """Values of ``column`` that occur more than once (group HAVING count > 1)."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(n_rows().alias("occurrences"))
        .where(F.col("occurrences") > 1)
        .select(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.col(column).cast("string").alias("value"),
            "occurrences",
        )
    )


# The repeated-probe pre-filter broadcasts at most this many bytes
# (16-byte probes plus hash-map overhead, counted before broadcasting).
PROBE_BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
PROBE_BYTES = 64


def unique_fingerprint(df: DataFrame, column: str, table: str) -> DataFrame:
    """:func:`unique` for a SHA-256 hex fingerprint column, shuffling 16-byte probes first.

    Phase one counts rows per probe (the fingerprint's first 32 hex
    characters unhexed) and counts the probes that repeat: a shuffle of 16
    bytes per row instead of the 64-character text. No repeated probe means
    no repeated value (equal values share a probe), so the check is empty
    without touching the full values again. Otherwise, when the repeated
    probes fit the broadcast bound (checked count x ``PROBE_BYTES``), only
    rows whose probe repeats reach the exact group-by (null-safe match, so a
    non-hex value with a NULL probe is kept); beyond the bound the exact
    check runs on all rows. Phase one runs when the check is built.
    """
    probe = F.unhex(F.substring(F.col(column), 1, 32))
    present = df.where(F.col(column).isNotNull())
    repeated = (
        present.groupBy(probe.alias("_probe")).agg(n_rows().alias("_n")).where(F.col("_n") > 1).select("_probe")
    )
    checkpoint_dir(df.sparkSession)
    repeated = repeated.checkpoint(eager=True)
    n = repeated.count()
    if n == 0:
        return unique(df.where(F.lit(False)), column, table)
    if n * PROBE_BYTES > PROBE_BROADCAST_LIMIT_BYTES:
        return unique(df, column, table)
    candidates = present.join(F.broadcast(repeated), probe.eqNullSafe(F.col("_probe")), "left_semi")
    return unique(candidates, column, table)


def not_null(df: DataFrame, columns: Sequence[str], table: str, key: str) -> DataFrame:
    """One row per (row, column) that is NULL; all columns checked in one pass."""
    flags = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    return (
        df.where(any_null)
        .select(F.col(key).cast("string").alias("row_key"), F.explode(flags).alias("column_name"))
        .where(F.col("column_name").isNotNull())
        .select(F.lit(table).alias("table_name"), "column_name", "row_key")
    )


def accepted_values(df: DataFrame, allowed: Mapping[str, Sequence[str]], table: str) -> DataFrame:
    """Values outside the accepted list with their counts (NULLs are not flagged).

    All checked columns in one scan: (column, value) pairs are unpivoted,
    filtered to values outside the column's list, and counted per pair
    (partial aggregation before the shuffle).
    """
    cols = list(allowed)
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])
        ).alias("p")
    ).select("p.column_name", "p.value")
    name, value = F.col("column_name"), F.col("value")
    accepted = F.lit(False)
    for c in cols:
        accepted = F.when(name == F.lit(c), value.isin(list(allowed[c]))).otherwise(accepted)
    return (
        pairs.where(value.isNotNull() & ~accepted)
        .groupBy("column_name", "value")
        .agg(n_rows().alias("occurrences"))
        .select(F.lit(table).alias("table_name"), "column_name", "value", "occurrences")
    )


def value_set(df: DataFrame, expected: Mapping[str, Sequence[str]]) -> DataFrame:
    """Exact set equality: expected values that are absent, and values not expected.

    The checked columns are unpivoted into (column, value) pairs and reduced
    to their distinct pairs in one scan (partial aggregation, so a value in
    a third of all rows is one row per map task). A full outer equi-join
    with the fixed expected pairs then yields both findings in one branch:
    pairs only seen are unexpected (a NULL value never matches, so it is
    unexpected too), pairs only expected are missing. The distinct pairs are
    already partitioned on the join keys, so only the expected pairs move.
    """
    cols = list(expected)
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])
        ).alias("p")
    ).select("p.column_name", "p.value")
    seen = pairs.distinct().withColumn("_seen", F.lit(True))
    wanted = df.sparkSession.createDataFrame(
        [(c, x) for c in cols for x in expected[c]], "column_name string, value string"
    ).withColumn("_expected", F.lit(True))
    both = seen.join(wanted, ["column_name", "value"], "full_outer")
    return both.where(F.col("_seen").isNull() | F.col("_expected").isNull()).select(
        "column_name",
        "value",
        F.when(F.col("_expected").isNull(), F.lit("unexpected")).otherwise(F.lit("missing")).alias("problem"),
    )


def non_negative(df: DataFrame, column: str) -> DataFrame:
    """Each negative value of ``column`` with its number of occurrences."""
    return (
        df.where(F.col(column) < 0)
        .groupBy(F.col(column).alias("invalid_value"))
        .agg(n_rows().alias("occurrences"))
    )


def volume(df: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """A row (count, expected minimum) when the table has fewer than ``min_rows`` rows."""
    return (
        df.agg(n_rows().alias("row_count"))
        .where(F.col("row_count") < min_rows)
        .select("row_count", F.lit(min_rows).cast("bigint").alias("expected_minimum"))
    )


def raw_profile(raw: DataFrame) -> DataFrame:
    """One row of raw-row counts shared by the dataset-level checks.

    total rows, rows with ``is_canceled = '1'``, distinct country texts other
    than ``'NULL'``, rows with a negative rate. The three checks below take
    it as ``profile``; passing one stored profile to all of them scans the
    raw rows once.
    """
    rate = F.col("adr").try_cast("double")  # as written: -0.004 is negative
    country = F.when(F.col("country") != F.lit("NULL"), F.col("country"))
    return raw.agg(
        n_rows().alias("total_rows"),
        F.count_if(F.col("is_canceled") == F.lit("1")).alias("canceled_rows"),
        F.count_distinct(country).alias("distinct_countries"),
        F.count_if(rate < 0).alias("negative_rows"),
    )


def _share_pct(num: str, den: str) -> Column:
    return (F.col(num) * 100).cast("double") / F.col(den).cast("double")


def rate_bounds(
    raw: DataFrame, bounds: tuple[float, float] = CANCEL_RATE_BOUNDS, profile: DataFrame | None = None
) -> DataFrame:
    """A row when the share of rows with ``is_canceled = '1'`` is outside ``bounds`` (percent)."""
    lo, hi = bounds
    p = profile if profile is not None else raw_profile(raw)
    return (
        p.select(_share_pct("canceled_rows", "total_rows").alias("cancel_rate_pct"))
        .where((F.col("cancel_rate_pct") < lo) | (F.col("cancel_rate_pct") > hi))
        .select("cancel_rate_pct", F.lit(lo).alias("lower_pct"), F.lit(hi).alias("upper_pct"))
    )


def diversity(raw: DataFrame, min_distinct: int = MIN_COUNTRIES, profile: DataFrame | None = None) -> DataFrame:
    """A row when fewer than ``min_distinct`` country texts occur (``'NULL'`` excluded)."""
    p = profile if profile is not None else raw_profile(raw)
    return p.where(F.col("distinct_countries") < min_distinct).select(
        "distinct_countries", F.lit(min_distinct).cast("bigint").alias("expected_minimum")
    )


def negative_share(raw: DataFrame, max_pct: float = MAX_NEGATIVE_RATE_PCT, profile: DataFrame | None = None) -> DataFrame:
    """A row when negative rates are ``max_pct`` percent of all rows or more."""
    p = profile if profile is not None else raw_profile(raw)
    return p.select(
        "negative_rows", "total_rows", _share_pct("negative_rows", "total_rows").alias("negative_pct")
    ).where(F.col("negative_pct") >= max_pct)


def hash_format(bronze: DataFrame) -> DataFrame:
    """Fingerprints that are not 64 lower-hex characters or do not match the values."""
    # what equals the values' fingerprint is of the right format too, so only the others' text is looked at
    right = F.col("_row_hash") == row_hash(RAW_COLUMNS)
    problem = F.when(right, F.lit(None)).when(is_hash_text(F.col("_row_hash")), F.lit("mismatch")).otherwise(F.lit("format"))
    return bronze.select("_row_hash", problem.alias("problem")).where(F.col("problem").isNotNull())


def row_check_counts(
    df: DataFrame, prefix: str, not_null_columns: Sequence[str], allowed: Mapping[str, Sequence[str]], min_rows: int
) -> DataFrame:
    """Violation counts of the not-null, accepted-values and volume checks in one scan (same counts as the single checks)."""
    nulls = sum((F.count_if(F.col(c).isNull()) for c in not_null_columns), F.lit(0).cast("bigint"))
    text = {c: F.col(c).cast("string") for c in allowed}
    bad = sum((F.count_distinct(F.when(~v.isin(list(allowed[c])), v)) for c, v in text.items()), F.lit(0).cast("bigint"))
    counts = df.agg(
        nulls.alias(f"{prefix}_not_null"), bad.alias(f"{prefix}_accepted_values"), F.when(n_rows() < min_rows, 1).otherwise(0).cast("bigint").alias(f"{prefix}_volume")
    )
    return counts.unpivot([], counts.columns, "check_name", "violations").withColumn("passed", F.col("violations") == 0)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check: violation count and pass flag."""
    rows = [
        df.agg(n_rows().alias("violations")).select(F.lit(name).alias("check_name"), "violations")
        for name, df in checks.items()
    ]
    return _union(rows).withColumn("passed", F.col("violations") == 0)


class QualityGateError(RuntimeError):
    pass


def gate(report_df: DataFrame) -> None:
    """Raise when any check in a report has violations (stops downstream steps)."""
    failing = report_df.where(~F.col("passed")).select("check_name", "violations").collect()
    if failing:
        detail = ", ".join(f"{r.check_name}={r.violations}" for r in failing)
        raise QualityGateError(f"data-quality checks failed: {detail}")
