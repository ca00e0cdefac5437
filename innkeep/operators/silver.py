"""Cleaned, typed and enriched layer built from bronze rows.

Plan shape: a hash-only check for repeated fingerprints; when some repeat,
one shuffle on ``_row_hash`` (keep the first row per fingerprint; Catalyst
inserts a partial ``WindowGroupLimit`` before the exchange, so even a
fingerprint copied into a third of all rows leaves at most one row per map
task). Then a broadcast join to the fixed 12-row month map and a single
projection. A bronze table written by the loader stores each fingerprint
once, so its cleaned layer is a map over the scan with no row shuffle. If
bronze is hash-partitioned or bucketed by ``_row_hash`` the exchange
disappears as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innkeep.functions import cleaning as C
from innkeep.schema import INT_COLUMNS, NULLABLE_TEXT_COLUMNS, RAW_COLUMNS, silver_name
from innkeep.sources.dimensions import month_map

def dedup_order(df: DataFrame) -> list[Column]:
    """Earliest load first, then source file, then a 64-bit hash of the raw values.

    The value hash (computed per column, so unlike the fingerprint it has no
    separator ambiguity) makes the choice deterministic when two different
    rows share a fingerprint and a load; it is one long computed before the
    shuffle, so unused raw columns can still be pruned from the exchange.
    """
    order = [F.col(c).asc_nulls_last() for c in ("_loaded_at", "_source_file") if c in df.columns]
    return order + [F.xxhash64(*[F.col(c) for c in RAW_COLUMNS]).asc()]


def first_per_fingerprint(bronze: DataFrame, key: str = "_row_hash") -> DataFrame:
    """Keep the earliest-loaded row of each fingerprint (deterministic on retry)."""
    w = Window.partitionBy(key).orderBy(*dedup_order(bronze))
    return bronze.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def has_repeated(df: DataFrame, key: str = "_row_hash") -> bool:
    """Whether any ``key`` value (a SHA-256 hex fingerprint) may occur more than once.

    Only a 16-byte probe per row is shuffled: the first 32 hex characters
    unhexed (partial counts per map task); the largest count per probe is
    reduced to one value in the same job. Equal keys always give equal
    probes, so a repeated key is never missed; a probe shared by different
    keys (a 128-bit prefix collision, or text that is not hex) can only
    answer "repeated", which makes the caller run its exact dedup anyway.
    (A ``limit(1)`` would read the reduce side in growing waves of
    partitions, and when nothing repeats, which is the case this check is
    for, every wave runs.)
    """
    probe = F.unhex(F.substring(F.col(key), 1, 32)).alias("_probe")
    counts = df.groupBy(probe).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.agg(F.max("_n").alias("_max")).first()
    return top is not None and top["_max"] is not None and top["_max"] > 1


def with_month_number(df: DataFrame, month_col: str = "arrival_date_month") -> DataFrame:
    """Left join to the month map; unmatched names get a NULL ``month_number``."""
    months = month_map(df.sparkSession)
    return df.join(F.broadcast(months), F.col(month_col) == F.col("month_name"), "left").drop(
        "month_name"
    )


def typed_columns(strict: bool = True) -> list[Column]:
    """The 32 raw columns, sentinel-cleaned, typed and renamed."""
    out: list[Column] = []
    for c in RAW_COLUMNS:
        if c in INT_COLUMNS:
            expr = C.typed_int(c, strict)
        elif c in NULLABLE_TEXT_COLUMNS:
            expr = C.sentinel_null(c)
        elif c == "adr":
            expr = C.typed_rate(c, strict)
        elif c == "reservation_status_date":
            expr = C.typed_date(c, strict)
        else:
            expr = F.col(c)
        out.append(expr.alias(silver_name(c)))
    return out


def derived_columns(strict: bool = True) -> list[Column]:
    """total_nights, revenue, arrival_date, year_month, was_room_changed.

    Expects the raw text columns and ``month_number`` in scope.
    """
    weekend = C.typed_int("stays_in_weekend_nights", strict)
    week = C.typed_int("stays_in_week_nights", strict)
    nights = C.total_nights(weekend, week)
    year, day, mnum = F.col("arrival_date_year"), F.col("arrival_date_day_of_month"), F.col("month_number")
    return [
        nights.alias("total_nights"),
        C.revenue(F.col("is_canceled"), C.typed_rate("adr", strict), nights).alias("revenue"),
        C.arrival_date(year, mnum, day, strict).alias("arrival_date"),
        C.year_month(year, mnum).alias("year_month"),
        C.room_changed(F.col("reserved_room_type"), F.col("assigned_room_type")).alias("was_room_changed"),
    ]


def clean(deduped: DataFrame, strict: bool = True) -> DataFrame:
    """Typed + derived columns + lineage for already-deduplicated bronze rows."""
    joined = with_month_number(deduped)
    lineage = [F.col(c) for c in ("_loaded_at", "_source_file", "_row_hash") if c in deduped.columns]
    return joined.select(*typed_columns(strict), *derived_columns(strict), *lineage)


def build_silver(bronze: DataFrame, strict: bool = True, dedup: bool | str = "auto") -> DataFrame:
    """Bronze rows -> cleaned layer (40 columns): dedup, type, derive.

    ``strict=True`` fails on text that does not parse (typed SQL model
    semantics); ``strict=False`` turns it into NULL (dashboard semantics).
    ``dedup="auto"`` runs the keep-first window only when
    :func:`has_repeated` finds a repeated fingerprint (same rows either
    way; the check is a job that runs when the frame is built); ``True``
    always runs the window, for inputs known to hold copies.
    """
    if dedup == "auto":
        dedup = has_repeated(bronze)
    return clean(first_per_fingerprint(bronze) if dedup else bronze, strict)


def project_renamed(df: DataFrame) -> DataFrame:
    """Raw text columns with the cleaned layer's names (no typing)."""
    return df.select(*[F.col(c).alias(silver_name(c)) for c in RAW_COLUMNS])
