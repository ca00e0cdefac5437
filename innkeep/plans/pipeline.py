"""CSV-to-gold run: bronze load, cleaned layer, analytical tables, quality gate.

Each layer is a versioned table below a warehouse root (a shared folder on a
cluster) and the next layer reads the published version, so every step starts
from storage with a short lineage, readers never see half a refresh, and a run
that failed can be resumed at the failed step.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.operators import gold, quality as Q
from innkeep.operators.bronze import LoadResult, last_load, load_csv
from innkeep.operators.silver import build_silver
from innkeep.sources.tables import SILVER_PARTITIONING, read_layer
from innkeep.sources.versioned import VersionedTable


@dataclass(frozen=True)
class Layout:
    """Table locations below a warehouse root (one folder per layer)."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return os.path.join(self.root, layer, table)

    @property
    def bronze(self) -> str:
        return self.path("bronze", "raw_bookings")

    @property
    def silver(self) -> str:
        return self.path("silver", "stg_bookings")

    @property
    def countries(self) -> str:
        return self.path("gold", "popular_countries")

    @property
    def mom(self) -> str:
        return self.path("gold", "mom_growth")


    @property
    def quality(self) -> str:
        return self.path("quality", "report")


@dataclass(frozen=True)
class PipelineRun:
    load: LoadResult
    quality: DataFrame
    summary: DataFrame


def source_state(spark: SparkSession, csv_path: str | list[str]) -> str:
    """A digest of the names, sizes and change times of the extract's files (contents are not read)."""
    files = spark.read.format("binaryFile").load(csv_path).select("path", "length", "modificationTime")
    state = files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
    return "/".join(map(str, state))


def refresh(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], inputs: dict, resume: bool = False, partition_by: list[str] | None = None
) -> int:
    """Publish a layer built from ``inputs`` (versions of other tables); returns its version.

    With ``resume`` a layer whose last version was built from the same inputs is left as it is.
    """
    table = VersionedTable(spark, path)
    last = table.latest()
    if resume and last.data and last.notes.get("inputs") == inputs:
        return last.version
    return table.replace(build(), partition_by, inputs=inputs).version


def build_layers(spark: SparkSession, layout: Layout, resume: bool = False) -> dict[str, int]:
    """Full refresh of silver and gold from the published bronze table; the version of each layer."""
    bronze = VersionedTable(spark, layout.bronze)
    raw = bronze.latest()
    made = {"bronze": raw.version}
    made["silver"] = refresh(spark, layout.silver, lambda: build_silver(bronze.frame(raw)), {"bronze": raw.version}, resume, SILVER_PARTITIONING)
    stored = VersionedTable(spark, layout.silver)
    silver = lambda: stored.frame(stored.entry(made["silver"]))
    made["countries"] = refresh(spark, layout.countries, lambda: gold.popular_countries(silver()), {"silver": made["silver"]}, resume)
    made["mom"] = refresh(spark, layout.mom, lambda: gold.mom_growth(silver()), {"silver": made["silver"]}, resume)
    return made


def quality_report(spark: SparkSession, layout: Layout, min_rows: int = Q.MIN_ROWS) -> DataFrame:
    """The declared checks of the stored layers (violation count per check)."""
    silver, countries, mom = (read_layer(spark, p) for p in (layout.silver, layout.countries, layout.mom))
    others = Q.report(
        {
            "silver_unique_row_hash": Q.unique_fingerprint(silver, "_row_hash", "silver"),
            "countries_unique": Q.unique(countries, "country", "popular_countries"),
            "countries_not_null": Q.not_null(countries, Q.COUNTRIES_NOT_NULL, "popular_countries", "country"),
            "mom_not_null": Q.not_null(
                mom.withColumn("_key", F.concat_ws("/", "hotel_type", "year_month")),
                Q.MOM_NOT_NULL,
                "mom_growth",
                "_key",
            ),
        }
    )
    # the row-level checks of the large table share one scan
    return Q.row_check_counts(silver, "silver", Q.SILVER_NOT_NULL, Q.ACCEPTED_VALUES, min_rows).unionByName(others)


def table_counts(spark: SparkSession, layout: Layout, load: LoadResult) -> DataFrame:
    """Rows per written table, plus the rows read from the extract."""
    parts = [
        load.metrics.select(F.lit("raw").alias("layer"), F.lit("extract").alias("table_name"), F.col("rows_read").alias("rows"))
    ]
    for layer, table, path in (
        ("bronze", "raw_bookings", layout.bronze),
        ("silver", "stg_bookings", layout.silver),
        ("gold", "popular_countries", layout.countries),
        ("gold", "mom_growth", layout.mom),
    ):
        parts.append(
            read_layer(spark, path).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "rows"
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_pipeline(
    spark: SparkSession,
    csv_path: str | list[str],
    layout: Layout,
    min_rows: int = Q.MIN_ROWS,
    gate_quality: bool = True,
    resume: bool = False,
) -> PipelineRun:
    """ingest -> silver -> gold -> checks -> summary (rows per table, violations per check).

    The checks always run and their report is stored; ``gate_quality`` only
    decides whether violations raise. Each table's log tells what it was built
    from, so with ``resume`` a run goes on after the last stage that an earlier
    run has finished on the same inputs: an extract that the last load has read
    is not read again, and a layer built from the current versions stays.
    """
    files = source_state(spark, csv_path)
    last, load = last_load(spark, layout.bronze) if resume else (None, None)
    if load is None or last.notes.get("inputs") != files or last.rows < min_rows:
        load = load_csv(spark, csv_path, layout.bronze, min_rows=min_rows, inputs=files)
    made = build_layers(spark, layout, resume)
    refresh(spark, layout.quality, lambda: quality_report(spark, layout, min_rows), {"min_rows": min_rows, **made}, resume)
    report = read_layer(spark, layout.quality)
    if gate_quality:
        Q.gate(report)
    checks = report.select(F.lit("check").alias("layer"), F.col("check_name").alias("table_name"), F.col("violations").alias("rows"))
    return PipelineRun(load, report, table_counts(spark, layout, load).unionByName(checks))
