"""Table scans and layer sinks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from innkeep.sources.versioned import VersionedTable, read_latest

LAYERS = ("bronze", "silver", "gold")

# The cleaned layer is stored partitioned by arrival year: dashboard filters
# select years, and a year holds many days of data at any realistic scale.
SILVER_PARTITIONING = ["arrival_date_year"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ensure_layers(spark: SparkSession, layers: tuple[str, ...] = LAYERS) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` for each layer namespace."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def write_layer(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    **notes: object,
) -> str:
    """Full-refresh (or append) sink for a layer table: a new version of a versioned table.

    Readers keep the version before until the new one is whole; a failed write
    leaves it as it was. A refresh may read its own table's current version.
    """
    # written straight from the tasks that made the rows: no shuffle on a key of few values
    table = VersionedTable(df.sparkSession, path)
    if mode == "overwrite":
        table.replace(df, partition_by, **notes)
    elif mode == "append":
        table.append(df, **notes)
    else:
        raise ValueError(f"mode {mode!r} is not one of overwrite, append")
    return path


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a layer table."""
    return read_latest(spark, path)


def save_layer_table(
    df: DataFrame,
    layer: str,
    name: str,
    mode: str = "overwrite",
    bucket_by: tuple[int, str] | None = None,
) -> str:
    """Catalog sink ``{layer}.{name}``; optionally bucketed (e.g. bronze by
    ``_row_hash``) so later dedup/anti-joins on that key skip the shuffle."""
    ensure_layers(df.sparkSession, (layer,))
    writer = df.write.mode(mode).format("parquet")
    if bucket_by:
        n, key = bucket_by
        writer = writer.bucketBy(n, key).sortBy(key)
    full = f"{layer}.{name}"
    writer.saveAsTable(full)
    return full
