"""Raw layer: lineage, fingerprints, idempotent append, load metrics.

A bronze table holds the 32 raw text columns plus ``_loaded_at``,
``_source_file`` and ``_row_hash``; a fingerprint is stored at most once. It is
a versioned table: a load writes its new rows aside and publishes them whole,
and two loads that run at once cannot both store a fingerprint, as the later
one to publish checks again what the other has added.

Plan shape of an append: new rows are reduced to one per fingerprint (partial
``WindowGroupLimit`` before the exchange on ``_row_hash``) and then checked
against the fingerprint index (anti join on the same partitioning). Of the
stored table nothing is read, of the index only the folders that the batch's
fingerprints fall into.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.functions.fingerprint import row_hash
from innkeep.operators import fingerprint_index as index
from innkeep.operators.silver import first_per_fingerprint
from innkeep.schema import RAW_COLUMNS
from innkeep.sources.csv_source import FILE_NAME, CsvBatch, expected_columns
from innkeep.sources.versioned import EMPTY, Conflict, Entry, VersionedTable


def with_lineage(
    raw: DataFrame,
    source_file: str | Column | None = None,
    loaded_at: Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``_loaded_at`` (UTC load time), ``_source_file`` and ``_row_hash``.

    ``source_file`` may be a literal name or a column (e.g. the file name of
    the scanned file); raw values are coalesced to ``''`` before hashing.
    """
    if source_file is None:
        src = F.lit(None).cast("string")
    elif isinstance(source_file, str):
        src = F.lit(source_file)
    else:
        src = source_file
    ts = loaded_at if loaded_at is not None else F.current_timestamp()
    return raw.select(
        *[F.col(c) for c in RAW_COLUMNS],
        ts.alias("_loaded_at"),
        src.alias("_source_file"),
        row_hash(RAW_COLUMNS).alias("_row_hash"),
        *(keep or []),
    )


def new_rows(batch: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Rows of ``batch`` to insert: first per fingerprint, and not yet stored.

    Insert-if-absent semantics of a unique fingerprint: a fingerprint repeated
    inside the batch is kept once; one already in ``existing`` is skipped.

    The batch is reduced to one row per fingerprint first (partial
    ``WindowGroupLimit`` before the exchange), so a fingerprint copied into a
    third of the batch is one row per map task. The anti join then reuses
    that partitioning; of the stored table only ``_row_hash`` is read. There
    is one plan for batches of any size (AQE may still broadcast stored
    fingerprints that it measures small).
    """
    first = first_per_fingerprint(batch)
    if existing is None:
        return first
    return first.join(existing.select("_row_hash"), "_row_hash", "left_anti").select(*batch.columns)


@dataclass(frozen=True)
class LoadResult:
    metrics: DataFrame  # one row: rows_read, inserted, duplicates, malformed, total
    inserted: DataFrame  # the rows this load published


class VolumeCheckError(ValueError):
    """Raised before publishing when a load would leave too few rows."""


METRICS_SCHEMA = "rows_read long, inserted long, duplicates long, malformed long, total long"


def read_bronze(spark: SparkSession, bronze_path: str) -> DataFrame | None:
    """The published rows of the bronze table, or None when nothing was loaded yet."""
    return VersionedTable(spark, bronze_path).frame()


def _count_and_ranges(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of rows, and which of 256 equal ranges of the fingerprint they change."""
    found = rows.agg(F.count(F.lit(1)), F.collect_set(index.bucket_of(index.key_of(), 8))).first()
    return found[0], sorted(found[1])


def _noted(table: VersionedTable, base: Entry, notes: dict) -> Entry:
    """A load that adds nothing leaves a version of its own only to tell which inputs it has read."""
    if "inputs" not in notes:
        return base
    try:
        return table.publish(base, base.data, base.rows, segments=index.segments_of(base), ranges=[], **notes)
    except Conflict:
        return base


def append_absent(
    table: VersionedTable, batch: DataFrame, min_rows: int = 0, base: Entry | None = None, **notes: object
) -> tuple[Entry, int, str | None]:
    """Publish the rows of a staged ``batch`` whose fingerprint is not stored; (version, rows, their folder).

    The rows are decided on as of ``base`` (default: the latest version) and
    written aside. If another load publishes first and has added fingerprints
    in a range that this one changes too, the rows written are checked against
    the index once more and the publishing is tried again, on top of the other
    load. A batch without new rows adds no data.
    """
    base = base or table.latest()
    folder = table.folder()
    index.absent(table, index.segments_of(base), first_per_fingerprint(batch), batch).write.parquet(table.at(folder))
    while True:
        new = table.spark.read.schema(batch.schema).parquet(table.at(folder))
        inserted, ranges = _count_and_ranges(new)
        if base.rows + inserted < min_rows:
            table.files.remove(table.at(folder))
            raise VolumeCheckError(f"the load would leave {base.rows + inserted} rows, at least {min_rows} are required")
        if not inserted:
            table.files.remove(table.at(folder))
            return _noted(table, base, notes), 0, None
        stay, made = index.merged_with(table, index.segments_of(base), new.select(index.key_of().alias("key")), inserted)
        try:
            published = table.publish(base, (*base.data, folder), base.rows + inserted, segments=stay + made, ranges=ranges, **notes)
            return published, inserted, folder
        except Conflict:
            for segment in made:
                table.files.remove(table.at(segment["folder"]))
            others = table.since(base.version)
            base = others[-1]
            if set(ranges).isdisjoint(r for e in others for r in e.notes.get("ranges", range(256))):
                continue
            again = table.folder()
            index.absent(table, index.segments_of(base), new).write.parquet(table.at(again))
            table.files.remove(table.at(folder))
            folder = again


def load_csv(
    spark: SparkSession,
    csv_path: str | list[str],
    bronze_path: str,
    min_rows: int = 80_000,
    multi_line: bool | str = "auto",
    **notes: object,
) -> LoadResult:
    """CSV extract -> bronze (insert-if-absent by fingerprint); returns metrics and new rows.

    Steps: read the text once into staged fields in the shared staging folder;
    name them, add lineage and fingerprints, and write the rows that are not
    stored yet beside the table; check the volume gate; publish them. A failed
    or gated load publishes nothing, and readers see a load whole or not at
    all. The total comes from the log. ``notes`` are kept in the log entry.
    """
    loaded_at = F.lit(spark.sql("SELECT CAST(current_timestamp() AS STRING)").first()[0]).cast("timestamp")
    table = VersionedTable(spark, bronze_path)
    table.latest()  # a folder that is no such table is an error before anything is read
    source = CsvBatch(spark, csv_path, multi_line, RAW_COLUMNS)
    try:
        landed = with_lineage(expected_columns(source), F.col(FILE_NAME), loaded_at, keep=["_malformed"])
        stats = landed.agg(F.count(F.lit(1)).alias("n"), F.count_if("_malformed").alias("bad")).first()
        batch = landed.drop("_malformed")
        counts = {"rows_read": int(stats["n"]), "malformed": int(stats["bad"])}
        entry, inserted, folder = append_absent(table, batch, min_rows, counts=counts, **notes)
        schema = batch.schema
    finally:
        source.remove()
    new = spark.read.schema(schema).parquet(table.at(folder)) if folder else spark.createDataFrame([], schema)
    return LoadResult(load_metrics(spark, counts, inserted, entry.rows), new)


def load_metrics(spark: SparkSession, counts: dict, inserted: int, total: int) -> DataFrame:
    rows_read = counts["rows_read"]
    return spark.createDataFrame([(rows_read, inserted, rows_read - inserted, counts["malformed"], total)], METRICS_SCHEMA)


def last_load(spark: SparkSession, bronze_path: str) -> tuple[Entry, LoadResult | None]:
    """The last version, and the result of the load that published it."""
    table = VersionedTable(spark, bronze_path)
    entry = table.latest()
    if "counts" not in entry.notes:
        return entry, None
    before = table.entry(entry.version - 1) if entry.version else EMPTY
    new = [d for d in entry.data if d not in before.data]
    rows = spark.read.parquet(*map(table.at, new)) if new else table.frame(entry).limit(0)
    return entry, LoadResult(load_metrics(spark, entry.notes["counts"], entry.rows - before.rows, entry.rows), rows)
