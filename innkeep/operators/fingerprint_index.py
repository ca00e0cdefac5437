"""Which fingerprints a table holds, without reading the table.

The index is a list of segments. A segment holds the fingerprints of some
loads, 32 bytes each, dealt into 2**depth folders by their first bits so that a
folder holds about BUCKET_ROWS of them. A batch of b fingerprints reads at most
b folders of a segment, whatever the segment's size; large batches read what
they hit. A new segment is merged with those that are not larger than itself,
so segments grow geometrically and there are at most about log2(rows) of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.sources.versioned import Entry, VersionedTable

#: Fingerprints in a folder of a segment (about 2 MB), and the deepest split: beyond 2**32 rows of a segment folders grow.
BUCKET_ROWS = 1 << 16
MAX_DEPTH = 16
SCHEMA = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("bucket", T.IntegerType())])


def key_of(column: str = "_row_hash") -> Column:
    return F.unhex(F.col(column))


def bucket_of(key: Column, depth: int) -> Column:
    """The first ``depth`` bits of a fingerprint."""
    first = F.conv(F.hex(F.substring(key, 1, 2)), 16, 10).cast("int")
    return F.shiftright(first, 16 - depth)


def depth_for(rows: int) -> int:
    return min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS))))


def write_segment(table: VersionedTable, keys: DataFrame, rows: int) -> dict:
    """Store ``key`` values as a new segment (its folders are of one task each)."""
    depth, folder = depth_for(rows), table.folder("_index")
    placed = keys.select("key", bucket_of(F.col("key"), depth).alias("bucket"))
    # fingerprints are evenly spread, so are the folders
    placed = placed.repartition(1 << depth, "bucket") if depth else placed.coalesce(1)
    placed.sortWithinPartitions("bucket", "key").write.partitionBy("bucket").parquet(table.at(folder))
    return {"folder": folder, "rows": rows, "depth": depth}


def read_segment(table: VersionedTable, segment: dict, buckets: list[int] | None = None) -> DataFrame:
    """The keys of a segment, of some folders only if ``buckets`` are given."""
    spark, path = table.spark, table.at(segment["folder"])
    if buckets is None or len(buckets) == 1 << segment["depth"]:
        return spark.read.schema(SCHEMA).parquet(path).select("key")
    if not buckets:
        return spark.createDataFrame([], SCHEMA).select("key")
    # folders are named, not listed: a segment without fingerprints of these bits has none
    there = {int(n.partition("=")[2]) for n in table.files.names(path) if n.startswith("bucket=")}
    paths = [f"{path}/bucket={b}" for b in buckets if b in there]
    key_only = T.StructType(SCHEMA.fields[:1])
    return spark.read.schema(key_only).parquet(*paths) if paths else spark.createDataFrame([], key_only)


def stored_keys(table: VersionedTable, segments: list[dict], batch: DataFrame) -> DataFrame | None:
    """Keys of the segments that the batch may hold: the folders that its fingerprints fall into.

    ``batch`` (with ``_row_hash``) is read once per depth for the folders' numbers, at most 2**MAX_DEPTH.
    """
    out = None
    wanted: dict[int, list[int]] = {}
    for segment in segments:
        depth = segment["depth"]
        if depth and depth not in wanted:
            wanted[depth] = sorted(r[0] for r in batch.select(bucket_of(key_of(), depth)).distinct().collect())
        part = read_segment(table, segment, wanted.get(depth))
        out = part if out is None else out.union(part)
    return out


def absent(table: VersionedTable, segments: list[dict], rows: DataFrame, staged: DataFrame | None = None) -> DataFrame:
    """Those of ``rows`` whose fingerprint none of the segments holds; ``staged``: where their fingerprints are read from cheaply."""
    stored = stored_keys(table, segments, rows if staged is None else staged)
    if stored is None:
        return rows
    # as text, so that the rows keep their partitioning by fingerprint
    return rows.join(stored.select(F.lower(F.hex("key")).alias("_row_hash")), "_row_hash", "left_anti").select(*rows.columns)


def merged_with(table: VersionedTable, segments: list[dict], keys: DataFrame, rows: int) -> tuple[list[dict], list[dict]]:
    """(segments that stay, new segment in a list): ``keys`` joined with the segments that are not larger."""
    stay = sorted(segments, key=lambda s: -s["rows"])
    while stay and stay[-1]["rows"] <= rows:
        small = stay.pop()
        keys, rows = keys.union(read_segment(table, small)), rows + small["rows"]
    return stay, [write_segment(table, keys, rows)] if rows else []


def segments_of(entry: Entry) -> list[dict]:
    return list(entry.notes.get("segments", []))


def rebuild(spark: SparkSession, table: VersionedTable) -> Entry:
    """One new segment from the rows themselves (after a lost index)."""
    entry = table.latest()
    rows = table.frame(entry)
    made = [write_segment(table, rows.select(key_of().alias("key")), entry.rows)] if rows is not None else []
    return table.publish(entry, entry.data, entry.rows, **{**entry.notes, "segments": made, "added": []})
