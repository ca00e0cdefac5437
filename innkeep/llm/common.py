"""Helpers shared by the text operators: Arrow batches, row keys, staged tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.session import staging_path

#: Bytes of text that a Python worker handles at a time; a longer text is handled alone.
CHUNK_BYTES = 512 << 10
#: Rows in an Arrow batch at most: texts can be long, and each Python stage holds batches in and out.
BATCH_ROWS = 500
MIX, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A word: a run of characters other than space, tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array's values and where each begins (one more offset at the end); null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[at[0] : at[-1]], (at - at[0]).astype(np.int64)


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """Slices of a string array of about ``most`` bytes each, in order, at least one row each."""
    _, at = utf8(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield texts.slice(first, last - first)
        first = last


def give_back() -> None:
    """Return memory that is free in this Python worker to the system.

    Spark keeps workers for later tasks and takes them in turn, so what each of
    them holds on to counts beside the work of those that are busy.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's; other C libraries need no call
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Keep the session's Arrow batches at BATCH_ROWS rows or fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def with_arrow(
    df: DataFrame, text_col: str, fields: list[T.StructField], compute: Callable[[pa.Array], dict[str, pa.Array]], most: int = CHUNK_BYTES
) -> DataFrame:
    """All columns of ``df`` plus those that ``compute`` makes from slices of the text column.

    ``compute`` gets about ``most`` bytes of text at a time, so a worker's memory
    does not grow with the partition. A computed column replaces an input
    column of the same name.
    """
    small_batches(df.sparkSession)
    new = {f.name for f in fields}
    kept = [c for c in df.columns if c not in new]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("string").alias("_llm_text"))
    schema = T.StructType([*(f for f in df.schema.fields if f.name in kept), *fields])

    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        first = 0
        for part in chunks(batch.column(len(kept)), most):
            made = compute(part)
            columns = [batch.column(i).slice(first, len(part)) for i in range(len(kept))]
            first += len(part)
            yield pa.RecordBatch.from_arrays(columns + [made[f.name] for f in fields], names=[f.name for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from parts(batch)
            batch = None
            give_back()

    return source.mapInArrow(run, schema)


def key_words(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, longest: int) -> np.ndarray:
    """Each key's bytes as little-endian eight-byte words, zero beyond its end."""
    padded = np.concatenate([data, np.zeros(longest + 16, np.uint8)])
    view = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    out = np.zeros((len(starts), max(1, -(-longest // 8))), np.uint64)
    for j in range(out.shape[1]):
        left = np.clip(lens - 8 * j, 0, 8).astype(np.uint64)
        mask = np.where(left == 8, ~np.uint64(0), (np.uint64(1) << (left * np.uint64(8) % np.uint64(64))) - np.uint64(1))
        out[:, j] = np.where(left > 0, view[np.minimum(starts + 8 * j, len(view) - 1)] & mask, 0)
    return out


def fold(words: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each key; words beyond a key's end do not count."""
    h = lens.astype(np.uint64) * MIX
    for j in range(words.shape[1]):
        x = (h ^ words[:, j]) * MIX2
        x ^= x >> np.uint64(32)
        x *= MIX
        x ^= x >> np.uint64(29)
        h = np.where(lens > 8 * j, x, h)
    return h


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of texts in a row, and the index of each text's first word (one more at the end)."""
    data = _LOWER[data]
    word = ~_WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | edge[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:-1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    lens = last - first
    out = np.zeros(len(first), np.uint64)
    for low in range(0, 64, 8):
        own = np.flatnonzero((lens > low) & (lens <= low + 8))
        if len(own):
            out[own] = fold(key_words(data, first[own], lens[own], low + 8), lens[own])
    long = np.flatnonzero(lens > 64)
    if len(long):
        raw = data.tobytes()
        out[long] = [xxhash.xxh3_64_intdigest(raw[first[i] : last[i]]) for i in long]
    return out, np.searchsorted(first, at)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def staged(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write to the session's shared staging folder and read again: cuts lineage, survives lost executors."""
    spark: SparkSession = df.sparkSession
    path = staging_path(spark, name)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
