"""Exact removal of long repeated strings with a logarithmic family of suffix indexes.

Every 200-byte window of a text has one anchor: the 48-byte gram of smallest
hash inside it. Windows with equal bytes have their anchor at the same place,
so only suffixes that begin at anchors (about 1.3 % of all) are indexed. A
level of the index is a table of these suffixes in the order of their anchor:
(anchor, context, count), where the context is a hash of all bytes that the
anchor's windows cover. A new batch gets a level of its own, and levels of
about equal size are merged, so a suffix is written again only a logarithmic
number of times. ``remove_repeats`` does not scan a batch against the levels
(``IndexFamily.scan`` can): it inserts all batches and then finds the anchors
that occur twice by one aggregation over the merged index.

Windows whose whole context occurs twice are repeated. If an anchor occurs in
several contexts, the windows that these share are found by comparing their
window hashes. Anchors of very many contexts (a common line) are first split
by the 76 bytes before or after the anchor, one of which each window covers.

Hashes have 64 bits. Sorting all suffixes (8 bytes or more for each byte of
text) would need many times the input on disk, hence the anchors; the result
is the same.

Defined results: a null text has no bytes. Equal rows are occurrences of one
another, so both lose what is repeated. Texts under 200 bytes lose nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.llm.common import MIX, MIX2, chunks, small_batches, staged, utf8
from innkeep.session import remove_staged, staging_path

WINDOW = 200
GRAM = 48
#: Bytes beside the anchor by which contexts are split.
SIDE = (WINDOW - GRAM) // 2
CHUNK = 1 << 20
#: Batches that the documents of one call are inserted in.
BATCHES = 2
#: Contexts under one split anchor that are compared in one task; beyond it their windows are counted by a shuffle.
TASK_CONTEXTS = 50_000
#: Keys that are broadcast at most (8 to 16 bytes each); beyond it Spark picks the join.
BROADCAST_KEYS = 2_000_000

_TABLE = (np.arange(1, 257, dtype=np.uint64) * MIX) ^ ((np.arange(1, 257, dtype=np.uint64) * MIX2) >> np.uint64(17))


# ---------------------------------------------------------------- hashes of byte ranges
def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (b * MIX2)) * MIX
    x ^= x >> np.uint64(31)
    return x


def hash32(data: np.ndarray) -> np.ndarray:
    """A hash of the 32 bytes at each place (shorter by 31)."""
    h = _TABLE[data]
    for step in (1, 2, 4, 8, 16):
        h = _join(h[:-step], h[step:])
    return h


def range_hash(h: np.ndarray, start: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """A hash of ``size`` (32 or more, at most ``most``) bytes from each start."""
    out = size.astype(np.uint64) * MIX
    for k in range(-(-most // 32)):
        out = np.where(32 * k < size, _join(out, h[start + np.minimum(32 * k, size - 32)]), out)
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contexts of texts in a row: text, first window, last window, anchor's place, anchor's and context's hash."""
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    h = hash32(data)
    gram = _join(h[: -(GRAM - 32)], h[GRAM - 32 :])
    bits = np.uint64(max(1, int(len(gram)).bit_length()))
    packed = ((gram >> bits) << bits) | np.arange(len(gram), dtype=np.uint64)
    low = _sliding_min(packed, WINDOW - GRAM + 1)
    place = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    inside = np.zeros(len(place) + 1, np.int32)  # windows that do not leave their text
    first, last = at[:-1], at[1:] - WINDOW + 1
    fits = last > first
    np.add.at(inside, first[fits], 1)
    np.add.at(inside, last[fits], -1)
    ok = np.cumsum(inside)[:-1] > 0
    new = ok.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~ok[:-1]
    begins = np.zeros(len(place) + 1, bool)
    begins[first[fits]] = True
    new |= begins[:-1] & ok
    s1 = np.flatnonzero(new)
    stop = ok & np.append(new[1:] | ~ok[1:], True)
    s2 = np.flatnonzero(stop)
    a = place[s1]
    span = s2 - s1 + WINDOW
    context = _join(range_hash(h, s1, span, 2 * WINDOW - GRAM), (a - s1).astype(np.uint64))
    return np.searchsorted(at, s1, "right") - 1, s1, s2, a, gram[a], context


def text_key(raw: bytes) -> tuple[int, int]:
    """Two numbers that tell texts apart (80 bits)."""
    d = xxhash.xxh3_128_intdigest(raw)
    return ((d & (2**64 - 1)) ^ (1 << 63)) - (1 << 63), d >> 64 & 0xFFFF


# where: first window << 32 | windows - 1 << 24 | anchor's offset << 16 | part of the text's key
def suffixes(docs: DataFrame, text_col: str) -> DataFrame:
    """Rows (anchor, context, text_key, place): each anchored context of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch.column(0), CHUNK):
                data, at = utf8(part)
                doc, s1, s2, a, anchor, context = anchors(data, at)
                raw = data.tobytes()
                keys = [text_key(raw[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                key = np.array([k for k, _ in keys], np.int64)[doc]
                more = np.array([m for _, m in keys], np.int64)[doc]
                place = (s1 - at[doc]) << 32 | (s2 - s1) << 24 | (a - s1) << 16 | more
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), pa.array(key), pa.array(place)],
                    names=["anchor", "context", "text_key", "place"],
                )

    return docs.select(F.col(f"`{text_col}`").alias("t")).mapInArrow(run, "anchor long, context long, text_key long, place long")


# ---------------------------------------------------------------- the index
class IndexFamily:
    """Levels of sorted suffix tables; a level's size is within a factor of two of a power of two."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.levels: list[tuple[int, str]] = []  # rows and path, largest first

    def _write(self, rows: DataFrame) -> tuple[int, str]:
        path = staging_path(self.spark, "suffix-level")
        rows.sortWithinPartitions("anchor", "context").write.parquet(path)
        return self.spark.read.parquet(path).count(), path

    def read(self) -> DataFrame | None:
        """All levels' rows; a context may have one in each."""
        frames = [self.spark.read.parquet(p) for _, p in self.levels]
        out = None
        for f in frames:
            out = f if out is None else out.union(f)
        return out

    @staticmethod
    def _sum(rows: DataFrame) -> DataFrame:
        return rows.groupBy("anchor", "context").agg(F.sum("count").alias("count"), F.min("one").alias("one"))

    def insert(self, batch: DataFrame) -> None:
        """Add a batch's suffixes as a level, then merge levels of about equal size."""
        one = F.struct("text_key", "place")
        rows = batch.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("count"), F.min(one).alias("one"))
        self.levels.append(self._write(rows))
        self.levels.sort(reverse=True)
        while len(self.levels) > 1 and self.levels[-2][0].bit_length() <= self.levels[-1][0].bit_length() + 1:
            (_, a), (_, b) = self.levels[-2:]
            merged = self._write(self._sum(self.spark.read.parquet(a).union(self.spark.read.parquet(b))))
            self.levels[-2:] = [merged]
            for path in (a, b):
                remove_staged(self.spark, path)

    def scan(self, batch: DataFrame) -> DataFrame:
        """Of a batch that is not inserted yet: its suffixes whose anchor a level has, with the level's context count (null: another context)."""
        known = self._sum(self.read()).withColumnRenamed("count", "seen").drop("one") if self.levels else None
        if known is None:
            return batch.where("false").withColumn("seen", F.lit(None).cast("long"))
        at_anchor = known.select("anchor").distinct()
        return batch.join(at_anchor, "anchor", "left_semi").join(known, ["anchor", "context"], "left")

    def repeated(self) -> DataFrame:
        """(anchor, context, count, one) of anchors that occur twice or more."""
        rows = self.read()
        rows = self._sum(rows) if len(self.levels) > 1 else rows
        several = rows.groupBy("anchor").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("contexts")).where("total > 1")
        return rows.join(several, "anchor")


def bounded(df: DataFrame) -> DataFrame:
    """Marked for broadcast if the stored table's row count proves it small."""
    return F.broadcast(df) if df.count() <= BROADCAST_KEYS else df


# ---------------------------------------------------------------- contexts that differ
def split_contexts(docs: DataFrame, text_col: str, contexts: DataFrame) -> DataFrame:
    """Rows (split, anchor, context, low, high, bytes): one for each side of each context's first occurrence.

    low and high: the windows of the context that cover this side; each window belongs to one side.
    """
    wanted = contexts.select("anchor", "context", F.col("one.text_key").alias("key"), F.col("one.place").alias("place"))
    by_text = staged(wanted.groupBy("key").agg(F.collect_list(F.struct("place", "anchor", "context")).alias("places")), "context-places")
    texts = with_key(docs, text_col).join(bounded(by_text.select("key")), "key", "left_semi").dropDuplicates(["key", "more"])
    found = texts.join(by_text, "key")

    def run(batches):
        for batch in batches:
            out = []
            for text, more, places in zip(*(batch.column(i) for i in range(3)), strict=True):
                raw, more = text.as_buffer().to_pybytes(), more.as_py()
                for p in places.as_py():
                    place = p["place"]
                    if place & 0xFFFF != more:
                        continue
                    s1, n, off = place >> 32, (place >> 24 & 0xFF) + 1, place >> 16 & 0xFF
                    piece = raw[s1 : s1 + n - 1 + WINDOW]
                    for side, low, high, a, b in (("L", 0, min(n - 1, off - SIDE - 1), off - SIDE, off + GRAM), ("R", max(0, off - SIDE), n - 1, off, off + GRAM + SIDE)):
                        if low <= high:
                            split = xxhash.xxh3_64_intdigest(piece[a:b] + side.encode()) - (1 << 63)
                            out.append((split, p["anchor"], p["context"], low, high, piece))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["split", "anchor", "context", "low", "high", "bytes"])

    return found.select("text", "more", "places").mapInArrow(run, "split long, anchor long, context long, low int, high int, bytes binary")


def with_key(docs: DataFrame, text_col: str, keep: list[str] | None = None) -> DataFrame:
    """Kept columns, key and more (the text's key) and text."""
    kept = keep or []

    def run(batches):
        for batch in batches:
            keys = [text_key(t.as_buffer().to_pybytes()) for t in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), pa.array([k for k, _ in keys], pa.int64()), pa.array([m for _, m in keys], pa.int32()), batch.column(len(kept))],
                names=[*kept, "key", "more", "text"],
            )

    source = docs.select(*(F.col(f"`{c}`") for c in kept), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"))
    schema = T.StructType([*(source.schema[c] for c in kept), T.StructField("key", T.LongType()), T.StructField("more", T.IntegerType()), T.StructField("text", T.BinaryType())])
    return source.mapInArrow(run, schema)


def windows_of(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, number and hash of every window that the rows of split contexts cover."""
    n = (frame["high"] - frame["low"] + 1).to_numpy(np.int64)
    row = np.repeat(np.arange(len(frame)), n)
    number = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(frame["low"].to_numpy(np.int64), n)
    pieces = frame["bytes"].tolist()
    sizes = np.array([len(p) for p in pieces], np.int64)
    begin = np.cumsum(sizes) - sizes
    h = hash32(np.frombuffer(b"".join(pieces), np.uint8))
    start = begin[row] + number
    return row, number, range_hash(h, start, np.full(len(start), WINDOW), WINDOW)


def _ranges(row: np.ndarray, number: np.ndarray, frame: pd.DataFrame) -> pd.DataFrame:
    """Runs of consecutive windows as (anchor, context, first, last)."""
    if not len(row):
        return pd.DataFrame({"anchor": [], "context": [], "first": [], "last": []})
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1] + 1)
    i = np.flatnonzero(new)
    j = np.append(i[1:], len(row)) - 1
    return pd.DataFrame({"anchor": frame["anchor"].to_numpy()[row[i]], "context": frame["context"].to_numpy()[row[i]], "first": number[i], "last": number[j]})


def shared_windows(split: DataFrame) -> DataFrame:
    """(anchor, context, first, last): runs of windows that another context has too."""
    counts = split.groupBy("split").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = split.join(counts, "split")
    schema = "anchor long, context long, first long, last long"

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:  # in the order of split: handle those that are whole, keep the last for more rows
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            whole = frame["split"] != frame["split"].iloc[-1]
            rest = frame[~whole]
            if whole.any():
                yield same(frame[whole].reset_index(drop=True))
        if rest is not None:
            yield same(rest.reset_index(drop=True))

    def same(frame: pd.DataFrame) -> pd.DataFrame:
        row, number, h = windows_of(frame)
        _, which, count = np.unique(h, return_inverse=True, return_counts=True)
        twice = count[which] > 1
        return _ranges(row[twice], number[twice], frame)

    small = rows.where(F.col("n") <= TASK_CONTEXTS).drop("n").repartition("split").sortWithinPartitions("split").mapInPandas(compare, schema)

    def exploded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            row, number, h = windows_of(frame)
            yield pd.DataFrame({"h": h.view(np.int64), "anchor": frame["anchor"].to_numpy()[row], "context": frame["context"].to_numpy()[row], "number": number})

    large = rows.where(F.col("n") > TASK_CONTEXTS).drop("n")
    if large.limit(1).count() == 0:
        return small
    large = staged(large.mapInPandas(exploded, "h long, anchor long, context long, number long"), "windows").distinct()
    twice = large.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    return small.union(large.join(twice, "h").select("anchor", "context", F.col("number").alias("first"), F.col("number").alias("last")))


# ---------------------------------------------------------------- removal
def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """One row a document: the id, ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (start, end in bytes) and ``kept`` (bytes)."""
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    index = IndexFamily(spark)
    stored = []
    for k in range(batches):
        own = source.where(F.pmod(F.xxhash64("_id", "_text"), F.lit(batches)) == k) if batches > 1 else source
        stored.append(staged(suffixes(own.where(F.octet_length("_text") >= WINDOW), "_text"), "suffixes"))
        index.insert(stored[-1])
    every = stored[0]
    for more in stored[1:]:
        every = every.union(more)
    repeated = staged(index.repeated(), "repeated")
    several = repeated.where("contexts > 1")
    split = staged(split_contexts(source, "_text", several), "contexts")
    partial = shared_windows(split).groupBy("anchor", "context").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.lit(WINDOW).cast("long").alias("last")))
    runs = F.when(F.col("count") > 1, whole).otherwise(F.col("runs"))
    hits = repeated.drop("one").join(partial, ["anchor", "context"], "left").select("anchor", "context", runs.alias("runs")).where("runs is not null")
    hits = staged(hits, "hits")
    # a broadcast of the anchors alone leaves few rows to shuffle for the join
    at = bounded(staged(hits.select("anchor").distinct(), "anchors"))
    rows = every.join(at, "anchor", "left_semi").join(hits, ["anchor", "context"]).select("text_key", "place", "runs").distinct()
    s1, n = F.shiftright("place", 32), F.shiftright("place", 24).bitwiseAND(F.lit(0xFF))
    cut = F.transform("runs", lambda r: F.struct((s1 + r["first"]).alias("start"), (s1 + F.least(r["last"], n) + WINDOW).alias("end")))
    more = F.col("place").bitwiseAND(F.lit(0xFFFF)).cast("int")
    cuts = rows.select(F.col("text_key").alias("ckey"), more.alias("cmore"), cut.alias("cut")).groupBy("ckey", "cmore").agg(F.flatten(F.collect_list("cut")).alias("cuts"))
    cuts = staged(cuts, "cuts")
    fields = "_id {0}, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept binary".format(source.schema["_id"].dataType.simpleString())

    def run(frames):
        for batch in frames:
            ids, texts, found = batch.column(0), batch.column(1), batch.column(2)
            out = [cut_out(t.as_buffer().to_pybytes(), c.as_py()) for t, c in zip(texts, found, strict=True)]
            n = [len(t.as_buffer().to_pybytes()) for t in texts]
            spans = [o[0] for o in out]
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array(n, pa.int64()), pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()), pa.array([len(s) for s in spans], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array([o[1] for o in out], pa.binary()),
                ],
                names=["_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
            )

    keyed = with_key(source, "_text", ["_id"])
    on = (F.col("key") == F.col("ckey")) & (F.col("more") == F.col("cmore"))
    keys = bounded(cuts.select("ckey", "cmore"))
    hit = keyed.join(keys, on, "left_semi").join(cuts, on).select("_id", "text", "cuts").mapInArrow(run, fields)
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    zero = F.lit(0).cast("long")
    clean = keyed.join(keys, on, "left_anti").select(
        "_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), none.alias("spans"), F.col("text").alias("kept")
    )
    return hit.union(clean).withColumnRenamed("_id", id_col)


def cut_out(raw: bytes, cuts: list[dict]) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed spans, and the bytes that stay."""
    spans: list[tuple[int, int]] = []
    for start, end in sorted((c["start"], c["end"]) for c in cuts):
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    kept, last = [], 0
    for start, end in spans:
        kept.append(raw[last:start])
        last = end
    return spans, b"".join([*kept, raw[last:]])
