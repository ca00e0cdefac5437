"""Source divergence audit: how the term frequencies of sources differ within a language.

Only terms in enough documents of a language count. They are found by iceberg
refinement of byte prefixes: for the prefixes of FIRST_BYTES bytes the distinct
documents are counted, prefixes below the threshold are discarded with all
terms that begin with them, the others are extended to twice the length, and so
on until no prefix is open. A term that ends within the length is complete and
counted itself. At last the complete terms that are left are counted exactly,
with their occurrences by source.

Prefixes that stay are told to the next level as bits of a filter of fixed size
(FILTER_BITS): a chance hit lets a rare term pass to the exact count, which
drops it; no frequent term is lost. So the filter's size does not grow with the
data. Counting is additive: each task sums what it has read before the shuffle,
and a group of any size is one row per task. Sums over pairs of sources are
made from blocks of terms (CELLS of the table of sources by terms at a time, more with many sources),
never from pairs within a term.

Defined results: a null text, lang or source is ''. Each row is a document:
repeated rows and ids count each. Texts count whole. A language without kept
terms has its pairs of sources with value 0. An empty table has no rows. Only
the named columns are read.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innkeep.llm.bpe import spread
from innkeep.llm.common import MIX, chunks, fold, key_words, small_batches, staged, utf8

#: A term: letters A-Z in either case and all characters beyond ASCII (as bytes of UTF-8).
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Documents of the language that a kept term is in, at least.
LEAST_DOCUMENTS = 30
#: Bytes of the prefixes of the first level; each level doubles them.
FIRST_BYTES = 6
#: The filter has 2**FILTER_BITS bits (16 MB), in rows of 2**ROW_BITS.
FILTER_BITS, ROW_BITS = 27, 15
#: Rows that a task holds before it sums them.
HELD_ROWS = 1 << 19
#: Cells of the table of sources by terms that are worked on together, and at least as many times the pairs of sources.
CELLS, CELLS_A_PAIR = 1 << 15, 4
#: Best terms of a source that are listed.
TOP_TERMS = 50
#: Frequencies are in billionths, with five occurrences added to each kept term.
SCALE, ADDED = 1_000_000_000, 5
OPEN, COMPLETE = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


# ---------------------------------------------------------------- terms of documents
def document_terms(docs: DataFrame) -> DataFrame:
    """lang, source, the different ``terms`` of each document in byte order and how often each occurs (``times``).

    Both are one value a document: the terms with spaces between, which no term holds, and 64-bit integers in a row.
    """
    small_batches(docs.sparkSession)
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for part in chunks(batch.column(2)):
                data, at = utf8(part)
                raw, at = data.tobytes().translate(_LOWER), at.tolist()
                found = [sorted(Counter(TERM.findall(raw, i, j)).items()) for i, j in zip(at[:-1], at[1:], strict=True)]
                terms = pa.array([b" ".join([t for t, _ in own]) for own in found], pa.binary())
                times = pa.array([array("q", [n for _, n in own]).tobytes() for own in found], pa.binary())
                kept = [batch.column(k).slice(first, len(part)) for k in (0, 1)]
                first += len(part)
                yield pa.RecordBatch.from_arrays([*kept, terms, times], names=["lang", "source", "terms", "times"])
        pa.default_memory_pool().release_unused()

    return docs.select(*columns).mapInArrow(run, "lang string, source string, terms binary, times binary")


class Terms:
    """The terms of a batch of documents in a row, with hashes of their beginnings."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.data, at = utf8(batch.column("terms"))
        self.times = np.frombuffer(utf8(batch.column("times"))[0].tobytes(), np.int64)
        gaps, full = np.flatnonzero(self.data == 0x20), at[1:] > at[:-1]
        self.start = np.sort(np.concatenate([at[:-1][full], gaps + 1]))
        self.size = np.sort(np.concatenate([at[1:][full], gaps])) - self.start
        self.row = np.searchsorted(at, self.start, side="right") - 1
        salt = np.array([xxhash.xxh3_64_intdigest(x) for x in batch.column("lang").to_pylist()], np.uint64)
        self.salt = salt[self.row]

    def texts(self, which: np.ndarray) -> pa.Array:
        n = self.size[which]
        data, ends = self.data[spread(self.start[which], n)], np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        return pa.Array.from_buffers(pa.string(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])

    def key(self, which: np.ndarray, length: int, kind: np.uint64) -> np.ndarray:
        """A hash of language, kind and up to ``length`` bytes of the terms."""
        n = np.minimum(self.size[which], length)
        out = np.zeros(len(which), np.uint64)
        low = 0
        while low < length:  # terms of about the same length together
            high = min(length, max(8, 2 * low))
            own = np.flatnonzero((n > low) & (n <= high))
            if len(own):
                out[own] = fold(key_words(self.data, self.start[which][own], n[own], high), n[own])
            low = high
        out = (out ^ self.salt[which]) * MIX
        return (out ^ (out >> np.uint64(29)) ^ kind) * MIX

    def passed(self, level: int, bits: np.ndarray | None) -> np.ndarray:
        """Terms longer than the level before whose prefix there stayed."""
        if level == FIRST_BYTES:
            return np.arange(len(self.size))
        which = np.flatnonzero(self.size > level // 2)
        return which[_is_set(bits, self.key(which, level // 2, OPEN))]


def _is_set(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys >> np.uint64(1)) & np.uint64(8 * len(bits) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _sum_by_key(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


# ---------------------------------------------------------------- levels
def _level(documents: DataFrame, level: int, sent) -> list:
    """Rows of the filter with the prefixes of ``level`` bytes and the shorter terms that enough documents hold."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value if sent else None
        keys, counts = [], []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            return _sum_by_key(np.concatenate(keys), np.concatenate(counts))

        def out(k: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], names=["key", "n"])

        for batch in batches:
            held = Terms(batch)
            which = held.passed(level, bits)
            ends = held.size[which] <= level
            done = held.key(which[ends], level, COMPLETE)
            which = which[~ends]
            longer, row = held.key(which, level, OPEN), held.row[which]
            # a document counts once for each of its prefixes; its terms stand in order, so equal prefixes are neighbours
            new = np.ones(len(longer), bool)
            new[1:] = (longer[1:] != longer[:-1]) | (row[1:] != row[:-1])
            # the lowest bit of a key tells open prefixes from complete terms
            for k, kind in ((done & ~np.uint64(1), 0), (longer[new] | np.uint64(1), 1)):
                if len(k):
                    keys.append(k)
                    counts.append(np.ones(len(k), np.int64))
            if sum(map(len, keys)) > HELD_ROWS:
                k, n = summed()
                keys, counts = [k], [n]
                if len(k) > HELD_ROWS // 2:
                    yield out(k, n)
                    keys, counts = [], []
        if keys:
            yield out(*summed())

    found = documents.select("lang", "terms", "times").mapInArrow(count, "key long, n long")
    kept = found.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCUMENTS)
    at = F.shiftrightunsigned("key", 1).bitwiseAND((1 << FILTER_BITS) - 1)
    row, place = F.shiftright(at, ROW_BITS).alias("row"), at.bitwiseAND((1 << ROW_BITS) - 1)
    rows = kept.groupBy(row).agg(F.bitmap_construct_agg(place).alias("bits"), F.max(F.col("key").bitwiseAND(1)).alias("open"))
    return rows.collect()  # at most 2**(FILTER_BITS - ROW_BITS) rows of 4 KB


def frequent_filter(documents: DataFrame):
    """A broadcast filter (bits) that all complete terms in enough documents pass, and the levels that were needed."""
    sc = documents.sparkSession.sparkContext
    bits, sent, level = np.zeros(1 << FILTER_BITS - 3, np.uint8), None, FIRST_BYTES
    levels = []
    while True:
        rows = _level(documents, level, sent)
        levels.append(level)
        for r in rows:
            at = r["row"] << ROW_BITS - 3
            bits[at : at + len(r["bits"])] |= np.frombuffer(r["bits"], np.uint8)
        if sent:
            sent.unpersist()
        sent = sc.broadcast(bits)
        if not any(r["open"] for r in rows):
            return sent, levels
        level *= 2


def _counted(documents: DataFrame, sent, levels: list[int]) -> DataFrame:
    """lang, source, term, documents and occurrences of the terms that pass the filter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def summed() -> pa.Table:
            by = pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate([("n_docs", "sum"), ("n", "sum")])
            return by.rename_columns(["lang", "source", "term", "n_docs", "n"])

        for batch in batches:
            own = Terms(batch)
            keep = np.zeros(len(own.size), bool)
            for level in levels:  # each term at the level that it was complete at
                which = np.flatnonzero((own.size <= level) & (own.size > (level // 2 if level > FIRST_BYTES else 0)))
                keep[which] = _is_set(sent.value, own.key(which, level, COMPLETE) & ~np.uint64(1))
            at, row = np.flatnonzero(keep), pa.array(own.row[keep])
            held.append(pa.table({
                "lang": batch.column("lang").take(row), "source": batch.column("source").take(row), "term": own.texts(at),
                "n_docs": pa.array(np.ones(len(at), np.int64)), "n": pa.array(own.times[at]),
            }))
            rows += len(at)
            if rows > HELD_ROWS:
                held = [summed()]
                rows = held[0].num_rows
                if rows > HELD_ROWS // 2:
                    yield from held[0].to_batches(max_chunksize=10_000)
                    held, rows = [], 0
        if held:
            yield from summed().to_batches(max_chunksize=10_000)
        pa.default_memory_pool().release_unused()

    found = documents.mapInArrow(count, "lang string, source string, term string, n_docs long, n long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"))


def kept_terms(documents: DataFrame) -> DataFrame:
    """lang, source, term, n, n_lang: occurrences of the kept terms in each source that has them and in the language."""
    sent, levels = frequent_filter(documents)
    counted = staged(_counted(documents, sent, levels), "counted")
    sent.unpersist()
    totals = counted.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n_lang"))
    return counted.drop("n_docs").join(totals.where(F.col("n_docs") >= LEAST_DOCUMENTS).drop("n_docs"), ["lang", "term"])


# ---------------------------------------------------------------- divergence
def _share(count: Column, total: Column, terms: Column) -> Column:
    """One more than the billionths (rounded down) that a term has of a group, exactly."""
    exact = lambda c: c.cast("decimal(19,0)")
    up = F.lit(SCALE).cast("decimal(10,0)") * exact(count + ADDED)
    down = exact(total + ADDED * terms)
    # the remainder goes first, so the quotient is whole
    return ((up - up % down) / down).cast("decimal(20,0)").cast("long") + 1


def _pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value: for each two sources of a language the summed differences of their shares."""
    cells = F.greatest(F.lit(CELLS), F.col("n_sources") * F.col("n_sources") * CELLS_A_PAIR)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n_terms") * F.col("n_sources") / cells)).cast("int").alias("blocks")
    groups = groups.select("lang", "source", "n_group", "n_terms", blocks)
    none = F.when(F.col("n_terms") > 0, _share(F.lit(0).cast("long"), F.col("n_group"), F.col("n_terms"))).otherwise(0).cast("long")
    base = groups.select("lang", "source", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("string").alias("term"), none.alias("p"))
    own = terms.join(groups.select("lang", "source", "blocks"), ["lang", "source"])
    own = own.select("lang", "source", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "term", "p")

    def block_of(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        none = pc.is_null(rows["term"])
        start, rest = rows.filter(none).sort_by("source"), rows.filter(pc.invert(none))
        sources = start["source"].combine_chunks()
        term = pc.dictionary_encode(rest["term"]).combine_chunks()
        table = np.repeat(start["p"].to_numpy()[:, None], len(term.dictionary), axis=1)
        table[pc.index_in(rest["source"], value_set=sources).to_numpy(), term.indices.to_numpy()] = rest["p"].to_numpy()
        left, right = np.triu_indices(len(sources), 1)
        value = [np.abs(table[i + 1 :] - table[i]).sum(axis=1) for i in range(len(sources) - 1)]
        return pa.table({
            "lang": pa.array([rows["lang"][0].as_py()] * len(left), pa.string()), "source": sources.take(pa.array(left)), "item": sources.take(pa.array(right)),
            "value": pa.array(np.concatenate(value) if value else [], pa.int64()),
        })

    found = base.unionByName(own).groupBy("lang", "block").applyInArrow(block_of, "lang string, source string, item string, value long")
    found = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return found.unionByName(found.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` (all other sources) and ``term`` (the terms used most beyond the language)."""
    documents = staged(document_terms(docs), "document-terms")
    terms = staged(kept_terms(documents), "kept-terms")
    languages = terms.groupBy("lang", "term").agg(F.max("n_lang").alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("n").alias("n_lang_all"))
    groups = documents.select("lang", "source").distinct()
    groups = groups.join(terms.groupBy("lang", "source").agg(F.sum("n").alias("n_group")), ["lang", "source"], "left").join(languages, "lang", "left")
    groups = staged(groups.fillna(0, ["n_group", "n_terms", "n_lang_all"]), "groups")
    sized = groups.join(groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources")), "lang")
    terms = terms.join(groups, ["lang", "source"])
    terms = terms.withColumn("p", _share(F.col("n"), F.col("n_group"), F.col("n_terms")))
    beyond = terms.withColumn("value", F.col("p") - _share(F.col("n_lang"), F.col("n_lang_all"), F.col("n_terms"))).where("value > 0")
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = beyond.select("lang", "source", F.col("term").alias("item"), "value").withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= TOP_TERMS)
    pairs = _pairs(terms.select("lang", "source", "term", "p"), sized).withColumn("rank", F.row_number().over(by))
    parts = (pairs.withColumn("part", F.lit("pair")), best.withColumn("part", F.lit("term")))
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")
