"""Text scores from a bigram model by deleted interpolation.

P(w | v) = a * c(v w) / c(v) + b * c(w) / N + g / (V + 1), with weights by the
bucket of the context's count. The weights are learned by expectation-
maximisation on held-out events: the tokens of a fixed part of the learning
documents, each taken out of the counts it is judged by.

Counting is exact and spread by hash ranges. Documents are packed in chunks
(token streams over the chunk's own word list). Each chunk asks each hash
range once for the words and bigrams it has, in one compressed list with its
own counts; a range's task adds up the lists and answers each with the totals.
So a frequent word is one entry a chunk, whatever its share of the tokens.

Defined results: a null text is empty and has one token, the end. Without
learning documents every count is 0 and all words have the base's share of an
unknown word. Rows with equal ids are scored each by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.llm.common import MIX, MIX2, chunks, small_batches, staged, utf8, word_hashes

CHUNK_BYTES = 8 << 20
#: Learning text, in tokens, that one hash range's task adds up.
RANGE_TOKENS = 1_250_000
WORD_BITS, BIGRAM_BITS = 63, 56
#: Of the learning documents, those with this hash remainder are the held-out part for the weights.
HELD_OUT_MOD, HELD_OUT_REST = 6, 1
START, END = np.uint64(1), np.uint64(2)
#: Steps in which the held-out events' shares are counted: 16 a power of two.
STEPS = 16
ZERO = -100_000
BUCKETS = 48
ROUNDS = 100

WORDS, BIGRAMS = 0, 1


# ---------------------------------------------------------------- packed lists
def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def pack(values: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed."""
    return _zip(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


# ---------------------------------------------------------------- chunks
def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts in a row with an end after each, and each text's number of tokens."""
    data, at = utf8(texts)
    words, first = word_hashes(data, at) if len(data) else (np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
    words = words >> np.uint64(64 - WORD_BITS) | np.uint64(4)  # apart from start and end
    n = np.diff(first)
    out = np.full(len(words) + len(texts), END, np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(len(texts)), n)] = words
    return out, n + 1


def bigram_hashes(words: np.ndarray, before: np.ndarray) -> np.ndarray:
    x = (before * MIX ^ words) * MIX2
    x ^= x >> np.uint64(31)
    return x * MIX >> np.uint64(64 - BIGRAM_BITS)


def packed_chunks(docs: DataFrame, id_col: str, text_col: str, learn: Column) -> DataFrame:
    """One row a chunk: its documents' ids and sizes, its word list and its token stream."""
    part = F.when(~F.coalesce(learn, F.lit(False)), 0).when(F.pmod(F.xxhash64(text_col), F.lit(HELD_OUT_MOD)) == HELD_OUT_REST, 2).otherwise(1)
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), part.cast("int").alias("part"))
    schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()), T.StructField("held", T.BooleanType()), T.StructField("n", T.LongType()), T.StructField("learned", T.LongType()),
            T.StructField("ids", T.ArrayType(source.schema["id"].dataType)), T.StructField("learns", T.ArrayType(T.BooleanType())),
            T.StructField("sizes", T.BinaryType()), T.StructField("words", T.BinaryType()), T.StructField("tokens", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[bool, list] = {False: [], True: []}
        weight = {False: 0, True: 0}

        def flush(held: bool) -> pa.RecordBatch:
            nonlocal number
            parts = waiting[held]
            waiting[held], weight[held] = [], 0
            ids = pa.concat_arrays([p[0] for p in parts])
            learns = np.concatenate([p[1] for p in parts])
            tokens = np.concatenate([p[2] for p in parts])
            sizes = np.concatenate([p[3] for p in parts])
            words, which = np.unique(tokens, return_inverse=True)
            number += 1
            one = lambda value, kind: pa.array([value], kind)
            listed = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
            return pa.RecordBatch.from_arrays(
                [
                    one(number, pa.int64()), one(held, pa.bool_()), one(len(tokens), pa.int64()), one(int(sizes[learns].sum()), pa.int64()), listed(ids),
                    listed(pa.array(learns)), one(pack(sizes), pa.binary()), one(pack_sorted(words), pa.binary()), one(pack(which), pa.binary()),
                ],
                names=[f.name for f in schema.fields],
            )

        for batch in batches:
            parts = batch.column(2).to_numpy()
            for held in (False, True):
                own = batch.filter(pa.array((parts == 2) == held))
                first = 0
                for texts in chunks(own.column(1), CHUNK_BYTES // 4):
                    tokens, sizes = tokens_of(texts)
                    rows = own.slice(first, len(texts))
                    first += len(texts)
                    waiting[held].append((rows.column(0), rows.column(2).to_numpy() > 0, tokens, sizes))
                    weight[held] += int(utf8(texts)[1][-1]) + len(texts)
                    if weight[held] >= CHUNK_BYTES:
                        yield flush(held)
        for held in (False, True):
            if waiting[held]:
                yield flush(held)

    return source.mapInArrow(run, schema)


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple[int, dict]]:
    """The rows of a batch of chunks, one at a time: a chunk has megabytes, and a batch may hold a partition's."""
    for i in range(batch.num_rows):
        yield i, batch.slice(i, 1).to_pylist()[0]
    pa.default_memory_pool().release_unused()


@dataclass
class Chunk:
    """A chunk's tokens as places in its sorted lists of words and bigrams."""

    sizes: np.ndarray
    words: np.ndarray
    tokens: np.ndarray  # places in words
    before: np.ndarray  # likewise; -1 at a document's start
    bigrams: np.ndarray
    pairs: np.ndarray  # places in bigrams

    @classmethod
    def read(cls, sizes: bytes, words: bytes, tokens: bytes) -> Chunk:
        sizes, words, tokens = unpack(sizes).astype(np.int64), unpack_sorted(words), unpack(tokens).astype(np.int64)
        before = np.concatenate([[-1], tokens[:-1]])
        before[np.cumsum(sizes) - sizes] = -1
        pair = bigram_hashes(words[tokens], np.where(before < 0, START, words[before]))
        bigrams, pairs = np.unique(pair, return_inverse=True)
        return cls(sizes, words, tokens, before, bigrams, pairs)


# ---------------------------------------------------------------- counts
def requests(packed: DataFrame, ranges_log2: int) -> DataFrame:
    """(kind, range, chunk, hashes, counts): a chunk's words and bigrams in each hash range, and how often its learning documents have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, row in rows_of(batch):
                chunk = Chunk.read(row["sizes"], row["words"], row["tokens"])
                weight = np.repeat(np.array(row["learns"], bool), chunk.sizes).astype(np.float64)
                out = []
                for kind, bits, hashes, which in ((WORDS, WORD_BITS, chunk.words, chunk.tokens), (BIGRAMS, BIGRAM_BITS, chunk.bigrams, chunk.pairs)):
                    counts = np.bincount(which, weight, len(hashes)).astype(np.uint64)
                    cut = np.searchsorted(hashes, np.arange(1, 1 << ranges_log2, dtype=np.uint64) << np.uint64(bits - ranges_log2))
                    edges = [0, *cut.tolist(), len(hashes)]
                    out += [(kind, r, row["chunk"], pack_sorted(hashes[i:j]), pack(counts[i:j])) for r, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if j > i]
                for k in range(0, len(out), 64):
                    yield pa.RecordBatch.from_pylist([dict(zip(names, o, strict=True)) for o in out[k : k + 64]], schema=kinds)

    names = ["kind", "range", "chunk", "hashes", "counts"]
    kinds = pa.schema([("kind", pa.int32()), ("range", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])
    return packed.select("chunk", "learns", "sizes", "words", "tokens").mapInArrow(run, "kind int, range int, chunk long, hashes binary, counts binary")


def answers(asked: DataFrame) -> DataFrame:
    """(kind, range, chunk, counts, different): totals for each request; how many in the range were seen (in one row of a range, else 0)."""

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        lists = [unpack_sorted(h) for h in frame["hashes"]]
        at = np.cumsum([0, *map(len, lists)])
        every = np.concatenate(lists)
        del lists
        which = np.unique(every, return_inverse=True)[1]
        del every
        totals = np.bincount(which, np.concatenate([unpack(c).astype(np.float64) for c in frame["counts"]])).astype(np.uint64)
        seen = int((totals > 0).sum())
        return pd.DataFrame(
            {
                "kind": frame["kind"], "range": frame["range"], "chunk": frame["chunk"],
                "counts": [pack(totals[which[i:j]]) for i, j in zip(at[:-1], at[1:], strict=True)],
                "different": [seen] + [0] * (len(frame) - 1),
            }
        )

    return asked.groupBy("kind", "range").applyInPandas(total, "kind int, range int, chunk long, counts binary, different long")


# ---------------------------------------------------------------- weights
def bucket(count: np.ndarray) -> np.ndarray:
    """0 for 0, else 1 + the whole part of log2."""
    return np.where(count > 0, 1 + np.floor(np.log2(np.maximum(count, 1))), 0).astype(np.int64).clip(0, BUCKETS - 1)


def learn_weights(cells: np.ndarray, v: int) -> np.ndarray:
    """Weights by bucket from rows (bucket, step of the bigram's share, step of the word's share, events)."""
    weights = np.tile([0.4, 0.5, 0.1], (BUCKETS, 1))
    weights[0] = [0.0, 0.9, 0.1]
    for b in range(BUCKETS):
        own = cells[cells[:, 0] == b]
        if not len(own):
            if b > 1:
                weights[b] = weights[b - 1]
            continue
        n = own[:, 3].astype(float)
        share = lambda q: np.where(q == ZERO, 0.0, np.exp2(q / STEPS))
        p = np.stack([share(own[:, 1]), share(own[:, 2]), np.full(len(own), 1.0 / (v + 1))])
        w = weights[b].copy()
        for _ in range(ROUNDS):
            mixed = w[:, None] * p
            w = (mixed / mixed.sum(axis=0) * n).sum(axis=1) / n.sum()
        w[2] = max(w[2], 1e-9)  # an unknown word keeps a share
        weights[b] = w / w.sum()
    return weights


def _steps(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.round(STEPS * np.log2(np.maximum(p, 1e-300))), ZERO).astype(np.int64)


# ---------------------------------------------------------------- scores
def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: the id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    learn: which documents the counts and weights are learned from.
    """
    small_batches(docs.sparkSession)
    packed = staged(packed_chunks(docs, id_col, text_col, learn), "chunks")
    sums = packed.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("learned"), F.lit(0)), F.sum(F.size("ids")), F.sum(F.aggregate("learns", F.lit(0), lambda a, x: a + x.cast("int")))).first()
    n, starts = int(sums[1]), int(sums[3] or 0)
    ranges = max(0, int(np.ceil(np.log2(max(1, sums[0] / RANGE_TOKENS)))))
    answered = staged(answers(requests(packed, ranges)), "counts")
    v = int(answered.where(F.col("kind") == WORDS).agg(F.coalesce(F.sum("different"), F.lit(0))).first()[0])
    lists = answered.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("kind", "range", "counts"))).alias("totals"))
    ready = packed.join(lists, "chunk")

    def counted(row: dict) -> tuple[Chunk, np.ndarray, np.ndarray, np.ndarray]:
        """The chunk and for each token the counts of its bigram, its context and its word."""
        chunk = Chunk.read(row["sizes"], row["words"], row["tokens"])
        words, pairs = (np.concatenate([unpack(t["counts"]) for t in row["totals"] if t["kind"] == k]).astype(np.int64) for k in (WORDS, BIGRAMS))
        # a document's start is a context that occurs once a learning document
        return chunk, pairs[chunk.pairs], np.where(chunk.before < 0, starts, words[chunk.before]), words[chunk.tokens]

    def events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, row in rows_of(batch):
                _, pair, context, word = counted(row)
                pair, context, word = pair - 1, context - 1, word - 1  # without the event itself
                p2 = np.where(context > 0, pair / np.maximum(context, 1), 0.0)
                rows = np.stack([bucket(context), _steps(p2), _steps(word / max(1, n - 1))], axis=1)
                cells, times = np.unique(rows, axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(cells[:, k]) for k in range(3)), pa.array(times)], names=["b", "p2", "p1", "n"])

    seen = ready.where("held").select("sizes", "words", "tokens", "totals").mapInArrow(events, "b long, p2 long, p1 long, n long")
    # cells are bounded by buckets and steps, whatever the number of events
    cells = seen.groupBy("b", "p2", "p1").agg(F.sum("n").alias("n")).collect()
    weights = learn_weights(np.array([tuple(r) for r in cells], np.int64).reshape(-1, 4), v)
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField(id_col, id_type), *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())]
    )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, row in rows_of(batch.select(["sizes", "words", "tokens", "totals"])):
                chunk, pair, context, word = counted(row)
                at = np.cumsum(chunk.sizes) - chunk.sizes
                w = weights[bucket(context)]
                p = w[:, 0] * (pair / np.maximum(context, 1)) + w[:, 1] * (word / max(1, n)) + w[:, 2] / (v + 1)
                total = lambda x: pa.array(np.add.reduceat(x, at))  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[i].values, pa.array(chunk.sizes), total((word > 0).astype(np.int64)), pa.array(np.full(len(at), n)),
                        total(np.log10((word + 1.0) / (n + 1.0 * (v + 1)))), total(np.log10(p)),
                    ],
                    names=[f.name for f in schema.fields],
                )

    return ready.select("ids", "sizes", "words", "tokens", "totals").mapInArrow(scored, schema)
