"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves, for a whole
batch of pre-tokens at once, those that are vocabulary entries. Tier two: the
rest are merged with a heap of candidate pairs over linked bytes.

Pre-tokens are the matches of the usual byte-level BPE pattern. The pattern
splits text into runs of letters, numbers, other signs and white space, so the
cuts are computed on whole batches from the class of each code point.

Defined results: a null text encodes as an empty text (no ids) and decodes to
no bytes. Repeated rows give equal results. Other columns pass through; an
input column named like an output is replaced.
"""

from __future__ import annotations

import base64
import heapq
import struct
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.llm.common import MIX as _MIX
from innkeep.llm.common import MIX2 as _MIX2
from innkeep.llm.common import chunks, fold, give_back, key_words, small_batches, utf8, with_arrow

#: Merged pre-tokens in each of the two generations that a worker remembers (about 200 bytes each).
MEMO_ENTRIES = 50_000
#: Bytes of text that are encoded at a time: measured, a worker held 15 to 18 MB less than with 512 KB, in no more time.
ENCODE_BYTES = 128 << 10
#: Largest vocabulary file that is broadcast (public vocabularies have under 10 MB).
MAX_VOCABULARY_BYTES = 64 << 20

SPACE, LETTER, NUMBER, OTHER = range(4)
#: The endings after an apostrophe that are pre-tokens of their own.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


# ---------------------------------------------------------------- pre-tokens
@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    at = np.concatenate([np.arange(0xD800, dtype="<u4"), np.arange(0xE000, 0x110000, dtype="<u4")])  # without surrogates
    every = at.tobytes().decode("utf-32-le")
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            out[at[m.start() : m.end()]] = kind
    return out


def pretoken_starts(points: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin. points: the code points of texts in a row; doc_starts: where each begins."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = char_classes()[points]
    first = np.zeros(n + 1, bool)
    first[doc_starts] = True
    first[n] = True
    same = np.zeros(n, bool)  # as the character before, within a text
    same[1:] = kind[1:] == kind[:-1]
    same &= ~first[:n]
    start = ~same
    white = kind == SPACE
    # the last white character before a sign is no part of the run before it
    before_sign = np.zeros(n, bool)
    before_sign[:-1] = white[:-1] & ~white[1:]
    before_sign &= ~first[1:]
    start |= before_sign
    # and if it is a plain space, it begins the next pre-token
    plain = before_sign & (points == 0x20)
    joined = np.zeros(n, bool)
    joined[1:] = plain[:-1]
    start &= ~joined
    # an apostrophe that begins a run of signs, with one of the endings
    for i in np.flatnonzero((points == 0x27) & start):
        rest = points[i + 1 : i + 3]
        stop = np.flatnonzero(first[i + 1 : i + 3])
        rest = rest[: stop[0]] if len(stop) else rest
        tail = "".join(map(chr, rest))
        if ending := next((e for e in ENDINGS if tail.startswith(e)), None):
            j = i + 1 + len(ending)
            start[i + 1] = False
            if j < n:
                start[j] = start[j] or (kind[j] == LETTER and not joined[j])
    return np.flatnonzero(start)


# ---------------------------------------------------------------- tier one
@dataclass
class Vocabulary:
    """The minimal perfect hash, what verifies a hit, the merge ranks and the bytes of each id."""

    displacement: np.ndarray  # by bucket; -1-slot for a bucket of one key
    key_words: np.ndarray  # by slot: the key, eight bytes a column
    key_len: np.ndarray
    key_id: np.ndarray
    ranks: dict[bytes, int]
    flat: np.ndarray  # bytes of all ids in a row
    flat_at: np.ndarray
    pairs: list[int]
    key: int  # tells vocabularies apart in a worker

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a rank file: base64 of the token and its rank on each line."""
        with open(path, "rb") as f:
            content = f.read(MAX_VOCABULARY_BYTES + 1)
        if len(content) > MAX_VOCABULARY_BYTES:
            raise ValueError(f"{path}: over {MAX_VOCABULARY_BYTES} bytes, too large to broadcast")
        return cls.build({base64.b64decode(t): int(r) for t, r in map(bytes.split, content.splitlines())})

    @classmethod
    def build(cls, ranks: dict[bytes, int]) -> Vocabulary:
        keys = list(ranks)
        n = len(keys)
        data = np.frombuffer(b"".join(keys), np.uint8)
        lens = np.array([len(k) for k in keys], np.int64)
        starts = np.cumsum(lens) - lens
        longest = int(lens.max())
        words = key_words(data, starts, lens, longest)
        h = fold(words, lens)
        buckets = max(1, n // 4)
        slot_of, displacement = _displace(h, n, buckets)
        order = np.argsort(slot_of)
        ids = np.array([ranks[k] for k in keys], np.int64)
        by_id = {r: k for k, r in ranks.items()}
        table = [by_id.get(i, b"") for i in range(int(ids.max()) + 1)]
        sizes = np.array([len(t) for t in table], np.int64)
        return cls(
            displacement, words[order], lens[order].astype(np.int32), ids[order].astype(np.int32), ranks,
            np.frombuffer(b"".join(table), np.uint8), np.concatenate([[0], np.cumsum(sizes)]),
            [ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)], int(np.bitwise_xor.reduce(h)),
        )

    def find(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The id of each pre-token, -1 where it is not in the vocabulary; and a hash of each."""
        found = np.full(len(starts), -1, np.int32)
        hashes = np.zeros(len(starts), np.uint64)
        width = self.key_words.shape[1]
        for low in range(0, width):  # pre-tokens of as many eight-byte words together
            own = np.flatnonzero((lens > 8 * low) & (lens <= 8 * (low + 1)))
            if not len(own):
                continue
            words = key_words(data, starts[own], lens[own], 8 * (low + 1))
            h = hashes[own] = fold(words, lens[own])
            d = self.displacement[_bucket(h, len(self.displacement))]
            slot = np.where(d < 0, -1 - d, _place(h, d, len(self.key_id)))
            ok = self.key_len[slot] == lens[own]
            for j in range(low + 1):
                ok &= self.key_words[slot, j] == words[:, j]
            found[own[ok]] = self.key_id[slot[ok]]
        return found, hashes


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _place(h: np.ndarray, displacement: np.ndarray, slots: int) -> np.ndarray:
    """The slot of a hash under its bucket's displacement."""
    x = (h + displacement.astype(np.uint64) * _MIX) * _MIX2
    x ^= x >> np.uint64(31)
    return ((x * _MIX >> np.uint64(24)) % np.uint64(slots)).astype(np.int64)


def _displace(h: np.ndarray, slots: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and displace: for each bucket, largest first, the number that puts its keys on free slots."""
    if len(np.unique(h)) != len(h):
        raise ValueError("two vocabulary entries have the same 64-bit hash")
    bucket = _bucket(h, buckets)
    order = np.argsort(bucket, kind="stable")
    counts = np.bincount(bucket, minlength=buckets)
    ends = np.cumsum(counts)
    taken = np.zeros(slots, bool)
    slot_of = np.empty(len(h), np.int64)
    displacement = np.zeros(buckets, np.int64)
    tries = np.arange(64)[:, None]
    for k in np.argsort(-counts, kind="stable"):
        own = order[ends[k] - counts[k] : ends[k]]
        if len(own) < 2:
            break
        base = 0
        while True:
            places = np.sort(_place(h[own][None, :], base + tries, slots), axis=1)
            free = ~taken[places].any(axis=1) & (places[:, 1:] != places[:, :-1]).all(axis=1)
            if free.any():
                t = base + int(np.argmax(free))
                displacement[k] = t
                slot_of[own] = _place(h[own], np.array(t), slots)
                taken[slot_of[own]] = True
                break
            base += len(tries)
            if base > 1 << 22:
                raise ValueError("no displacement found")
    left = iter(np.flatnonzero(~taken))
    for k in np.flatnonzero(counts == 1):
        slot = int(next(left))
        displacement[k] = -1 - slot
        slot_of[order[ends[k] - 1]] = slot
    return slot_of, displacement


# ---------------------------------------------------------------- tier two
def merge_bytes(piece: bytes, ranks: dict[bytes, int], pairs: list[int]) -> list[int]:
    """Merge the pair of lowest rank, leftmost first, until none is left: a heap over linked parts.

    pairs: the rank of two bytes at 256 * first + second, -1 for none.
    """
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins here; 0: merged into the part before
    before = list(range(-1, n - 1))
    get = ranks.get
    heap = [(r, i, i + 2) for i, (a, b) in enumerate(zip(piece, piece[1:])) if (r := pairs[a << 8 | b]) >= 0]  # noqa: B905
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        _, i, stop = pop(heap)
        j = end[i]
        if not j or j >= stop or end[j] != stop:
            continue  # one of its parts has grown since
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := get(piece[i : end[stop]])) is not None:
                push(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := get(piece[p:stop])) is not None:
            push(heap, (r, p, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class Memo:
    """What the heap made of recent pre-tokens, in two generations of bounded size."""

    def __init__(self) -> None:
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, piece: bytes, vocabulary: Vocabulary) -> bytes:
        if (found := self.new.get(piece)) is not None:
            return found
        if (found := self.old.get(piece)) is None:
            merged = merge_bytes(piece, vocabulary.ranks, vocabulary.pairs)
            found = struct.pack(f"<{len(merged)}i", *merged)
            if len(piece) > 64:
                return found
        if len(self.new) >= MEMO_ENTRIES:
            self.new, self.old = {}, self.new
        self.new[piece] = found
        return found


_memos: dict[int, Memo] = {}  # by vocabulary


def encode_batch(texts: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and where each text's ids begin (one more at the end)."""
    data, at = utf8(texts)
    rows = len(texts)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    if not len(points):
        return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64)
    size = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    byte_at = np.concatenate([[0], np.cumsum(size)])
    doc_points = np.searchsorted(byte_at, at)
    cut = pretoken_starts(points, doc_points[:-1][doc_points[:-1] < len(points)])
    starts = byte_at[cut]
    lens = np.diff(np.concatenate([starts, [len(data)]]))
    ids, hashes = vocabulary.find(data, starts, lens)
    missing = np.flatnonzero(ids < 0)
    counts = np.ones(len(cut), np.int64)
    if len(missing):
        merged, which = _merge_missing(data, starts, lens, hashes, missing, vocabulary)
        sizes = np.array([len(m) // 4 for m in merged], np.int64)
        counts[missing] = sizes[which]
    ends = np.cumsum(counts)
    flat = np.empty(int(ends[-1]), np.int32)
    flat[(ends - counts)[counts == 1]] = ids[counts == 1]
    if len(missing):
        pool = np.frombuffer(b"".join(merged), "<i4")
        pool_at = np.cumsum(sizes) - sizes
        n = counts[missing]
        flat[spread(ends[missing] - n, n)] = pool[spread(pool_at[which], n)]
    token_at = np.concatenate([[0], ends])[np.searchsorted(starts, at)]
    return flat, token_at


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... n[i] of them, for each i in a row."""
    total = int(n.sum())
    return np.arange(total) + np.repeat(first - (np.cumsum(n) - n), n)


def _merge_missing(data, starts, lens, hashes, missing, vocabulary):
    """Ids of the different pre-tokens that tier one misses, and for each occurrence which it is."""
    raw = data.tobytes()
    long = lens[missing] > 8 * vocabulary.key_words.shape[1]  # they have no hash
    key = hashes[missing].copy()
    key[long] = [np.uint64(hash(raw[starts[m] : starts[m] + lens[m]]) & 0xFFFFFFFFFFFFFFFF) for m in missing[long]]
    _, one, which = np.unique(key, return_index=True, return_inverse=True)
    # equal hashes must be equal bytes: compare the ends and the lengths with the first occurrence, else take each by itself
    rep = missing[one][which]
    same = (lens[rep] == lens[missing]) & (data[starts[rep]] == data[starts[missing]])
    same &= data[starts[rep] + lens[rep] - 1] == data[starts[missing] + lens[missing] - 1]
    if not same.all():
        one, which = np.arange(len(missing)), np.arange(len(missing))
    memo = _memos.setdefault(vocabulary.key, Memo())
    out = [memo.ids(raw[i:j], vocabulary) for i, j in zip(starts[missing[one]].tolist(), (starts + lens)[missing[one]].tolist(), strict=True)]
    return out, which


def decode_batch(ids: np.ndarray, token_at: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all id lists in a row, and where each list's bytes begin."""
    first = vocabulary.flat_at[ids]
    n = vocabulary.flat_at[ids + 1] - first
    return vocabulary.flat[spread(first, n)], np.concatenate([[0], np.cumsum(n)])[token_at]


# ---------------------------------------------------------------- on Spark
def _binary(data: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def broadcast_vocabulary(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(Vocabulary.load(path))


def encode(docs: DataFrame, vocabulary, text_col: str = "text", arrays: bool = False) -> DataFrame:
    """Add ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers in a row); arrays: and ``token_ids``, an array of integers."""

    def compute(texts: pa.Array) -> dict[str, pa.Array]:
        flat, at = encode_batch(texts, vocabulary.value)
        return {
            "n_tokens": pa.array(np.diff(at), pa.int64()),
            "ids": _binary(flat.astype("<u4"), at * 4),
            "token_ids": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32())),
        }

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    if arrays:
        fields.append(T.StructField("token_ids", T.ArrayType(T.IntegerType())))
    return with_arrow(docs, text_col, fields, compute, ENCODE_BYTES)


def round_trip(docs: DataFrame, vocabulary, text_col: str = "text") -> DataFrame:
    """The columns of decode(encode(docs, arrays=True)), made by one Python worker for each task instead of two.

    Each worker holds the libraries, the vocabulary and the memo (about 100 MB), and Spark keeps as many as were ever busy at once.
    """

    def compute(texts: pa.Array) -> dict[str, pa.Array]:
        flat, at = encode_batch(texts, vocabulary.value)
        out, out_at = decode_batch(flat.astype("<u4").astype(np.int64), at, vocabulary.value)
        return {
            "n_tokens": pa.array(np.diff(at), pa.int64()),
            "token_ids": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32())),
            "decoded": _binary(out, out_at),
        }

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]
    return with_arrow(docs.drop("ids"), text_col, fields, compute, ENCODE_BYTES)


def decode(encoded: DataFrame, vocabulary, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The other columns and ``decoded``: the bytes that the ids stand for; the ids column goes. Null ids: no bytes."""
    small_batches(encoded.sparkSession)
    kept = [c for c in encoded.columns if c not in (ids_col, out_col)]
    schema = T.StructType([*(encoded.schema[c] for c in kept), T.StructField(out_col, T.BinaryType())])

    def parts(batch):
        first = 0
        for part in chunks(batch.column(len(kept)), ENCODE_BYTES):
            data, at = utf8(part)
            out, out_at = decode_batch(np.frombuffer(data.tobytes(), "<u4").astype(np.int64), at // 4, vocabulary.value)
            columns = [batch.column(i).slice(first, len(part)) for i in range(len(kept))]
            first += len(part)
            yield pa.RecordBatch.from_arrays([*columns, _binary(out, out_at)], names=[f.name for f in schema.fields])

    def run(batches):
        for batch in batches:
            yield from parts(batch)
            batch = None
            give_back()

    return encoded.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(f"`{ids_col}`"), F.lit(b"")).alias(ids_col)).mapInArrow(run, schema)
