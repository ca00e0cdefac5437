"""SentencePiece encoding and decoding for merge-type (BPE) models.

A score-ordered agenda of adjacent symbol pairs joins the pair whose joined
piece scores highest, leftmost first, until no pair is a piece. Where no piece
of the model holds a space mark behind another character, no pair can span
such a place; the text is cut there and each different cut is merged once per
worker and remembered. The short cuts of a batch keep their agendas side by
side in arrays, and each round joins the best pair of every cut; a long cut
has a heap of its own. Equal cuts of a slice of texts are found by their hash,
so a frequent cut is looked up once a slice. Each Arrow batch is also encoded by the
sentencepiece library, and any difference fails the job (``checked``).

Defined results: a null text is an empty text, which has the end id only (if
asked for) and decodes to an empty text. Repeated rows give equal results.
Very long texts are merged in slices at places that no pair can span; a run
without such a place is merged whole. An empty table gives an empty table.
Other columns pass through; an input column named like an output is replaced.
Ids outside the model fail the job in decoding; null ids decode like none.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.llm.bpe import spread
from innkeep.llm.common import MIX, fold, key_words, small_batches, utf8, with_arrow

SPACE_MARK = "▁"
#: The kinds of pieces and the model type in the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE_MODEL = 2
#: Largest model file that is broadcast (public models have under 10 MB).
MAX_MODEL_BYTES = 64 << 20
#: Merged cuts that a worker remembers (about 250 bytes each); longer cuts are not remembered.
MEMO_ENTRIES, MEMO_CHARS = 100_000, 64
#: Cuts that a worker remembers as they are in the text (about 180 bytes each).
RAW_ENTRIES = 600_000
#: Widths of the arrays that hold the symbols of short cuts.
WIDTHS = (4, 6, 8, 9, 10, 11, 12, 14, 16, 20, 24, 32, 64)
#: Short cuts that are merged side by side.
SIDE_BY_SIDE = 20_000
#: Code points that are cut up at a time, and bytes of texts from which each is cut up by itself.
SLICE_CHARS, SLICE_BYTES = 1 << 20, 4 << 20
#: Bytes of text that a worker encodes at a time: equal cuts of a slice are looked up once.
CHUNK_BYTES = 2 << 20


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The numbered fields of a protocol buffer message; nested messages stay bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    """What the agenda and the decoder need of a model file, and the file itself for the library."""

    content: bytes
    pieces: list[str]
    kinds: list[int]
    cost: dict[str, float]  # negated score of the pieces that a merge may make
    ids: dict[str, int]  # of all pieces
    unknown: int
    end: int
    by_byte: list[int]  # id of each byte's piece; empty without byte fallback
    dummy_prefix: bool
    unknown_surface: str
    fixed: re.Pattern | None  # symbols that are never merged nor cut
    unused: frozenset[str]
    cuttable: bool  # no piece holds a space mark behind another character
    memo: Memo = field(init=False, repr=False)
    surfaces: list[bytes] = field(init=False, repr=False)  # what each id decodes to
    controls: set[int] = field(init=False, repr=False)
    cuts: re.Pattern = field(init=False, repr=False)
    is_alone: np.ndarray = field(init=False, repr=False)  # by byte
    boundary: re.Pattern = field(init=False, repr=False)  # a place between two cuts
    pairs: Pairs | None = field(init=False, repr=False)
    flat: np.ndarray = field(init=False, repr=False)  # the bytes that all ids decode to, in a row
    flat_at: np.ndarray = field(init=False, repr=False)
    is_control: np.ndarray = field(init=False, repr=False)
    loses_mark: np.ndarray = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.memo = Memo(self)
        joining = {c for p in self.cost if len(p) > 1 for c in p}
        # control characters in no longer piece are cuts of their own
        alone = "".join(f"\\x{c:02x}" for c in range(32) if chr(c) not in joining)
        self.is_alone = np.array([c < 32 and chr(c) not in joining for c in range(256)])
        self.controls = {i for i, k in enumerate(self.kinds) if k == CONTROL}
        self.surfaces = [self._surface(p, k) for p, k in zip(self.pieces, self.kinds, strict=True)]
        sizes = np.array([len(x) for x in self.surfaces], np.int64)
        self.flat, self.flat_at = np.frombuffer(b"".join(self.surfaces), np.uint8), np.concatenate([[0], np.cumsum(sizes)])
        self.is_control = np.array([k == CONTROL for k in self.kinds])
        marked = [k not in (BYTE, UNKNOWN, CONTROL) and p[:1] == SPACE_MARK for p, k in zip(self.pieces, self.kinds, strict=True)]
        self.loses_mark = np.array(marked) & self.dummy_prefix  # as the first of a text
        self.cuts = re.compile(f"{SPACE_MARK}+[^{SPACE_MARK}{alone}]*|[^{SPACE_MARK}{alone}]+" + (f"|[{alone}]" if alone else ""))
        self.boundary = re.compile(f"[^{SPACE_MARK}]{SPACE_MARK}")
        self.pairs = None if self.unused or self.fixed else Pairs(self)

    @classmethod
    def load(cls, path: str) -> Model:
        with open(path, "rb") as f:
            content = f.read(MAX_MODEL_BYTES + 1)
        if len(content) > MAX_MODEL_BYTES:
            raise ValueError(f"{path}: over {MAX_MODEL_BYTES} bytes, too large to broadcast")
        return cls.parse(content)

    @classmethod
    def parse(cls, content: bytes) -> Model:
        pieces, scores, kinds = [], [], []
        trainer: dict = {}
        normalizer: dict = {}
        for number, value in _fields(content):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
            elif number in (2, 3):
                (trainer if number == 2 else normalizer).update(_fields(value))
        if trainer.get(3, 1) != BPE_MODEL:
            raise ValueError("not a merge-type model")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or trainer.get(24, 0):
            raise ValueError("only models that leave the text as it is, but for marked spaces, are supported")
        ids = {p: i for i, p in enumerate(pieces)}
        named = trainer.get(47, b"</s>").decode()
        merged = {p: -s for p, s, k in zip(pieces, scores, kinds, strict=True) if k in (NORMAL, USER_DEFINED, UNUSED)}
        fixed = sorted((p for p, k in zip(pieces, kinds, strict=True) if k == USER_DEFINED), key=len, reverse=True)
        by_byte = [ids[f"<0x{b:02X}>"] for b in range(256)] if trainer.get(35, 0) else []
        return cls(
            content, pieces, kinds, merged, ids, kinds.index(UNKNOWN), ids.get(named, -1), by_byte,
            bool(normalizer.get(3, 1)), trainer.get(44, b" \xe2\x81\x87 ").decode(),
            re.compile("(" + "|".join(map(re.escape, fixed)) + ")") if fixed else None,
            frozenset(p for p, k in zip(pieces, kinds, strict=True) if k == UNUSED),
            not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in merged),
        )

    def __reduce__(self):
        return Model.parse, (self.content,)

    # ------------------------------------------------------------ encoding
    def merge(self, symbols: str) -> list[str]:
        """The agenda: join the best adjacent pair, leftmost of equals, until none is a piece."""
        n = len(symbols)
        cost, push, pop = self.cost.get, heapq.heappush, heapq.heappop
        stop = list(range(1, n + 1))  # where the symbol that begins here stops; 0: joined to the one before
        before = list(range(-1, n - 1))
        agenda = [(c, i, i + 2) for i in range(n - 1) if (c := cost(symbols[i : i + 2])) is not None]
        heapq.heapify(agenda)
        made: dict[str, tuple[str, str]] = {}  # of which two symbols an unused piece was joined
        if self.unused:
            made.update((symbols[i:end], (symbols[i], symbols[i + 1])) for _, i, end in agenda if symbols[i:end] in self.unused)
        while agenda:
            _, left, end = pop(agenda)
            right = stop[left]
            if not right or right >= end or stop[right] != end:
                continue  # one of its symbols has grown since
            stop[left], stop[right] = end, 0
            if end < n:
                before[end] = left
                if (c := cost(joined := symbols[left : stop[end]])) is not None:
                    push(agenda, (c, left, stop[end]))
                    if joined in self.unused:
                        made[joined] = symbols[left:end], symbols[end : stop[end]]
            if (first := before[left]) >= 0 and (c := cost(joined := symbols[first:end])) is not None:
                push(agenda, (c, first, end))
                if joined in self.unused:
                    made[joined] = symbols[first:left], symbols[left:end]
        out, i = [], 0
        while i < n:
            out.append(symbols[i : stop[i]])
            i = stop[i]
        if made:
            whole, out = out, []
            for piece in whole:
                self._unmake(piece, made, out)
        return out

    def _unmake(self, piece: str, made: dict[str, tuple[str, str]], out: list[str]) -> None:
        if piece in self.unused and piece in made:
            for part in made[piece]:
                self._unmake(part, made, out)
        else:
            out.append(piece)

    def cut_ids(self, cut: str) -> list[int]:
        """Ids of a part of the text that no pair leaves."""
        out: list[int] = []
        for k, part in enumerate(self.fixed.split(cut) if self.fixed else [cut]):
            if k % 2:
                out.append(self.ids[part])
                continue
            merged = self.merge(part)
            found = list(map(self.ids.get, merged))
            if None not in found and self.unknown not in found:
                out += found
                continue
            for piece, i in zip(merged, found, strict=True):
                if i is not None and i != self.unknown:
                    out.append(i)
                elif self.by_byte:
                    out.extend(self.by_byte[b] for b in piece.encode())
                elif not out or out[-1] != self.unknown:
                    out.append(self.unknown)  # a run of unknown symbols is one
        return out

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, without end ids, and where each text's ids begin (one more at the end)."""
        data, at = utf8(texts)
        if not self.cuttable or len(data) >= SLICE_BYTES:
            strings = [t or "" for t in texts.to_pylist()]
            rows = [self._encode_long(t) if self.cuttable else array("i", self.cut_ids(self.marked(t)) if t else ()) for t in strings]
            return np.frombuffer(b"".join(rows), np.int32), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        if self.dummy_prefix:
            full = at[1:] > at[:-1]
            data = np.insert(data, at[:-1][full], 32)
            at = at + np.concatenate([[0], np.cumsum(full)])
        starts = self._cut_starts(data, at)
        lens = np.diff(np.append(starts, len(data)))
        raw = data.tobytes()
        one, which = _different(data, raw, starts, lens)
        found = self.memo.find([raw[i:j] for i, j in zip(starts[one].tolist(), (starts + lens)[one].tolist(), strict=True)])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool_at = np.cumsum(sizes) - sizes
        n = sizes[which]
        flat = np.frombuffer(b"".join(found), np.int32)[spread(pool_at[which], n)]
        return flat, np.concatenate([[0], np.cumsum(n)])[np.searchsorted(starts, at)]

    def _cut_starts(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the cuts of texts in a row begin; a space stands for a space mark."""
        mark = data == 32
        mark[:-2] |= (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
        inner = np.zeros(len(data), bool)  # the other bytes of a space mark
        inner[1:] |= mark[:-1] & (data[:-1] == 0xE2)
        inner[2:] |= mark[:-2] & (data[:-2] == 0xE2)
        alone = self.is_alone[data]
        start = mark.copy()
        start[1:] &= ~(mark | inner)[:-1]
        start |= alone
        start[1:] |= alone[:-1]
        start[at[:-1][at[:-1] < len(data)]] = True
        return np.flatnonzero(start)

    def encode_all(self, texts: list[str]) -> list[array]:
        """Ids of each text, without an end id; the unknown cuts of all short texts are merged together."""
        flat, at = self.encode_batch(pa.array(texts, pa.string()))
        return [array("i", flat[i:j].tobytes()) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]

    def encode(self, text: str) -> array:
        return self.encode_all([text])[0]

    def marked(self, text: str) -> str:
        return SPACE_MARK * self.dummy_prefix + text.replace(" ", SPACE_MARK)

    def _encode_long(self, text: str) -> array:
        out = array("i")
        text = self.marked(text) if text else ""
        at = 0
        while at < len(text):
            end = at + SLICE_CHARS
            if end < len(text):  # go on to the next space mark behind another character
                found = self.boundary.search(text, end - 1)
                end = found.end() - 1 if found else len(text)
            cuts = self.cuts.findall(text, at, end)
            self.memo.fill([c for c in set(cuts) if c not in self.memo])
            out.frombytes(b"".join(map(self.memo.__getitem__, cuts)))
            at = end
        return out

    # ------------------------------------------------------------ decoding
    def _surface(self, piece: str, kind: int) -> bytes:
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return self.unknown_surface.encode()
        return bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(SPACE_MARK, " ").encode()

    def decode_all(self, ids: np.ndarray, at: np.ndarray) -> pa.Array:
        """The texts of lists of ids in a row; at: where each begins (one more at the end)."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.pieces):
            raise ValueError("an id is not in the model")
        rows = len(at) - 1
        before = np.concatenate([[0], np.cumsum(self.is_control[ids])])
        last = np.maximum(at[1:] - 1, at[:-1])
        first = self.flat_at[ids]
        n = self.flat_at[ids + 1] - first
        if (before[last] == before[at[:-1]]).all():  # control ids at the end only
            heads = np.flatnonzero(at[1:] > at[:-1])
            heads = at[heads[self.loses_mark[ids[at[heads]]]]]
            first[heads] += 1
            n[heads] -= 1
            data = self.flat[spread(first, n)]
            try:
                data.tobytes().decode()
            except UnicodeDecodeError:
                pass
            else:
                ends = np.concatenate([[0], np.cumsum(n)])[at].astype(np.int32)
                return pa.Array.from_buffers(pa.string(), rows, [None, pa.py_buffer(ends), pa.py_buffer(data)])
        return pa.array([self.decode(ids[i:j].tolist()) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.string())

    def decode(self, ids: list[int]) -> str:
        """The text that the ids stand for; a byte that is no part of a character becomes U+FFFD."""
        if ids and not 0 <= min(ids) <= max(ids) < len(self.pieces):
            raise ValueError("an id is not in the model")
        surfaces = self.surfaces
        first = next((i for i in ids if surfaces[i]), None)
        marked = first is not None and self.kinds[first] not in (BYTE, UNKNOWN) and self.pieces[first][0] == SPACE_MARK
        skip = int(self.dummy_prefix and marked)
        if not self.controls.isdisjoint(ids[:-1]):  # bytes on both sides of a control id are never one character
            runs = groupby(ids, lambda i: self.kinds[i] == BYTE)
            return "".join(_characters(b"".join(surfaces[i] for i in run)) for _, run in runs)[skip:]
        return _characters(b"".join([surfaces[i] for i in ids]))[skip:]


def _characters(data: bytes) -> str:
    """UTF-8 bytes as text; U+FFFD for each byte that is no part of a character."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(data[at : at + e.start].decode() + "\ufffd")
            at += e.start + 1
    return "".join(out)


def _different(data: np.ndarray, raw: bytes, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An occurrence of each different cut, and for each occurrence which it is."""
    hashes = np.zeros(len(starts), np.uint64)
    for low in range(0, MEMO_CHARS, 8):
        own = np.flatnonzero((lens > low) & (lens <= low + 8))
        if len(own):
            hashes[own] = fold(key_words(data, starts[own], lens[own], low + 8), lens[own])
    long = np.flatnonzero(lens > MEMO_CHARS)
    hashes[long] = [xxhash.xxh3_64_intdigest(raw[starts[i] : starts[i] + lens[i]]) for i in long]
    order = np.argsort(hashes)
    first = np.ones(len(order), bool)
    first[1:] = hashes[order[1:]] != hashes[order[:-1]]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(first) - 1
    one = order[first]
    # equal hashes must be equal bytes: compare the ends and the lengths with the first occurrence, else take each by itself
    rep = one[which]
    same = (lens[rep] == lens) & (data[starts[rep]] == data[starts]) & (data[starts[rep] + lens[rep] - 1] == data[starts + lens - 1])
    return (one, which) if same.all() else (np.arange(len(starts)), np.arange(len(starts)))


class Memo(dict):
    """Packed ids of recent cuts; it is emptied when it is full, as the frequent cuts soon come back."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.raw: dict[bytes, bytes] = {}

    def __missing__(self, cut: str) -> bytes:
        found = array("i", self.model.cut_ids(cut)).tobytes()
        if len(cut) <= MEMO_CHARS and len(self) < MEMO_ENTRIES:
            self[cut] = found
        return found

    def find(self, cuts: list[bytes]) -> list[bytes]:
        """The ids of cuts as they are in the text; those of short ones are remembered."""
        found = list(map(self.raw.get, cuts))
        if None in found:
            new = [c for c, f in zip(cuts, found, strict=True) if f is None]
            texts = [c.decode().replace(" ", SPACE_MARK) for c in new]
            self.fill([t for t in texts if t not in self])
            ids = list(map(self.__getitem__, texts))
            if len(self.raw) + len(new) > RAW_ENTRIES:
                self.raw.clear()
            self.raw.update((c, i) for c, i in zip(new, ids, strict=True) if len(c) <= MEMO_CHARS)
            rest = iter(ids)
            found = [next(rest) if f is None else f for f in found]
        return found

    def fill(self, cuts: list[str]) -> None:
        """Merge the short ones among unknown cuts side by side, if they are many."""
        if len(self) + len(cuts) > MEMO_ENTRIES:
            self.clear()
        if self.model.pairs is None or len(cuts) < 100:
            return
        new = [c for c in cuts if len(c) <= MEMO_CHARS]
        for at in range(0, len(new), SIDE_BY_SIDE):
            self._fill(new[at : at + SIDE_BY_SIDE])

    def _fill(self, new: list[str]) -> None:
        size = np.fromiter(map(len, new), np.int64, len(new))
        lower = 0
        for width in WIDTHS:
            own = np.flatnonzero((size > lower) & (size <= width))
            lower = width
            if len(own):
                some = [new[i] for i in own.tolist()]
                ids, n = self.model.pairs.merge(some, size[own], width)
                packed, ends = ids.astype("<i4").tobytes(), np.cumsum(n) * 4
                found = [packed[i:j] for i, j in zip((ends - 4 * n).tolist(), ends.tolist(), strict=True)]
                # cuts with symbols that are no pieces have no ids here
                self.update((c, f) for c, f in zip(some, found, strict=True) if f)


class Pairs:
    """Which two symbols make a piece, and the agendas of many cuts side by side."""

    def __init__(self, model: Model) -> None:
        symbols = list(dict.fromkeys([*sorted(model.cost, key=model.cost.get), *(c for p in model.cost for c in p)]))
        number = {s: i for i, s in enumerate(symbols)}
        self.base = len(symbols)
        self.of_char = np.full(0x110000, -1, np.int32)
        for s, i in number.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
        self.ids = np.array([i if (i := model.ids.get(s, -1)) != model.unknown else -1 for s in symbols], np.int32)
        found = [
            (number[p[:k]] * self.base + number[p[k:]], i)
            for p, i in number.items() if p in model.cost
            for k in range(1, len(p)) if p[:k] in number and p[k:] in number
        ]
        key = np.array([f[0] for f in found], np.int64)
        joined = np.array([f[1] for f in found], np.int32)
        # symbols are numbered by cost; of those with equal costs, the rank tells that none goes before the others
        costs = [model.cost.get(s, np.inf) for s in symbols]
        self.rank = np.append(np.unique(costs, return_inverse=True)[1], len(symbols)).astype(np.int32)
        self.distinct = len(set(model.cost.values())) == len(model.cost)
        self.none = len(symbols)
        # open addressing, at most an eighth full; _place tells where a probe begins
        self.bits = max(4, (8 * len(found)).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        pair = np.full(1 << self.bits, -1, np.int32)
        left, place = np.arange(len(found)), self._place(key)
        self.probes = 0
        while len(left):
            self.probes += 1
            free = left[self.key[place] < 0]
            spot, first = np.unique(place[self.key[place] < 0], return_index=True)
            self.key[spot], pair[spot] = key[free[first]], free[first]
            stay = pair[place] != left
            left, place = left[stay], (place[stay] + 1) & ((1 << self.bits) - 1)
        self.at = np.append(joined, np.int32(self.none))[pair]

    def _place(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * MIX >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbol that the two make, ``none`` if it is no piece."""
        key = left.astype(np.int64) * self.base + right
        key = np.where((left >= 0) & (right >= 0), key, -2)
        place = self._place(key)
        out = np.where(self.key[place] == key, self.at[place], self.none).astype(np.int32)
        open_ = np.flatnonzero((self.key[place] != key) & (self.key[place] >= 0) & (key >= 0))  # counted through all rows
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            spot = (place.flat[open_] + 1) & ((1 << self.bits) - 1)
            place.flat[open_] = spot
            hit = self.key[spot] == key.flat[open_]
            out.flat[open_[hit]] = self.at[spot[hit]]
            open_ = open_[~hit & (self.key[spot] >= 0)]
        return out

    def merge(self, cuts: list[str], size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all cuts in a row, and how many each has; none for a cut with a symbol that is no piece."""
        rows = len(cuts)
        points = np.frombuffer("".join([c.ljust(width, "\0") for c in cuts]).encode("utf-32-le"), "<u4").reshape(rows, width)
        inside = np.arange(width) < size[:, None]
        symbol = np.where(inside, self.of_char[points], -1)
        agenda = np.full((rows, width), self.none, np.int32)  # what each symbol and the next make
        agenda[:, :-1] = self.find(symbol[:, :-1], symbol[:, 1:])
        left = np.where(inside, symbol, -2)  # -2: behind the end
        which = np.arange(rows)
        done = left.copy()
        columns = np.arange(width)
        while len(which):
            rank = agenda if self.distinct else self.rank[agenda]
            best = rank.argmin(axis=1)  # the leftmost of equals
            made = agenda[np.arange(len(which)), best]
            live = made < self.none
            if not live.all():
                done[which[~live], : left.shape[1]] = left[~live]
                done[which[~live], left.shape[1] :] = -2
                which, left, agenda, best, made = which[live], left[live], agenda[live], best[live], made[live]
                if not len(which):
                    break
            row = np.arange(len(which))
            behind = columns[: left.shape[1] - 1] > best[:, None]
            left = np.where(behind, left[:, 1:], left[:, :-1])
            agenda = np.where(behind, agenda[:, 1:], agenda[:, :-1])
            left[row, best] = made
            last = left.shape[1] - 1
            after = np.where(best < last, left[row, np.minimum(best + 1, last)], -2)
            agenda[row, best] = self.find(made, after)
            prior = best > 0
            agenda[row[prior], best[prior] - 1] = self.find(left[row[prior], best[prior] - 1], made[prior])
        ids = np.where(done >= 0, self.ids[done], done)
        ids[(ids == -1).any(axis=1)] = -2
        n = (ids >= 0).sum(axis=1)
        return ids[ids >= 0], n


# ---------------------------------------------------------------- on Spark
@lru_cache(maxsize=2)
def _library(content: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=content)


def broadcast_model(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(Model.load(path))


def encode(docs: DataFrame, model, text_col: str = "text", end: bool = True, checked: bool = True) -> DataFrame:
    """Add ``n_tokens`` and ``token_ids``; end: with the end id; checked: compare each batch with the library."""

    def compute(texts: pa.Array) -> dict[str, pa.Array]:
        own = model.value
        flat, at = own.encode_batch(texts)
        if end:
            flat, at = np.insert(flat, at[1:], own.end).astype(np.int32), at + np.arange(len(at))
        if checked:
            expected = _library(own.content).encode([t or "" for t in texts.to_pylist()], add_eos=end, num_threads=1)
            sizes = np.fromiter(map(len, expected), np.int64, len(expected))
            if (np.diff(at) != sizes).any() or b"".join([array("i", e) for e in expected]) != flat.tobytes():
                raise ValueError("ids differ from those of the library")
        return {"n_tokens": pa.array(np.diff(at), pa.int64()), "token_ids": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))}

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.ArrayType(T.IntegerType()))]
    return with_arrow(docs, text_col, fields, compute, CHUNK_BYTES)


def decode(encoded: DataFrame, model, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """The other columns and ``decoded``, the text of the ids; the ids column goes. Null ids: an empty text."""
    small_batches(encoded.sparkSession)
    kept = [c for c in encoded.columns if c not in (ids_col, out_col)]
    schema = T.StructType([*(encoded.schema[c] for c in kept), T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(kept))
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            texts = model.value.decode_all(lists.flatten().to_numpy(zero_copy_only=False), at)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], texts], names=[f.name for f in schema.fields])
        pa.default_memory_pool().release_unused()

    return encoded.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{ids_col}`").cast("array<int>").alias(ids_col)).mapInArrow(run, schema)
