"""Benchmark decontamination with one Aho-Corasick automaton.

Items are normalised to lower-case words joined by single spaces; each window
of ten words (a shorter item as a whole) becomes a pattern of the automaton. A
document's text is normalised alike and scanned once; hits are mapped back to
words and to code points of the original text.

Defined results: null and wordless texts have no words and no hits. Items
without words have no windows. Rows of one item_id count as one item. The
windows of an item with a null id count as hits, but no id is listed for them.
A benchmark of more than BENCHMARK_BYTES of text is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.llm.common import utf8, with_arrow

WINDOW_WORDS = 10
#: Text of items in one automaton (some 100 times as much in a worker's memory).
#: More items are scanned for in as many passes as this bound asks for.
AUTOMATON_BYTES = 1 << 20
#: Text of all items at most: it passes through the driver and is broadcast.
BENCHMARK_BYTES = 64 << 20

# A-Z to a-z; ASCII other than letters and digits to a space; other bytes stay
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(SPAN)),
]


def item_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def windows(items: list[tuple[str | None, str]], size: int = WINDOW_WORDS) -> dict[bytes, list[str]]:
    """Each window's normalised text and the ids of the items that have it."""
    out: dict[bytes, set[str]] = {}
    for item_id, text in items:
        w = item_words(text.encode())
        for i in range(max(1, len(w) - size + 1) if w else 0):
            out.setdefault(b" ".join(w[i : i + size]), set()).update([] if item_id is None else [item_id])
    return {k: sorted(v) for k, v in out.items()}


def automaton(items: list[tuple[str | None, str]], size: int = WINDOW_WORDS) -> ahocorasick.Automaton:
    """Patterns begin and end with a space, so that they match whole words; bytes go in as Latin-1."""
    out = ahocorasick.Automaton()
    for window, ids in windows(items, size).items():
        out.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, ids))
    if len(out):
        out.make_automaton()
    return out


def scan(raw: bytes, found: ahocorasick.Automaton) -> tuple[int, int, list[str], list[tuple[int, int]]]:
    """Words, words hit, items, and code point spans of the runs of hit words."""
    folded = raw.translate(_FOLD)
    words = folded.split()
    if not words or not len(found):
        return len(words), 0, [], []
    line = f" {b' '.join(words).decode('latin-1')} "
    hits = list(found.iter(line))
    if not hits:
        return len(words), 0, [], []
    # the index of the word that ends before each hit's last space
    spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    last = np.searchsorted(spaces, [end for end, _ in hits]) - 1
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, last + 1, -1)
    np.add.at(change, last + 1 - [n for _, (n, _) in hits], 1)
    hit = np.cumsum(change)[:-1] > 0
    letters = np.concatenate([[0], (np.frombuffer(folded, np.uint8) != 32).view(np.int8), [0]])
    turn = np.diff(letters)
    starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
    first, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    point = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    spans = list(zip(point[starts[first]].tolist(), point[ends[stop - 1]].tolist(), strict=True))
    return len(words), int(hit.sum()), sorted({i for _, (_, ids) in hits for i in ids}), spans


def item_batches(benchmark: DataFrame, id_col: str, text_col: str, most: int = AUTOMATON_BYTES) -> Iterator[list[tuple[str | None, str]]]:
    """Items in batches of bounded size. The driver holds one batch at a time (and Spark one partition of items)."""
    batch, size, total = [], 0, 0
    rows = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("i"), F.col(f"`{text_col}`").alias("t"))
    for r in rows.where(F.col("t").isNotNull()).toLocalIterator():
        batch.append((r["i"], r["t"]))
        n = len(r["t"].encode())
        size, total = size + n, total + n
        if total > BENCHMARK_BYTES:
            raise ValueError(f"a benchmark of over {BENCHMARK_BYTES} bytes of text")
        if size >= most:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW_WORDS
) -> DataFrame:
    """All columns and ``n_words``, ``n_hit``, ``items`` (ids, sorted) and ``spans`` (runs of hit words, in code points).

    The usual benchmark fits one automaton, which is broadcast as text. Items
    beyond its bound are put in more automata; each row is then scanned for
    one after the other and what they find is united.
    """
    context = docs.sparkSession.sparkContext
    shared = [context.broadcast(items) for items in item_batches(benchmark, item_col, item_text_col)]
    built: dict[int, ahocorasick.Automaton] = {}

    def compute(texts: pa.Array) -> dict[str, pa.Array]:
        data, at = utf8(texts)
        raw = data.tobytes()
        found = [(0, 0, [], [])] * len(texts)
        for k, items in enumerate(shared or [None]):
            if k not in built:
                if len(shared) > 1:
                    built.clear()  # one at a time, so that memory stays bounded
                built[k] = automaton(items.value if items else [], size)
            one = [scan(raw[i:j], built[k]) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            found = one if k == 0 else [unite(raw[i:j], a, b) for i, j, a, b in zip(at[:-1].tolist(), at[1:].tolist(), found, one, strict=True)]
        return {
            "n_words": pa.array([f[0] for f in found], pa.int64()),
            "n_hit": pa.array([f[1] for f in found], pa.int64()),
            "items": pa.array([f[2] for f in found], pa.list_(pa.string())),
            "spans": pa.array([[{"start": a, "end": b} for a, b in f[3]] for f in found], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        }

    return with_arrow(docs, text_col, FIELDS, compute)


def unite(raw: bytes, a: tuple, b: tuple) -> tuple[int, int, list[str], list[tuple[int, int]]]:
    """What two automata found in one text."""
    if not a[1] or not b[1]:
        return a if a[1] else b
    spans: list[tuple[int, int]] = []
    for start, end in sorted(a[3] + b[3]):
        if spans and start < spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    text = raw.decode()
    n_hit = sum(len(item_words(text[i:j].encode())) for i, j in spans)
    return a[0], n_hit, sorted({*a[2], *b[2]}), spans
