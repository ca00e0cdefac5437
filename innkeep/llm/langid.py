"""Language identification by compression.

For each language a zstandard dictionary of raw content is cut from a bounded
sample of labelled texts. A text, in lower case and without signs and digits,
is compressed block by block with each language's dictionary; the language with the smallest total wins. The text is
rejected when the runner-up is nearly as small.

Defined results: a null text or one without a letter is ``und``, score 0 and
rejected; so is every text if no labelled text was given. Of languages with
equal sizes the first by name wins (and the margin is 0, so it is rejected).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.llm.common import with_arrow

#: Bounds of the labelled sample: texts a language, code points of a text, bytes of a dictionary.
SAMPLE_TEXTS = 120
SAMPLE_CHARS = 4_000
DICTIONARY_BYTES = 112 << 10
#: Most languages that are told apart (their dictionaries are broadcast: 112 KB each).
MAX_LANGUAGES = 400
BLOCK_BYTES = 8 << 10
LEVEL = 3
#: Shortest match of the compressor, in bytes: word endings count too.
MIN_MATCH = 3
#: A text is rejected if the runner-up needs less than so many bytes more, or less than this share more.
MIN_MARGIN_BYTES = 2
MIN_MARGIN = 0.003

UNKNOWN = "und"
FIELDS = [
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("rejected", T.BooleanType()),
]
_LETTER = re.compile(r"[^\W\d_]")
_SIGNS = re.compile(r"[\W\d_]+")


def fit(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS
) -> dict[str, bytes]:
    """A raw-content dictionary for each language.

    Of each language ``texts`` different texts are taken, in the order of a hash
    of the text; those of up to ``chars`` code points first, others cut to that
    length. Copies count once: they are dropped by hash, in the tasks before the
    shuffle, and only then the first texts are chosen.
    """
    text, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`")
    order = Window.partitionBy("lang").orderBy("long", "h")
    rows = labelled.where(lang.isNotNull() & (F.length(F.trim(text)) > 0)).select(
        lang.cast("string").alias("lang"),
        F.substring(text, 1, chars).alias("text"),
        (F.length(text) > chars).alias("long"),
        F.xxhash64(text).alias("h"),
    )
    first = rows.select("lang", "long", "h").distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= texts)
    chosen = first.limit(MAX_LANGUAGES * texts + 1).collect()
    if len(chosen) > MAX_LANGUAGES * texts or len({r["lang"] for r in chosen}) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    if not chosen:
        return {}
    chosen = labelled.sparkSession.createDataFrame(chosen, first.schema)
    rows = rows.join(F.broadcast(chosen), ["lang", "long", "h"]).groupBy("lang", "n").agg(F.min("text").alias("text"))
    by_lang: dict[str, list[tuple[int, str]]] = {}
    for r in rows.collect():  # at most MAX_LANGUAGES x SAMPLE_TEXTS rows of SAMPLE_CHARS
        by_lang.setdefault(r["lang"], []).append((r["n"], r["text"]))
    out = {}
    for name, found in sorted(by_lang.items()):
        # the end of a dictionary is the cheapest to refer to: keep the first texts there
        body = "\n".join(normalise(t) for _, t in sorted(found, reverse=True)).encode()[-DICTIONARY_BYTES:]
        if len(body) >= 8:
            out[name] = body
    return out


class Classifier:
    """A worker's compressors, one a language."""

    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.names = sorted(dictionaries)
        self.compressors = []
        for name in self.names:
            data = dictionaries[name]
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, min_match=MIN_MATCH, dict_size=len(data), source_size=BLOCK_BYTES, write_checksum=0, write_content_size=0, write_dict_id=0
            )
            d.precompute_compress(compression_params=how)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=d, compression_params=how).compress)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if text is None or not self.names or not _has_letter(text):
            return UNKNOWN, 0.0, True
        data = normalise(text).encode()
        blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        sizes = [sum(len(c(b)) for b in blocks) for c in self.compressors]
        best = min(sizes)
        if len(sizes) == 1:
            return self.names[0], 1.0, False
        margin = sorted(sizes)[1] - best
        # each byte saved halves the odds of the other language
        score = 1.0 / float(np.exp2(-np.minimum(np.array(sizes) - best, 60.0)).sum())
        return self.names[sizes.index(best)], score, margin < max(MIN_MARGIN_BYTES, MIN_MARGIN * best)


def normalise(text: str) -> str:
    """Lower case; a run of anything but letters is one space."""
    return _SIGNS.sub(" ", text.lower())


def _has_letter(text: str) -> bool:
    m = _LETTER.search(text)
    # numerals such as superscripts are word characters but not letters
    return m is not None and (m[0].isalpha() or any(c.isalpha() for c in text))


_classifiers: dict[str, Classifier] = {}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """All columns and ``lang_pred``, ``score`` (0 to 1) and ``rejected``."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def compute(texts: pa.Array) -> dict[str, pa.Array]:
        key = str(id(shared))
        if key not in _classifiers:
            _classifiers.clear()
            _classifiers[key] = Classifier(shared.value)
        found = [_classifiers[key].predict(t) for t in texts.to_pylist()]
        return {
            "lang_pred": pa.array([f[0] for f in found], pa.string()),
            "score": pa.array([f[1] for f in found], pa.float64()),
            "rejected": pa.array([f[2] for f in found], pa.bool_()),
        }

    return with_arrow(docs, text_col, FIELDS, compute)



