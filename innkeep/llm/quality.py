"""Quality rules by distribution divergence, in DataFrame functions only.

Per document, in its own row: word, symbol and repetition counts, a histogram
of character classes and one of common words. Both histograms are compared
with those of the document's language by Jensen-Shannon distance (base 2, so
0 to 1). Documents too short for a stable histogram are not judged by it.

Defined results: a null text has no words and fails the base rule. A document
without a language is compared with the reference over all documents; so is
one whose language has no reference. Repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.llm.common import staged

MIN_WORDS = 20
WINDOW_WORDS = 8
#: Largest share of words in repeated windows, in percent.
MAX_REPEATED = 30
#: Shorter documents are not judged by divergence.
GUARD_WORDS = 50
#: Largest Jensen-Shannon distances that are kept.
MAX_CLASS_DISTANCE = 0.28
MAX_COMMON_DISTANCE = 0.33
#: Reference rows (one a language, about 1 KB) that are broadcast at most.
BROADCAST_LANGUAGES = 2_000

#: Frequent words of four languages. Other words count as one class.
COMMON_WORDS = {
    "en": "the of and to in a is that it on for was as with be by this are from at or an not have".split(),
    "fr": "de la le et les des en un une du que est dans qui pour au par sur pas plus avec ce il se".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden".split(),
    "es": "de la que el en y a los del se las por un para con no una su al es lo como más o".split(),
}
VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words})
#: Patterns of the character classes that are counted by what is left without them.
CLASSES = {"upper": "[A-Z]+", "digit": "[0-9]+", "sign": r"[!-/:-@\[-`{-~]+", "beyond_ascii": r"[^\x00-\x7F]+"}
SPACE = r"[\x20\x09-\x0D]+"
ALL = "*"
#: Columns that judge() adds; input columns of these names are left out.
OUTPUTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "common_distance", "base_failed", "kept"]


def counts(docs: DataFrame, kept: list[str], text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The kept columns as ``_row``, the language as ``_lang`` and the counts of each row's text; no shuffle, each text is read once."""
    cols = ["_row", "_lang"]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(""))
    row = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in kept))
    df = docs.select(row.alias("_row"), lang.alias("_lang"), text.alias("_t"))
    df = df.select(*cols, "_t", F.array_remove(F.split("_t", SPACE, -1), "").alias("_w"), F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    listed = F.array(*(F.lit(w) for w in VOCABULARY))
    common = F.filter(F.transform("_w", lambda w: F.lower(w)), lambda w: w.isin(*VOCABULARY))
    df = df.select(
        *cols,
        F.length("_t").alias("_chars"),
        F.length(F.array_join("_w", "")).alias("word_chars"),
        (F.size(F.split("_t", r"[#*$%&|<>]", -1)) - 1).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        F.size("_w").alias("n_words"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
        common.alias("_common"),
        *((F.length("_t") - F.length(F.regexp_replace("_t", p, ""))).alias(f"_{k}") for k, p in CLASSES.items()),
    )
    # hashes of windows of two, four and eight words; null below the least length
    for step in (1, 2, 4):
        left = F.greatest(F.size("_h") - step, F.lit(0))
        df = df.withColumn("_h", F.when(F.col("n_words") > WINDOW_WORDS, F.zip_with(F.slice("_h", F.lit(1), left), F.slice("_h", F.lit(step + 1), left), lambda a, b: F.xxhash64(a, b))))
    # where windows stand that occur twice: neighbours in the order of (hash, place)
    repeated = F.size("_h") > F.size(F.array_distinct("_h"))
    df = df.withColumn("_p", F.when(repeated, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, i, step: F.coalesce(F.get("_p", i + step)["h"] == x["h"], F.lit(False))
    twice = F.filter("_p", lambda x, i: same(x, i, -1) | same(x, i, 1))
    df = df.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    gaps = F.transform("_at", lambda p, i: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get("_at", i + 1) - p, F.lit(WINDOW_WORDS))))
    covered = F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, x: a + x), F.lit(0))
    other_letters = F.col("word_chars") - sum((F.col(f"_{k}") for k in CLASSES), F.lit(0))
    per_word = F.transform(listed, lambda w: F.size("_common") - F.size(F.array_remove("_common", w)))
    return df.select(
        *cols,
        *(F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines")),
        covered.cast("long").alias("n_repeat_words"),
        F.array(*(F.col(f"_{k}") for k in CLASSES), other_letters, F.col("_chars") - F.col("word_chars")).alias("classes"),
        F.concat(per_word, F.array(F.col("n_words") - F.size("_common"))).alias("common"),
    )


def _shares(histogram: Column) -> Column:
    total = F.aggregate(histogram, F.lit(0).cast("double"), lambda a, x: a + x)
    # the total is the argument of a lambda of its own: inside the one over the histogram it would be summed again for each element
    return F.transform(F.array(total), lambda n: F.transform(histogram, lambda x: F.when(n > 0, x / n).otherwise(0.0)))[0]


def references(counted: DataFrame) -> DataFrame:
    """Shares of all documents' counts by language, and over all (language '*')."""
    n_classes, n_words = len(CLASSES) + 2, len(VOCABULARY) + 1
    total = lambda c, n: F.array(*(F.sum(F.col(c)[i]).cast("double") for i in range(n)))
    sums = staged(counted.groupBy(F.col("_lang").alias("_ref")).agg(total("classes", n_classes).alias("_c"), total("common", n_words).alias("_w")), "quality-sums")
    every = sums.select(F.lit(ALL).alias("_ref"), F.array(*(F.col("_c")[i] for i in range(n_classes))).alias("_c"), F.array(*(F.col("_w")[i] for i in range(n_words))).alias("_w"))
    every = every.groupBy("_ref").agg(total("_c", n_classes).alias("_c"), total("_w", n_words).alias("_w"))
    both = sums.where(F.col("_ref") != "").unionByName(every)
    return both.select("_ref", _shares(F.col("_c")).alias("_ref_classes"), _shares(F.col("_w")).alias("_ref_common"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two share arrays, to the base 2; 0 if either is all zero."""
    term = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)
    parts = F.zip_with(p, q, lambda a, b: term(a, b) + term(b, a))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda s, x: s + x) / 2))


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (not the text), the counts, ``class_distance``, ``common_distance``, ``base_failed`` and ``kept``."""
    kept = [c for c in (keep if keep is not None else docs.columns) if c != text_col and c not in OUTPUTS]
    counted = staged(counts(docs, kept, text_col, lang_col), "quality-counts")
    refs = staged(references(counted), "quality-references")
    if refs.limit(BROADCAST_LANGUAGES + 1).count() <= BROADCAST_LANGUAGES:
        refs = F.broadcast(refs)
    # the reference over all documents is one row of fixed width: it goes into the expressions
    row = refs.where(F.col("_ref") == ALL).first()
    every = {c: F.array(*map(F.lit, row[c])) if row else F.lit(None).cast("array<double>") for c in ("_ref_classes", "_ref_common")}
    own = refs.where(F.col("_ref") != ALL)
    df = counted.join(own, F.col("_lang") == F.col("_ref"), "left")
    df = df.withColumn("_p", _shares(F.col("classes"))).withColumn("_q", _shares(F.col("common")))
    df = df.withColumn("class_distance", js_distance(F.col("_p"), F.coalesce(F.col("_ref_classes"), every["_ref_classes"])))
    df = df.withColumn("common_distance", js_distance(F.col("_q"), F.coalesce(F.col("_ref_common"), every["_ref_common"])))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    near = (F.col("class_distance") <= MAX_CLASS_DISTANCE) & (F.col("common_distance") <= MAX_COMMON_DISTANCE)
    return df.select(
        *(F.col("_row")[c].alias(c) for c in kept),
        *OUTPUTS[:-2],
        base_failed.alias("base_failed"),
        (~base_failed & ((F.col("n_words") < GUARD_WORDS) | F.coalesce(near, F.lit(True)))).alias("kept"),
    )
