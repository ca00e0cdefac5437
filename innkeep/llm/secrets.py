"""Secret scan with multipart credential linking, in DataFrame functions only.

Base kinds are reported wherever they match. Weak parts (identifiers, bare
random-looking tokens, endpoints) mean little alone; they are reported only
when a complementary part lies in the same scope (text without a blank line);
a distance in code points may be set as well. The linking is an interval join
done as a sweep: parts of a scope in order of their place, each looking at the
nearest complementary part before and after it, so no pairs are formed.

Places come from splitting a text by a pattern: pieces and matches alternate,
and their lengths add up.

Defined results: a null or empty text has no spans. Repeated rows (equal id
and text) get equal spans. A null id is an id of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MASK = "[SECRET]"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    role: str  # identifier, secret, endpoint; or break: the end of a scope
    base: bool = False
    least_value: int = 0  # shortest second group


#: The base kinds, in the order in which spans of one start are listed.
BASE_KINDS = [
    Kind(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        "secret",
        True,
        6,
    ),
    # runs are maximal, so the least length can stand in the pattern
    Kind("access", r"AKIA[A-Z0-9]{16,}", "identifier", True),
    Kind("hex", r"[0-9a-f]{24,}", "secret", True),
]
WEAK_KINDS = [
    Kind("login", r"""(?<![A-Za-z0-9_])(?i:access_?key_?id|client_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}""", "identifier"),
    Kind("bare", r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[a-z])(?=[A-Za-z0-9+/_-]*[A-Z])[A-Za-z0-9+/_-]{32,}={0,2}", "secret"),
    Kind("endpoint", r"""(?<![A-Za-z0-9])(?i:https?|ftps?|sftp|ssh|s3|jdbc:[a-z]{2,20}|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://[^\x00-\x20"'<>]{4,}""", "endpoint"),
]
BREAK = Kind("break", r"\n[\x20\t\r]*\n", "break")
KINDS = [*BASE_KINDS, *WEAK_KINDS, BREAK]
KEY = ["_id", "_hash"]


def _key(id_col: str, text: Column) -> list[Column]:
    return [F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text, F.length(text)).alias("_hash")]


def _matches(text: Column, order: int, kind: Kind) -> Column:
    """Pieces before each match and the matches, as structs; none if the text has no match."""
    gaps = F.transform(F.split(text, kind.pattern, -1), lambda p: F.length(p))
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pairs = F.arrays_zip(gaps.alias("gap"), found.alias("m"))
    # as many pieces as matches and one more: its m is null
    rows = F.transform(
        F.filter(pairs, lambda x: x["m"].isNotNull()),
        lambda x, i: F.struct(
            F.lit(order).alias("kind"),
            i.alias("i"),
            x["gap"].alias("gap"),
            F.length(x["m"]).alias("size"),
            (F.length(F.regexp_extract(x["m"], kind.pattern, 2)) >= kind.least_value if kind.least_value else F.lit(True)).alias("ok"),
        ),
    )
    return F.when(text.rlike(kind.pattern), rows).otherwise(F.array().cast(_HITS))


_HITS = "array<struct<kind:int,i:int,gap:int,size:int,ok:boolean>>"


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a match of any kind: _id, _hash, kind (its number), start, end; and one of kind -1 a text, with its copies."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    none = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("i"), F.lit(0).alias("gap"), F.lit(0).alias("size"), F.lit(True).alias("ok")))
    source = docs.select(*_key(id_col, text), text.alias("_text"))
    hits = F.concat(none.cast(_HITS), *(_matches(F.col("_text"), k, kind) for k, kind in enumerate(KINDS)))
    rows = source.select(*KEY, F.inline(hits))
    # everything below keeps this partitioning: one shuffle of short rows
    rows = rows.repartition(*KEY).groupBy(*KEY, "kind", "i", "gap", "size", "ok").agg(F.count(F.lit(1)).alias("copies"))
    before = Window.partitionBy(*KEY, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap").cast("long") + F.col("size")).over(before)
    return rows.withColumn("end", end).where("ok").select(*KEY, "kind", (F.col("end") - F.col("size")).alias("start"), "end", "copies")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int | None = None) -> DataFrame:
    """Reported parts of texts: _id, _hash, kind, start, end, base. A text without any has one row of kind -1.

    distance: the most code points between linked parts (default: any within the scope).
    """
    role = F.element_at(F.array(*(F.lit(k.role) for k in KINDS)), F.col("kind") + 1)
    is_base = F.col("kind").between(0, len(BASE_KINDS) - 1)
    rows = parts(docs, id_col, text_col).withColumn("role", F.when(F.col("kind") >= 0, role).otherwise("text"))
    in_text = Window.partitionBy(*KEY).orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("scope", F.sum((F.col("role") == "break").cast("int")).over(in_text))
    scope = Window.partitionBy(*KEY, "scope").orderBy("start", "kind")
    earlier, later = scope.rowsBetween(Window.unboundedPreceding, -1), scope.rowsBetween(1, Window.unboundedFollowing)
    base_end = F.max(F.when(is_base, F.col("end"))).over(earlier)
    base_start = F.min(F.when(is_base, F.col("start"))).over(later)
    rows = rows.withColumn("covered", ~is_base & (F.coalesce(base_end > F.col("start"), F.lit(False)) | F.coalesce(base_start < F.col("end"), F.lit(False))))

    def near(role: str) -> Column:
        """A part of that role in the scope, apart from this one and not inside a base span, within the distance."""
        fits = (F.col("role") == role) & ~F.col("covered")
        before, after = F.max(F.when(fits, F.col("end"))).over(earlier), F.min(F.when(fits, F.col("start"))).over(later)
        if distance is None:
            return before.isNotNull() | after.isNotNull()
        return F.coalesce(F.col("start") - before <= distance, F.lit(False)) | F.coalesce(after - F.col("end") <= distance, F.lit(False))

    for r in ("identifier", "secret", "endpoint"):
        rows = rows.withColumn(f"near_{r}", near(r))
    linked = ~F.col("covered") & (
        F.when(F.col("role") == "secret", F.col("near_identifier") | F.col("near_endpoint"))
        .when(F.col("role") == "identifier", F.col("near_secret"))
        .when(F.col("role") == "endpoint", F.col("near_secret"))
        .otherwise(False)
    )
    return rows.withColumn("base", is_base).where((F.col("kind") == -1) | F.col("base") | linked).select(*KEY, "kind", "start", "end", "base", "copies")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int | None = None) -> DataFrame:
    """One row a row of ``docs``: the id and ``spans``, an array of (start, order, end, kind, base), in order."""
    name = F.element_at(F.array(*(F.lit(k.name) for k in KINDS)), F.col("kind") + 1)
    span = F.struct("start", F.col("kind").alias("order"), "end", name.alias("kind"), "base")
    by_text = spans(docs, id_col, text_col, distance).groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") >= 0, span))).alias("spans"),
        F.max(F.when(F.col("kind") == -1, F.col("copies"))).alias("copies"),
    )
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return by_text.select(F.col("_id").alias(id_col), "spans", copies.alias("_")).drop("_")


def listed(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = MASK, distance: int | None = None) -> DataFrame:
    """``docs`` with every reported span masked; overlapping spans become one mask. Other rows and columns stay."""
    order = Window.partitionBy(*KEY).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = spans(docs, id_col, text_col, distance).where("kind >= 0").withColumn("first", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    rows = rows.withColumn("run", F.sum("first").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = rows.groupBy(*KEY, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = merged.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_cuts"))
    # the row goes in one column, so that its names cannot clash with those of the join
    row = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in docs.columns))
    keyed = docs.select(row.alias("_row"), *(c.alias(f"_docs{k}") for k, c in zip(KEY, _key(id_col, F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), strict=True)))
    joined = keyed.join(cuts, F.col("_docs_id").eqNullSafe(F.col("_id")) & (F.col("_docs_hash") == F.col("_hash")), "left")
    text, cut = F.col("_row")[text_col], F.col("_cuts")
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(cut, i - 1)["end"])
    kept = F.transform(cut, lambda c, i: F.concat(F.substr(text, (begin(i) + 1).cast("int"), (c["start"] - begin(i)).cast("int")), F.lit(mask)))
    tail = F.substr(text, (F.element_at(cut, -1)["end"] + 1).cast("int"))
    new = F.when(cut.isNull(), text).otherwise(F.concat(F.array_join(kept, ""), tail))
    return joined.select(*((new if c == text_col else F.col("_row")[c]).alias(c) for c in docs.columns))
