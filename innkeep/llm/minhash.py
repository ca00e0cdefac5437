"""Near-duplicate groups by bottom-k sketches from one hash function.

A text's set holds the 64-bit hashes of its five-word shingles; its sketch is
the ``SKETCH`` smallest of them. Inverted lists over retained values propose
pairs: a list's key is a run of three retained values in a row, which two sets
at the threshold share unless the first 48 values of their union hold no such
run (less than 1 case in 10^9 at a similarity of 0.85, 1 in 10^7 at 0.80, the
lowest threshold taken). Sets within the sketch's size always share one, but
for four values that are all among another set's five (0.80): such short sets
are listed under runs of two as well. Proposed pairs are kept if the estimate from their
union sketch is not far below the threshold, and then confirmed on full sets.

Texts with equal sets are one node from the start, so copies cost nothing.
Lists of up to SMALL_LIST sets propose all their pairs, each different list
once. Larger lists never do: their sets meet under a leader (the set whose
lists are the longest), dealt into blocks. Each block is first compared, on
full sets, with itself, the leader and a few more pivots: near copies of one
text are then connected with the leader, and connected sets need no more
comparing among themselves. The sets left over meet their partners in prefix
lists over full sets: with the values of each set ordered rarest first, two
linked sets share one of the first n - ceil(t n) + 1, so a set is listed under
those only, and not at all if so many of its values are its own. Lists of up to
SMALL_LIST sets propose their pairs; for larger ones (sets without private
material that share values with many) each pair of blocks is compared, and a
task returns links only, at most one a set. Every set with a run in a large
list takes part, however many other runs it has: those may all stem from its
own additions, which no partner shares.

Defined results: a text without words (or null) has an empty set and is linked
with nothing. A text of fewer than five words has one shingle. Rows with equal
sets are linked; a null id is never the smallest of a group that has others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.llm.common import MIX, MIX2, staged, utf8, with_arrow, word_hashes

SHINGLE_WORDS = 5
SKETCH = 48
RUN = 3
#: Lowest threshold for which runs of RUN values are shown to find pairs.
LEAST_PERCENT = 80
SMALL_LIST = 32
BLOCK_SETS = 256
#: Sets of a large group that every block of it meets first, besides the leader.
PIVOTS = 16
#: Pairs estimated so many standard deviations below the threshold are dropped.
ESTIMATE_DEVIATIONS = 7
#: Ids of candidate sets that are broadcast at most (8 bytes each); beyond it Spark picks the join.
BROADCAST_IDS = 2_000_000


# ---------------------------------------------------------------- sets and sketches
def combine(parts: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(parts[0]), len(parts), np.uint64) * MIX
    for p in parts:
        h = (h ^ p) * MIX2
        h ^= h >> np.uint64(32)
        h *= MIX
        h ^= h >> np.uint64(29)
    return h


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Each text's set, in order."""
    data, at = utf8(texts)
    if not len(data):
        return [np.zeros(0, np.uint64)] * len(texts)
    words, first = word_hashes(data, at)
    n = len(words) - SHINGLE_WORDS + 1
    shingles = combine([words[i : i + n] for i in range(SHINGLE_WORDS)]) if n > 0 else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SHINGLE_WORDS:
            out.append(np.unique(shingles[a : b - SHINGLE_WORDS + 1]))
        elif b > a:
            out.append(combine([words[i : i + 1] for i in range(a, b)]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _set_id(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat))


def signatures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The other columns and ``n_shingles``, ``set_id`` (null for an empty set) and ``sketch``."""
    fields = [T.StructField("n_shingles", T.LongType()), T.StructField("set_id", T.BinaryType()), T.StructField("sketch", T.ArrayType(T.LongType()))]

    def compute(texts: pa.Array) -> dict[str, pa.Array]:
        sets = shingle_sets(texts)
        return {
            "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "set_id": pa.array([_set_id(s) if len(s) else None for s in sets], pa.binary()),
            "sketch": _lists([s[:SKETCH] for s in sets]),
        }

    return with_arrow(docs, text_col, fields, compute)


def full_sets(docs: DataFrame, text_col: str) -> DataFrame:
    """``set_id`` and ``full``: the set's values in order, eight bytes each."""
    fields = [T.StructField("set_id", T.BinaryType()), T.StructField("full", T.BinaryType())]

    def compute(texts: pa.Array) -> dict[str, pa.Array]:
        sets = shingle_sets(texts)
        return {"set_id": pa.array([_set_id(s) for s in sets], pa.binary()), "full": pa.array([s.tobytes() for s in sets], pa.binary())}

    return with_arrow(docs, text_col, fields, compute).select("set_id", "full")


# ---------------------------------------------------------------- candidates
def short_union(percent: int) -> int:
    """Size of the largest union, within the sketch, of two different sets at the threshold that may hold no shared run (0: none)."""
    apart = ((u, u * (100 - percent) // 100) for u in range(1, SKETCH + 1))
    return max((u for u, d in apart if d and u - d <= (RUN - 1) * (d + 1)), default=0)


def inverted_lists(sets: DataFrame, percent: int) -> DataFrame:
    """(run, set_id, n, members): each set that can have a different partner, under each run of its sketch that another set has too."""
    sketch = F.col("sketch")

    def runs(length: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(sketch) - length), lambda i: F.xxhash64(*(F.get(sketch, i + k) for k in range(length))))

    keys = runs(RUN)
    if short := short_union(percent):
        keys = F.when(F.col("n") <= short, F.concat(keys, runs(RUN - 1))).otherwise(keys)
    rows = sets.where((100 - percent) * F.col("n") >= percent).select("set_id", "n", F.explode(keys).alias("run"))
    shared = rows.groupBy("run").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return rows.join(shared, "run")


def small_list_pairs(lists: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) from lists of up to SMALL_LIST sets; lists with the same sets count once."""
    member = F.struct("set_id", "n")
    small = lists.where(F.col("members") <= SMALL_LIST).groupBy("run").agg(F.sort_array(F.collect_list(member)).alias("m"))
    small = small.select("m").distinct()
    left = small.select("m", F.posexplode("m").alias("i", "one"))
    one = F.col("one")
    rest = F.slice("m", F.col("i") + 2, F.greatest(F.size("m") - F.col("i") - 1, F.lit(0)))
    near = F.filter(rest, lambda b: (b["n"] >= least * one["n"]) & (one["n"] >= least * b["n"]))
    pairs = left.select(one["set_id"].alias("a"), F.explode(F.transform(near, lambda b: b["set_id"])).alias("b"))
    return pairs.distinct()


def large_list_groups(lists: DataFrame) -> DataFrame:
    """(leader, set_id): all sets of large lists under the list's leader (one of them)."""
    # a set has no more rows than its sketch has runs (or, in prefix lists, values)
    weight = F.sum("members").over(Window.partitionBy("set_id"))
    rows = lists.where(F.col("members") > SMALL_LIST).withColumn("weight", weight)
    leaders = rows.groupBy("run").agg(F.max(F.struct("weight", "set_id")).alias("l")).select("run", F.col("l.set_id").alias("leader"))
    return rows.join(leaders, "run").select("leader", "set_id").distinct()


def least_estimate(percent: int) -> float:
    share = percent / 100
    return share - ESTIMATE_DEVIATIONS * (share * (1 - share) / SKETCH) ** 0.5


def estimate(a: Column, b: Column) -> Column:
    """The Jaccard similarity estimated from the union's sketch."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    return F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union)


# ---------------------------------------------------------------- exact comparison
def confirm_pairs(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    a = full.select(F.col("set_id").alias("a"), F.col("full").alias("full_a"))
    b = full.select(F.col("set_id").alias("b"), F.col("full").alias("full_b"))
    both = pairs.join(b, "b").join(a, "a")

    def run(batches):
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            keep = [linked(np.frombuffer(i.as_buffer(), np.uint64), np.frombuffer(j.as_buffer(), np.uint64), percent) for i, j in zip(x, y, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "full_a", "full_b").mapInArrow(run, "a binary, b binary")


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def common_counts(rows: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by matrix products over slices of the values that two sets share."""
    n = len(rows)
    values = np.concatenate(rows)
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    keep = count[column] > 1
    dense = np.cumsum(count > 1) - 1
    column, owner = dense[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((n, n), np.float64)
    width = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [low, low + width])
        part = np.zeros((n, width), np.float32)
        part[owner[i:j], column[i:j] - low] = 1
        out += part @ part.T
    return out


def block_links(ids: list[bytes], rows: list[np.ndarray], percent: int) -> list[tuple[bytes, bytes]]:
    """Links among the sets, as a forest: no more than are needed to connect what is linked."""
    common = common_counts(rows)
    size = np.array([len(r) for r in rows], np.float64)
    ok = 100 * common >= percent * (size[:, None] + size[None, :] - common)
    parent = list(range(len(ids)))
    out = []
    for i, j in zip(*map(np.ndarray.tolist, np.nonzero(np.triu(ok, 1))), strict=True):
        if (a := _top(parent, i)) != (b := _top(parent, j)):
            parent[a] = b
            out.append((ids[i], ids[j]))
    return out


def _top(parent: list[int] | dict[bytes, bytes], i: int | bytes) -> int | bytes:
    while parent[i] != i:
        parent[i] = i = parent[parent[i]]
    return i


def not_with(leader: bytes, ids: list[bytes], links: list[tuple[bytes, bytes]]) -> set[bytes]:
    """The ids that the links do not connect with the leader."""
    parent = {i: i for i in ids}
    for a, b in links:
        parent[_top(parent, a)] = _top(parent, b)
    return {i for i in ids if _top(parent, i) != _top(parent, leader)}


def _sets(frame: pd.DataFrame) -> tuple[list[bytes], list[np.ndarray]]:
    return list(frame["set_id"]), [np.frombuffer(b, np.uint64) for b in frame["full"]]


def _block(blocks: str) -> Column:
    return F.pmod(F.xxhash64("set_id"), F.col(blocks)).cast("int")


def pivot_links(groups: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """(leader, a, b): links found when each block of a group meets the group's leader and some more pivots.

    A row without b is a set that its own block does not connect with the leader.
    The work grows with the group, not with its square.
    """
    blocks = groups.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).cast("int").alias("blocks"))
    # the smallest id (a hash) of each share of a group; grouped by share too, so that a large group is no single key
    share = F.pmod(F.xxhash64("set_id", F.lit(1)), F.lit(PIVOTS)).alias("share")
    pivots = groups.groupBy("leader", share).agg(F.min("set_id").alias("set_id")).select("leader", "set_id")
    pivots = pivots.union(blocks.select("leader", F.col("leader").alias("set_id"))).join(blocks, "leader")
    rows = groups.join(blocks, "leader").select("leader", "set_id", _block("blocks").alias("own"), F.lit(True).alias("home"))
    everywhere = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("own")
    rows = rows.union(pivots.select("leader", "set_id", everywhere, F.lit(False)))
    rows = rows.groupBy("leader", "set_id", "own").agg(F.max("home").alias("home")).join(full, "set_id")

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        ids, sets = _sets(frame)
        links = block_links(ids, sets, percent)
        apart = not_with(key[0], ids, links)
        out = [(key[0], a, b) for a, b in links] + [(key[0], a, None) for a, home in zip(ids, frame["home"], strict=True) if home and a in apart]
        return pd.DataFrame(out, columns=["leader", "a", "b"])

    return rows.groupBy("leader", "own").applyInPandas(compare, "leader binary, a binary, b binary").distinct()


def block_pairs(groups: DataFrame, met: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links of the sets that are not yet connected with their group's leader, to each other and to the others of the group.

    Sets that are connected with the leader need no comparison among
    themselves. Both kinds are dealt into blocks, those left first; each pair
    of blocks of which one has sets left is a task's work.
    """
    linked = met.where("b IS NOT NULL")
    left = met.where("b IS NULL").select("leader", F.col("a").alias("set_id")).withColumn("left", F.lit(True))
    rows = groups.join(left, ["leader", "set_id"], "left").withColumn("left", F.coalesce("left", F.lit(False)))
    n = lambda c: F.ceil(F.sum(c.cast("int")) / BLOCK_SETS).cast("int")
    blocks = rows.groupBy("leader").agg(n(F.col("left")).alias("n_left"), n(~F.col("left")).alias("n_met")).where("n_left > 0")
    rows = rows.join(blocks, "leader")
    own = F.when(F.col("left"), _block("n_left")).otherwise(F.col("n_left") + _block("n_met"))
    last = F.when(F.col("left"), F.col("n_left") + F.col("n_met")).otherwise(F.col("n_left")) - 1
    rows = rows.select("leader", "set_id", own.alias("own"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
    rows = rows.select("leader", "set_id", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).join(full, "set_id")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(block_links(*_sets(frame), percent), columns=["a", "b"])

    return rows.groupBy("leader", "i", "j").applyInPandas(compare, "a binary, b binary").distinct().union(linked.select("a", "b"))


def prefix_lists(pool: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """(run, set_id, n, left, members): sets under the rarest of their values, of lists with a set that is ``left``.

    pool: (set_id, left). A value is counted over the sets of the pool; values
    that one set has stand first in its order and make no list.
    """

    def spread_out(batches):
        schema = pa.schema([("set_id", pa.binary()), ("left", pa.bool_()), ("n", pa.int64()), ("run", pa.int64())])
        for batch in batches:
            for i in range(batch.num_rows):  # a set at a time: sets can be large
                values = np.frombuffer(batch.column(2)[i].as_buffer(), np.int64)
                same = [pa.array([x], k).take(pa.array(np.zeros(len(values), np.int32))) for x, k in ((batch.column(0)[i].as_py(), pa.binary()), (batch.column(1)[i].as_py(), pa.bool_()), (len(values), pa.int64()))]
                yield pa.RecordBatch.from_arrays([*same, pa.array(values)], schema=schema)

    rows = pool.join(full, "set_id").select("set_id", "left", "full").mapInArrow(spread_out, "set_id binary, left boolean, n long, run long")
    counts = rows.groupBy("run").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = rows.join(counts, "run").groupBy("set_id", "left", "n").agg(F.sort_array(F.collect_list(F.struct("members", "run"))).alias("values"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    listed = (prefix - (F.col("n") - F.size("values"))).cast("int")
    kept = shared.where(listed > 0).select("set_id", "left", "n", F.explode(F.slice("values", F.lit(1), F.greatest(listed, F.lit(0)))).alias("v")).select("set_id", "left", "n", "v.run")
    kept = staged(kept, "prefix-lists")
    lists = kept.groupBy("run").agg(F.count(F.lit(1)).alias("members"), F.max("left").alias("any_left")).where("members > 1 AND any_left")
    return kept.join(lists.select("run", "members"), "run")


# ---------------------------------------------------------------- components
def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches, by large-star and small-star steps."""
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    before = None
    for _ in range(rounds):
        # large star: neighbours larger than a node go to the smallest neighbour
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # small star: a node's smaller neighbours and itself go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hop = large.join(least, "u")
        small = hop.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = staged(small.where("u != v").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """One row a document: the id, ``n_shingles``, ``component_id`` and ``kept`` (the smallest id of its group)."""
    found = grouped(docs, id_col, text_col, percent)
    return found.select(F.col("_id").alias(id_col), "n_shingles", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


def surplus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """(_id, _hash, stays): the rows, by id and xxhash64 of the text, that go so that one row of each group stays.

    The row with the smallest id stays, a null id last; of rows of one id that
    with the smallest hash. If that row is there more than once, it is listed
    with ``stays``: one of its copies stays. Texts with empty sets are not listed.
    """
    found = grouped(docs, id_col, text_col, percent).where("component is not null")
    row = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_hash").alias("hash"))
    keys = staged(found.groupBy("component", "_id", "_hash").agg(F.count(F.lit(1)).alias("copies")), "row-keys")
    first = keys.groupBy("component").agg(F.min(row).alias("first"), F.sum("copies").alias("rows")).where("rows > 1")
    keys = keys.join(first, "component").withColumn("stays", row.eqNullSafe(F.col("first")))
    return keys.where("not stays or copies > 1").select("_id", "_hash", "stays")


def grouped(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """One row a document: _id, _hash (of the text), n_shingles, component (a set id of its group; null for an empty set) and component_id."""
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"a threshold of {percent} % is not within {LEAST_PERCENT} to 100")
    doc_id = F.col(f"`{id_col}`")
    least = percent / 100
    source = docs.select(doc_id.alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    signed = staged(signatures(source, "_text"), "signatures")
    sets = staged(
        signed.where(F.col("set_id").isNotNull())
        .groupBy("set_id")
        .agg(F.min("_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")),
        "sets",
    )
    lists = staged(inverted_lists(sets, percent), "lists")
    sketches = sets.select("set_id", "sketch")

    def likely(proposed: DataFrame) -> DataFrame:
        proposed = proposed.join(sketches.select(F.col("set_id").alias("a"), F.col("sketch").alias("sa")), "a")
        proposed = proposed.join(sketches.select(F.col("set_id").alias("b"), F.col("sketch").alias("sb")), "b")
        return proposed.where(estimate(F.col("sa"), F.col("sb")) >= least_estimate(percent)).select("a", "b")

    pairs = staged(likely(small_list_pairs(lists, least)), "pairs")
    groups = staged(large_list_groups(lists), "groups")
    wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).union(groups.select("set_id")).distinct()
    wanted = staged(wanted.join(sets, "set_id").select("set_id", F.col("rep").alias("_rep")), "wanted")
    ids = wanted.select("_rep")
    if wanted.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    full = full_sets(source.join(ids, F.col("_id").eqNullSafe(F.col("_rep")), "left_semi"), "_text")
    full = staged(full.join(wanted.select("set_id"), "set_id", "left_semi").dropDuplicates(["set_id"]), "full-sets")
    met = staged(pivot_links(groups, full, percent), "pivot-links")
    links = confirm_pairs(pairs, full, percent).union(met.where("b IS NOT NULL").select("a", "b"))
    # sets that their group's pivots did not connect, among all sets of such groups
    apart = met.where("b IS NULL").select("leader", F.col("a").alias("set_id"))
    pool = groups.join(apart.select("leader").distinct(), "leader", "left_semi").join(apart.withColumn("left", F.lit(True)), ["leader", "set_id"], "left")
    pool = pool.groupBy("set_id").agg(F.max(F.coalesce("left", F.lit(False))).alias("left"))
    rare = staged(prefix_lists(pool, full, percent), "rare-lists")
    links = links.union(confirm_pairs(likely(small_list_pairs(rare, least)), full, percent))
    crowds = staged(large_list_groups(rare), "crowds")
    if crowds.limit(1).count():
        links = links.union(block_pairs(crowds, staged(pivot_links(crowds, full, percent), "crowd-links"), full, percent))
    reached = components(links)
    by_set = sets.join(reached, F.col("set_id") == F.col("node"), "left").select("set_id", "rep", F.coalesce("component", "set_id").alias("component"))
    smallest = by_set.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_set = by_set.join(smallest, "component").select(F.col("set_id").alias("_set"), "component", "component_id")
    out = signed.withColumn("_hash", F.xxhash64("_text")).join(by_set, F.col("set_id") == F.col("_set"), "left")
    return out.select("_id", "_hash", "n_shingles", "component", F.coalesce("component_id", "_id").alias("component_id"))
