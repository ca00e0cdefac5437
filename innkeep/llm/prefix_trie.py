"""Prefix trie of conversations by van Emde Boas recursion.

The longest sequence is cut at half its depth, the halves are cut again, and so
on down to blocks of LEAF turns. All cuts of one level are worked on at once:

* contents: from the blocks up, the content of each aligned run of 2**j blocks
  is named from its two halves;
* cut prefixes: from the top down, the prefix that ends at a cut is named from
  the prefix at the cut above it and the content between the two. A cut prefix
  is the root of the lower forests that hang from the upper trie there;
* inside a block, the up to LEAF prefixes are named from the cut they begin at;
* totals: each block trie is summed to its root, the sums of lower forests are
  grafted to the cut above them level by level, the cuts below are added from
  the top down, and at last each cut's total goes to the prefixes between it
  and the cut above.

Work and shuffled rows are in proportion to the turns: level j holds one row
for each 2**j blocks. No group holds more than LEAF turns, so one conversation
may hold any share of all rows; common prefixes are counted with partial
aggregation. Names are 128-bit digests of what they stand for.

Defined results: rows without a conv_id belong to no conversation and are left
out. A null turn stands first; rows of equal turn stand in the order of a
digest of role and text, and repeated rows stay, one after the other. Null
roles and texts are empty. A text counts whole, whatever its length. No
conversation, no node. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.llm.common import staged

#: Turns between two of the lowest cuts.
LEAF = 8
#: Fixed values of the rebuilt conversations: how many share a first one, and the remainder that gives the turns taken from it.
FAMILY, TAKEN = 5, 9
#: Bytes of listed ids that a task holds of one node.
PIECE_BYTES = 64 << 10
ROOT_NAME = b"the empty prefix"


def _root() -> Column:
    return F.lit(ROOT_NAME)


def _name(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- turns
def numbered(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Add ``place``, the number of a row (from 0) among those of its key, however many they are.

    Rows are dealt out by ranges of key and order, numbered in each sorted
    partition, and moved on by what earlier partitions hold of the same key. At
    most one key is open at the start of a partition, so the broadcast table of
    such counts has no more rows than there are partitions. ``df`` must be a
    scan of files (rows of equal order are told apart by their place there).
    """
    spark = df.sparkSession
    by = [key, *order, "_tie"]
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(_partitions(spark), *by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id())
    dealt = dealt.select(key, *(c for c in df.columns if c != key), "_part")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, held = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            first = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
            sizes = np.diff(np.concatenate([first, [len(keys)]]))
            base = -first
            if keys[0] == open_key:
                base[0] += held
            place = np.arange(len(keys)) + np.repeat(base, sizes)
            open_key, held = keys[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], names=[*batch.schema.names, "_at"])

    local = staged(dealt.mapInArrow(number, T.StructType([*dealt.schema.fields, T.StructField("_at", T.LongType())])), "numbered")
    counts = local.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    moved = counts.select(key, "_part", before.alias("_before")).where("_before > 0")
    place = (F.col("_at") + F.coalesce("_before", F.lit(0))).alias("place")
    return local.join(F.broadcast(moved), [key, "_part"], "left").select(*df.columns, place)


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, place, digest and bytes of each turn, in the order of turns."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes")
    )
    return numbered(staged(rows, "turns"), "conv_id", ["turn", "digest"]).drop("turn")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of the first of their family: (turns with the length as ``total``, conv_id and total)."""
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    base = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")
    taken = (F.crc32(F.col("conv_id").cast("string")) % TAKEN).alias("taken")
    firsts = lengths.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    known = lengths.select("conv_id", "n", base, taken).join(firsts, "base", "left")
    head = F.least("taken", F.coalesce("there", F.lit(0)))
    members = known.select("conv_id", "base", "taken", head.alias("head"), (head + F.greatest(F.col("n") - F.col("taken"), F.lit(0))).alias("total"))
    members = staged(members, "members")
    own = turns.join(members, "conv_id").where("place >= taken").withColumn("place", F.col("place") - F.col("taken") + F.col("head"))
    lent = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < TAKEN - 1)).withColumnRenamed("conv_id", "base")
    lent = lent.join(members, "base").where("place < taken")
    columns = ["conv_id", "place", "digest", "bytes", "total"]
    return own.select(*columns).union(lent.select(*columns)), members.select("conv_id", "total")


# ---------------------------------------------------------------- names
def _blocks(turns: DataFrame) -> DataFrame:
    """conv_id, block, total, the bytes of its turns, and a digest of each beginning of the block."""
    turn = F.struct("place", "digest", "bytes")
    block = F.floor(F.col("place") / LEAF).cast("long").alias("block")
    held = turns.groupBy("conv_id", block).agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.max("total").alias("total"))
    chain = F.aggregate("turns", F.array(F.lit(b"")).cast("array<binary>"), lambda done, t: F.concat(done, F.array(_name(F.element_at(done, -1), t["digest"]))))
    return held.select("conv_id", "block", "total", F.transform("turns", lambda t: t["bytes"]).alias("bytes"), F.slice(chain, 2, LEAF).alias("chain"))


def _cut_prefixes(blocks: DataFrame) -> list[DataFrame]:
    """By level: conv_id, block, name, anchor of each cut prefix.

    The cut of level j before ``block``, an odd multiple of 2**j, is named from
    its anchor, the cut 2**j blocks above, and the content between.
    """
    full = blocks.where(F.size("chain") == LEAF)
    contents = [full.select("conv_id", F.col("block").alias("i"), F.element_at("chain", LEAF).alias("name"))]
    runs = (full.agg(F.max("block")).first()[0] or 0) + 1 if full.limit(1).count() else 0
    if not runs:
        return []
    while runs > 1:
        half = F.floor(F.col("i") / 2).cast("long").alias("i")
        both = contents[-1].groupBy("conv_id", half).agg(F.count(F.lit(1)).alias("n"), F.min_by("name", "i").alias("left"), F.max_by("name", "i").alias("right"))
        contents.append(staged(both.where("n = 2").select("conv_id", "i", _name(F.col("left"), F.col("right")).alias("name")), "contents"))
        runs //= 2
    found: list[DataFrame] = []
    for level in range(len(contents) - 1, -1, -1):
        upper = contents[level].where("i % 2 = 0").select("conv_id", (F.col("i") * (1 << level)).alias("block"), F.col("name").alias("content"))
        cuts = upper.where("block = 0").withColumn("anchor", _root())
        if found:
            above = _union(found).select("conv_id", "block", F.col("name").alias("anchor"))
            cuts = cuts.unionByName(upper.where("block > 0").join(above, ["conv_id", "block"]))
        cuts = cuts.select("conv_id", (F.col("block") + (1 << level)).alias("block"), _name(F.col("anchor"), F.col("content")).alias("name"), "anchor")
        found.insert(0, staged(cuts, "cuts"))
    return found


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _prefixes(blocks: DataFrame, cuts: list[DataFrame]) -> DataFrame:
    """conv_id, block, total, bytes and ``names``: of the prefix that the block begins at and of those that end in it."""
    start, stop, inner = _root(), F.lit(None).cast("binary"), F.slice("chain", 1, LEAF - 1)
    if cuts:
        at = _union(cuts)
        blocks = blocks.join(at.select("conv_id", "block", F.col("name").alias("start")), ["conv_id", "block"], "left")
        blocks = blocks.join(at.select("conv_id", (F.col("block") - 1).alias("block"), F.col("name").alias("stop")), ["conv_id", "block"], "left")
        start, stop = F.coalesce("start", _root()), F.col("stop")
    names = F.concat(F.array(start), F.transform(inner, lambda x: _name(start, x)), F.when(F.size("chain") == LEAF, F.array(stop)).otherwise(F.array().cast("array<binary>")))
    return blocks.select("conv_id", "block", "total", "bytes", names.alias("names"))


# ---------------------------------------------------------------- totals
def _nodes(prefixes: DataFrame, members: DataFrame) -> DataFrame:
    """name, depth, conv_id, n_convs, leaf, saved and ``above``: the names from the cut above to the parent."""
    each = prefixes.select("conv_id", "total", "block", "names", F.posexplode("bytes").alias("o", "bytes")).select(
        "conv_id",
        "total",
        F.element_at("names", F.col("o") + 2).alias("name"),
        (F.col("block") * LEAF + F.col("o") + 1).alias("depth"),
        F.slice("names", F.lit(1), F.col("o") + 1).alias("above"),
        "bytes",
    )
    members_of = [F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("total").alias("longest")]
    nodes = each.groupBy("name", "depth", "above", "bytes").agg(*members_of)
    root = members.agg(*members_of).where("n_convs > 0")
    root = root.select(_root().alias("name"), F.lit(0).cast("long").alias("depth"), F.array().cast("array<binary>").alias("above"), F.lit(0).cast("long").alias("bytes"), "conv_id", "n_convs", "longest")
    leaf = (F.col("longest") == F.col("depth")).cast("long").alias("leaf")
    return nodes.unionByName(root).select("name", "depth", "conv_id", "n_convs", leaf, ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"), "above")


def _in_blocks(nodes: DataFrame) -> DataFrame:
    """The nodes with n_children, and leaves and saved summed over the part of their subtree before the next cut."""
    is_cut = F.col("depth") % LEAF == 0
    up = nodes.select(is_cut.alias("cut"), "leaf", "saved", F.size("above").alias("n"), F.posexplode("above").alias("k", "name"))
    zero = F.lit(0).cast("long")
    sums = up.groupBy("name").agg(
        F.sum((F.col("k") == F.col("n") - 1).cast("long")).alias("n_children"),
        F.sum(F.when(F.col("cut"), zero).otherwise(F.col("leaf"))).alias("more_leaves"),
        F.sum(F.when(F.col("cut"), zero).otherwise(F.col("saved"))).alias("more_saved"),
    )
    return nodes.join(sums, "name", "left").select(
        "name", "depth", "conv_id", "n_convs", "above",
        F.coalesce("n_children", zero).alias("n_children"),
        (F.col("leaf") + F.coalesce("more_leaves", zero)).alias("leaves"),
        (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved"),
    )


def _plus(base: DataFrame, more: DataFrame) -> DataFrame:
    """base with leaves and saved raised by the sums of ``more`` (to, leaves, saved) by name."""
    sums = more.groupBy(F.col("to").alias("name")).agg(F.sum("leaves").alias("_l"), F.sum("saved").alias("_s"))
    zero = F.lit(0)
    return base.join(sums, "name", "left").withColumns({"leaves": F.col("leaves") + F.coalesce("_l", zero), "saved": F.col("saved") + F.coalesce("_s", zero)}).drop("_l", "_s")


def _graft(local: DataFrame, cuts: list[DataFrame]) -> DataFrame:
    """name, leaves and saved over the whole subtree, for the root and each cut prefix."""
    sums = local.select("name", "leaves", "saved")
    # upward: a cut of level j sums up to the next cut of its level or above; it goes to its anchor
    grown: list[DataFrame] = []
    gifts: list[DataFrame] = []
    low_bit = lambda c: c.bitwiseAND(-c)
    for level, at in enumerate(cuts):
        own = at.select("name", "anchor", "block").distinct().join(sums, "name")
        to_here = [g.where(low_bit(F.col("target")) == (1 << level)) for g in gifts]
        own = staged(_plus(own, _union(to_here)) if to_here else own, "grown")
        grown.append(own)
        gifts.append(own.select(F.col("anchor").alias("to"), (F.col("block") - (1 << level)).alias("target"), "leaves", "saved"))
    root = _plus(local.where("depth = 0").select("name", "leaves", "saved"), _union([g.where("target = 0") for g in gifts]))
    # downward: what begins at the next cut of a higher level is added
    whole: list[DataFrame] = []
    at_all = _union(cuts).select("conv_id", "block", F.col("name").alias("below"))
    for level in range(len(cuts) - 1, -1, -1):
        own = grown[level].select("name", "leaves", "saved")
        if whole:
            link = cuts[level].select("conv_id", (F.col("block") + (1 << level)).alias("block"), "name").join(at_all, ["conv_id", "block"])
            link = link.select(F.col("name").alias("to"), "below").distinct()
            own = _plus(own, link.join(_union(whole).withColumnRenamed("name", "below"), "below"))
        whole.append(staged(own, "whole"))
    return _union([*whole, root])


def trie(turns: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie of sequences, and (name, conv_id) of the node that each sequence ends at.

    turns: conv_id, place, digest, bytes, total; members: conv_id, total.
    Nodes: name, parent, depth, conv_id (smallest member), n_convs, n_children, leaves, saved.
    """
    blocks = staged(_blocks(turns), "blocks")
    cuts = _cut_prefixes(blocks)
    prefixes = staged(_prefixes(blocks, cuts), "prefixes")
    local = staged(_in_blocks(staged(_nodes(prefixes, members), "nodes")), "local")
    parent = F.element_at(F.when(F.size("above") > 0, F.col("above")), -1).alias("parent")
    nodes = local.select("name", parent, "depth", "conv_id", "n_convs", "n_children", "leaves", "saved")
    if cuts:
        whole = _graft(local, cuts)
        inner = local.where((F.col("depth") % LEAF == 0) & (F.col("depth") > 0)).select("name", F.explode(F.slice("above", 2, LEAF)).alias("to"))
        nodes = _plus(nodes, inner.join(whole, "name"))
        whole = whole.select("name", F.col("leaves").alias("_l"), F.col("saved").alias("_s"))
        nodes = nodes.join(whole, "name", "left").withColumns({"leaves": F.coalesce("_l", "leaves"), "saved": F.coalesce("_s", "saved")}).drop("_l", "_s")
    last = F.col("total") - F.col("block") * LEAF
    ends = prefixes.where(last.between(1, LEAF)).select(F.element_at("names", (last + 1).cast("int")).alias("name"), "conv_id")
    return nodes, ends.union(members.where("total = 0").select(_root().alias("name"), "conv_id"))


# ---------------------------------------------------------------- lists of ends
def list_digests(ends: DataFrame) -> DataFrame:
    """name and ``digest``: SHA-256 of the name's ids, ascending, as decimals with commas between.

    Ids are dealt out by ranges of (name, id), so the ids of one name may fill
    many tasks. A list that lies inside one task is digested there; the others
    are written down in pieces of bounded size, which one task per name reads
    in order (a digest has no parallel form) and never holds together.
    """
    spark, n = ends.sparkSession, _partitions(ends.sparkSession)
    dealt = ends.repartitionByRange(n, "name", "conv_id").sortWithinPartitions("name", "conv_id").withColumn("part", F.spark_partition_id())

    def rows(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.string()]
        columns = list(zip(*found, strict=True)) if found else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["name", "part", "k", "piece", "digest"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, size, k, part, inside = None, [], 0, 0, 0, False
        for batch in batches:
            found = []
            for own, conv_id, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if own != name:
                    if held:
                        text = ",".join(held).encode()
                        found.append((name, part, k, None, hashlib.sha256(text).hexdigest()) if inside and not k else (name, part, k, text, None))
                    inside, name, held, size, k = name is not None, own, [], 0, 0
                held.append(str(conv_id))
                size += len(held[-1]) + 1
                if size > PIECE_BYTES:
                    found.append((name, part, k, ",".join(held).encode(), None))
                    held, size, k = [], 0, k + 1
            yield rows(found)
        if held:
            yield rows([(name, part, k, ",".join(held).encode(), None)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, digest = None, None
        for batch in batches:
            names, digests = [], []
            for own, piece, done in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                if own != name:
                    if digest is not None:
                        names.append(name)
                        digests.append(digest.hexdigest())
                    name, digest = own, None
                if done is not None:
                    names.append(own)
                    digests.append(done)
                elif digest is None:
                    digest = hashlib.sha256(piece)
                else:
                    digest.update(b"," + piece)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], names=["name", "digest"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([digest.hexdigest()])], names=["name", "digest"])

    pieces = dealt.mapInArrow(write, "name binary, part int, k long, piece binary, digest string")
    return pieces.repartition(n, "name").sortWithinPartitions("name", "part", "k").mapInArrow(read, "name binary, digest string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations: one row per node, with its parent and the digest of the conversations that end there."""
    turns, members = rebuilt(turns_of(conversations))
    nodes, ends = trie(turns, members)
    nodes = staged(nodes, "trie")
    owners = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # the children of the root may be a large share of all nodes; their parent is one row
    root = nodes.where("depth = 0").select("conv_id").scalar()
    top = nodes.where("depth < 2").withColumn("parent_conv_id", F.when(F.col("depth") == 1, root))
    deep = nodes.where("depth >= 2").join(owners, "parent")
    both = top.unionByName(deep).join(list_digests(ends), "name", "left")
    return both.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
