"""CSV text into rows of fields, in parallel also where records span lines.

A line is a *whole record* if no quote is open at its end and no carriage
return inside ends a record. Files of whole records are split into fields in
the scan itself: one pass over the text. For the others each line tells its
effect on the quote state (what state it ends in if it begins outside quotes,
and if it begins inside); each split folds its lines to one such effect, the
effects are combined in the order of the splits, and then all splits know the
state they begin in and are read at once. A record that crosses splits is put
together from its pieces.

Fields follow the usual rules (comma, double quotes, doubled inside; a quote
inside a bare field is an ordinary character) and equal those of Python's csv
reader on the same text; blank lines are no records.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,\r]*+|(?!")[^,\r]*+)'
#: Lines that leave the quotes closed, by how they begin.
CLOSED = rf"^{_FIELD}(?:[,\r]{_FIELD})*+\z"
CLOSED_FROM_INSIDE = rf'^[^"]*+(?:""[^"]*+)*+"[^,\r]*+(?:[,\r]{_FIELD})*+\z'
#: Order of the records put together from pieces, after all others of their split.
CROSSING = 1 << 48

RECORD = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("block", T.LongType()),  # where the split begins in the file
        T.StructField("id", T.LongType()),  # order of records in a split
        T.StructField("fields", T.ArrayType(T.StringType())),
    ]
)
#: A record, or a piece of one that crosses splits.
PIECE = T.StructType([*RECORD.fields, T.StructField("text", T.StringType()), T.StructField("owner", T.LongType())])


def lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, block, id and line of text files, as they are split by the scan (a carriage return stays)."""
    read = spark.read.option("lineSep", "\n").text(paths)
    return read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("line")
    )


def is_whole(line: Column) -> Column:
    quoted = line.contains('"')
    inner_return = line.rlike(r"\r(?!\z)")
    return ~inner_return & (~quoted | line.rlike(CLOSED))


def fields_of(line: Column) -> Column:
    """The fields of a whole record."""
    bare = F.regexp_replace(line, r"\r\z", "")
    parts = F.regexp_extract_all(F.concat(F.lit(","), bare), F.lit(r',("[^"]*+(?:""[^"]*+)*+"[^,]*+|[^,]*+)'), F.lit(1))
    inner = lambda f, g: F.regexp_extract(f, r'(?s)^"([^"]*+(?:""[^"]*+)*+)"(.*)\z', g)
    plain = F.transform(parts, lambda f: F.when(f.startswith('"'), F.concat(F.replace(inner(f, 1), F.lit('""'), F.lit('"')), inner(f, 2))).otherwise(f))
    return F.when(line.contains('"'), plain).otherwise(F.split(bare, ",", -1))


def is_blank(line: Column) -> Column:
    return (line == "") | (line == "\r")


# ---------------------------------------------------------------- records that span lines
def _with_effects(text: DataFrame) -> DataFrame:
    """The lines with the state after them, begun outside and begun inside quotes (True: inside)."""
    line = F.col("line")
    quoted = line.contains('"')
    return text.withColumns({"out": quoted & ~line.rlike(CLOSED), "in": ~quoted | ~line.rlike(CLOSED_FROM_INSIDE)})


def _splits(effects: DataFrame) -> DataFrame:
    """file, block, out, in, closes: the effect of each split, and whether one begun inside quotes leaves them."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ends, closes = None, [False, True], False
        names = ["file", "block", "out", "in", "closes"]
        for batch in batches:
            found = []
            for file, block, out, inside in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, block) != now:
                    if now:
                        found.append((*now, *ends, closes))
                    now, ends, closes = (file, block), [False, True], False
                ends = [inside if e else out for e in ends]
                closes = closes or not ends[1]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=names)
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*now, *ends, closes)], names=names)

    return effects.select("file", "block", "out", "in").mapInArrow(fold, "file string, block long, out boolean, in boolean, closes boolean")


def _starts(splits: DataFrame) -> DataFrame:
    """file, block, owner of the splits that begin inside quotes; owner: the split where the open record begins."""

    def combine(table: pa.Table) -> pa.Table:
        state, owner, found = False, None, []
        for row in table.sort_by("block").to_pylist():
            if state:
                found.append((row["file"], row["block"], owner))
            if not state or row["closes"]:
                owner = row["block"]  # if a record is open at its end, it begins here
            state = row["in"] if state else row["out"]
        columns = list(zip(*found, strict=True)) if found else [[], [], []]
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["file", "block", "owner"])

    return splits.groupBy("file").applyInArrow(combine, "file string, block long, owner long")


def _parse(text: str) -> Iterator[list[str]]:
    csv.field_size_limit(sys.maxsize)
    return (r for r in csv.reader(io.StringIO(text, newline="")) if r)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = [{"string": pa.string(), "bigint": pa.int64(), "array<string>": pa.list_(pa.string())}[f.dataType.simpleString()] for f in schema.fields]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=schema.names)


#: Characters of a fragment that are handed on at a time.
PIECE_CHARS = 1 << 20


def spanning_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, block, id and fields of files in which records may span lines and splits."""
    effects = _with_effects(lines(spark, paths))
    # at most one row for each split, those that begin inside a record
    starts = _starts(_splits(effects))
    known = effects.join(F.broadcast(starts), ["file", "block"], "left").select("file", "block", "line", "out", "in", "owner")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, head, owner, held, size, n = None, False, False, None, [], 0, 0

        def piece() -> tuple:
            return (*now, n, None, "\n".join(held) + "\n", owner if head else now[1])

        for batch in batches:
            done = []
            for file, block, line, out, inside, begun in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, block) != now:
                    if held:
                        done.append(piece())
                    now, state, head, owner, held, size, n = (file, block), begun is not None, begun is not None, begun, [], 0, 0
                held.append(line)
                size += len(line)
                state = inside if state else out
                if head and (not state or size > PIECE_CHARS):  # belongs to a record of an earlier split
                    done.append(piece())
                    held, size, n, head = [], 0, n + 1, state
                elif not head and not state:
                    for row in _parse("\n".join(held) + "\n"):
                        done.append((file, block, n, row, None, None))
                        n += 1
                    held, size = [], 0
            yield _batch(done, PIECE)
        if held:
            yield _batch([piece()], PIECE)

    def join(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("block", "ascending"), ("id", "ascending")]).to_pylist()
        found = _parse("".join(r["text"] for r in rows))
        made = [(rows[0]["file"], rows[0]["owner"], CROSSING + k, f) for k, f in enumerate(found)]
        return pa.Table.from_batches([_batch(made, RECORD)])

    found = known.mapInArrow(read, PIECE)
    whole = found.where("owner IS NULL").select(*RECORD.names)
    crossing = found.where("owner IS NOT NULL").groupBy("file", "owner").applyInArrow(join, RECORD)
    return whole.union(crossing)
