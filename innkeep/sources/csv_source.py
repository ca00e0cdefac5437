"""Raw CSV extracts: header row, UTF-8, every field text, ``""`` as an escaped quote.

Columns are matched by *name* from each file's own header (order in the file
does not matter); the 32 expected names must all be present in every file,
extra names are reported and dropped. The text is read once: fields are staged
by place as they are split, with what tells header rows and records that span
lines, and names are given when the staged fields are read. Only files in which
a record spans lines are read again, split by split. A field that a short row
lacks reads as ``''``, like an empty one.
"""

from __future__ import annotations

import csv
import logging
import re
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.schema import RAW_COLUMNS
from innkeep.session import remove_staged, staging_path
from innkeep.sources import csv_records as records

log = logging.getLogger(__name__)

CORRUPT = "_corrupt_record"

CSV_WRITE_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


@dataclass(frozen=True)
class SchemaReport:
    columns: tuple[str, ...]
    missing: tuple[str, ...]
    extra: tuple[str, ...]

    @property
    def ok(self) -> bool:
        return not self.missing


def check_columns(columns: list[str], expected: list[str] = RAW_COLUMNS) -> SchemaReport:
    """Compare a header with the expected names (case-sensitive, order-free)."""
    cols = tuple(columns)
    missing = tuple(c for c in expected if c not in cols)
    extra = tuple(c for c in cols if c not in expected)
    return SchemaReport(cols, missing, extra)


FILE_NAME = "_file_name"
# More distinct header lines than this in one scan is an error, not a data set.
MAX_HEADERS = 1_000
# Files with records that span lines, named one by one; beyond it all files are read that way.
NAMED_FILES = 10_000
# Up to this many different headers a value is chosen by the file's header, beyond it from an array of all fields.
CHOSEN_LAYOUTS = 16
# Bytes a file takes in the broadcast table of files (name, header), and the most that is broadcast.
FILE_BYTES, FILES_LIMIT_BYTES = 512, 64 << 20


def _literal(spark: SparkSession, path: str) -> str:
    """``path`` with glob characters escaped if a file or folder of exactly that name exists."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return escape_glob(path) if fs.exists(target) else path


def escape_glob(path: str) -> str:
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


class CsvBatch:
    """The records of CSV files, staged by place; ``remove()`` deletes what was staged.

    ``multi_line``: ``"auto"`` (default) reads files as whole records in the
    one pass and again as spanning records where a line is no whole record;
    ``True`` takes all files as the latter, ``False`` none (each line is a
    record then). The result depends on the text alone, never on its size or
    on how it is split.
    """

    def __init__(self, spark: SparkSession, path: str | list[str], multi_line: bool | str = "auto", expected: list[str] | None = None) -> None:
        self.spark = spark
        self.paths = [_literal(spark, p) for p in ([path] if isinstance(path, str) else path)]
        self.staged: list[str] = []
        first = spark.read.text(self.paths).limit(1).collect()
        self.width = len(next(csv.reader([first[0][0]]), [])) if first else 0
        self.width = max(self.width, len(expected or ()), 1)
        self.marks = [expected[0], expected[-1]] if expected else []
        if multi_line is True:
            self.rows = self._stage(records.spanning_records(spark, self.paths))
        else:
            self.rows = self._read_lines(multi_line == "auto")
        self._find_headers()

    # ------------------------------------------------------------ reading
    def _placed(self, found: DataFrame) -> DataFrame:
        """Fields as columns c0, c1, ...; those beyond the first file's width in ``more``."""
        fields, text = F.col("fields"), F.concat_ws(",", "fields")
        head = F.col("block") == 0
        for name in self.marks:  # a header holds all expected names
            head = head & text.contains(name)
        at = [F.get(fields, i).alias(f"c{i}") for i in range(self.width)]
        more = F.when(F.size(fields) > self.width, F.slice(fields, self.width + 1, 1 << 20)).alias("more")
        return found.select("file", "block", "id", F.size(fields).alias("n"), *at, more, F.coalesce(head, F.lit(False)).alias("maybe_head"), *[c for c in found.columns if c == "whole"])

    def _stage(self, found: DataFrame) -> DataFrame:
        path = staging_path(self.spark, "csv-records")
        self.staged.append(path)
        placed = self._placed(found)
        # maybe_head is a plain column: as a partition it would sort all rows of a task, and the pages of the few
        # rows that may be headers are found by the column's statistics
        # without dictionaries a file's size tells its rows: few bytes for many repeated values would make splits of
        # millions of rows, which a task that sorts them must hold
        placed.write.option("parquet.enable.dictionary", "false").parquet(path)
        return self.spark.read.schema(placed.schema).parquet(path)

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        path = staging_path(self.spark, name)
        self.staged.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _read_lines(self, auto: bool) -> DataFrame:
        line = F.col("line")
        text = records.lines(self.spark, self.paths).where(~records.is_blank(line))
        text = text.withColumn("line", F.when((F.col("block") == 0) & line.startswith("\ufeff"), F.substring(line, 2, 1 << 30)).otherwise(line))
        found = self._stage(text.select("file", "block", "id", records.fields_of(line).alias("fields"), records.is_whole(line).alias("whole")))
        rows = found.drop("whole")
        if not auto:
            return rows
        broken = found.where("NOT whole").select("file").distinct()
        names = [r["file"] for r in broken.limit(NAMED_FILES + 1).collect()]
        if not names:
            return rows
        paths = [escape_glob(unquote(n)) for n in names] if len(names) <= NAMED_FILES else self.paths
        again = self._stage(records.spanning_records(self.spark, paths))
        if len(names) > NAMED_FILES:
            return again
        return rows.where(~F.col("file").isin(names)).unionByName(again)

    # ------------------------------------------------------------ headers
    def _find_headers(self) -> None:
        at = F.struct("block", "id")
        first = self._kept(self.rows.groupBy("file").agg(F.min(at).alias("at")).select("file", "at.block", "at.id"), "csv-first")
        every = F.concat(F.array(*[F.col(f"c{i}") for i in range(self.width)]), F.coalesce("more", F.array().cast("array<string>")))

        def heads(rows: DataFrame) -> DataFrame:
            own = rows.join(first, ["file", "block", "id"])
            return self._kept(own.select("file", "block", "id", F.slice(every, F.lit(1), F.greatest("n", F.lit(1))).alias("names")), "csv-headers")

        self.files = first.count()
        for rows in (self.rows.where("maybe_head"), self.rows):
            self.heads = heads(rows)
            counts = [F.min("file").alias("example"), F.count(F.lit(1)).alias("n")]
            kinds = self.heads.groupBy("names").agg(*counts).limit(MAX_HEADERS + 1).collect()
            if sum(k["n"] for k in kinds) == self.files or len(kinds) > MAX_HEADERS:
                break  # else a file lacks expected names, which will be told
        if len(kinds) > MAX_HEADERS:
            raise ValueError(f"over {MAX_HEADERS} different CSV headers")
        clean = lambda names: [n.lstrip("\ufeff") if k == 0 else n for k, n in enumerate(names)]
        # as the names stand, cleaned, and one of the files
        self.headers = sorted((list(k["names"]), clean(k["names"]), unquote(k["example"])) for k in kinds)

    def _data(self) -> DataFrame:
        """Records without the header rows: those that may be one are few."""
        maybe = self.rows.where("maybe_head")
        heads = self.heads.select("file", "block", "id")
        return self.rows.where("NOT maybe_head").unionByName(maybe.join(heads, ["file", "block", "id"], "left_anti").select(*self.rows.columns))

    def frame(self, columns: list[str] | None = None) -> DataFrame:
        """``columns`` (default: those of the headers, which must be the same then), ``_corrupt`` rows marked, and the file's name."""
        names = list(columns or (self.headers[0][1] if self.headers else []))
        for _, header, example in self.headers:
            report = check_columns(header, names)
            if report.missing:
                raise ValueError(f"{example} lacks the columns {sorted(report.missing)}")
            if report.extra:
                log.warning("columns that are not read from %s: %s", example, sorted(report.extra))
        rows = self._data()
        field = lambda i: F.col(f"c{i}") if i < self.width else F.get(F.col("more"), i - self.width)
        if len(self.headers) <= 1:
            header = self.headers[0][1] if self.headers else names
            values, size = [field(header.index(c)) for c in names], F.lit(len(header))
        else:
            # each file's header as the places of the columns that are read
            layouts = [(real, [header.index(c) for c in names], len(header), n) for n, (real, header, _) in enumerate(self.headers)]
            known = F.broadcast(self.spark.createDataFrame(layouts, "names array<string>, places array<int>, size int, layout int"))
            files = self.heads.join(known, "names").select("file", "places", "size", "layout")
            rows = rows.join(F.broadcast(files) if self.files * FILE_BYTES <= FILES_LIMIT_BYTES else files, "file")
            values, size = self._by_layout([places for _, places, _, _ in layouts], field), F.col("size")
        file = F.url_decode(F.replace(F.element_at(F.split("file", "/"), -1), F.lit("+"), F.lit("%2B")))
        return rows.select(*[v.alias(c) for v, c in zip(values, names, strict=True)], (F.col("n") != size).alias(CORRUPT), file.alias(FILE_NAME))

    def _by_layout(self, places: list[list[int]], field: Callable[[int], Column]) -> list[Column]:
        """Each column's value, by the place it has in the file's layout."""
        if len(places) > CHOSEN_LAYOUTS:
            every = F.concat(F.array(*[F.col(f"c{i}") for i in range(self.width)]), F.coalesce("more", F.array().cast("array<string>")))
            return [F.get(every, F.get("places", i)) for i in range(len(places[0]))]
        values = []
        for at in zip(*places, strict=True):
            value = field(at[0])
            for place in sorted(set(at) - {at[0]}):
                value = F.when(F.col("layout").isin([n for n, p in enumerate(at) if p == place]), field(place)).otherwise(value)
            values.append(value)
        return values

    def remove(self) -> None:
        for path in self.staged:
            remove_staged(self.spark, path)
        self.staged = []


def schema_reports(spark: SparkSession, path: str | list[str], expected: list[str] = RAW_COLUMNS) -> list[SchemaReport]:
    """The header check of every different header among the files."""
    batch = CsvBatch(spark, path, expected=expected)
    try:
        return [check_columns(list(names), expected) for names in sorted({tuple(names) for _, names, _ in batch.headers})]
    finally:
        batch.remove()


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool | str = "auto",
    infer_types: bool = False,
    columns: list[str] | None = None,
) -> DataFrame:
    """CSV extracts, a file or folder whose files may have different headers, staged in the shared folder.

    Every file is read by its own header, and files are united by column
    name. ``columns``: the columns to keep; a file without one of them is an
    error that names both. Without ``columns`` all files must have the same
    names, in any order. The result has the file's name as ``_file_name`` and
    marks rows of too few or too many fields in ``_corrupt_record``.

    ``infer_types`` gives typed columns for exploration (see
    :func:`inferred_types`); the raw layer keeps text.
    """
    found = CsvBatch(spark, path, multi_line, columns).frame(columns)
    if not infer_types:
        return found
    names = [c for c in found.columns if c not in (CORRUPT, FILE_NAME)]
    kinds = inferred_types(found, names)
    typed = [F.when(F.trim(F.col(f"`{c}`")) != "", F.col(f"`{c}`")).try_cast(k).alias(c) if k != "string" else F.col(f"`{c}`") for c, k in kinds.items()]
    return found.select(*typed, FILE_NAME)


# The kinds a text may have, as bits; a column's kind follows from the bits of all its values.
_INT, _LONG, _DECIMAL, _DOUBLE, _DATE, _TIME, _BOOL, _TEXT = (1 << i for i in range(8))


def _kind(value: Column) -> Column:
    # each test only where those before it leave it open: most values pass one pattern
    number = value.rlike(r"^\s*[+-]?[0-9]+\s*\z")
    real = value.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z")
    whole = (
        F.when(value.try_cast("int").isNotNull(), _INT)
        .when(value.try_cast("long").isNotNull(), _LONG)
        .when(value.try_cast("decimal(38,0)").isNotNull(), _DECIMAL)
        .otherwise(_DOUBLE)
    )
    return (
        F.when(value.isNull() | (F.trim(value) == ""), 0)
        .when(~value.rlike("[0-9]"), F.when(F.lower(value).isin("true", "false"), _BOOL).otherwise(_TEXT))
        .when(number, whole)
        .when(real, _DOUBLE)
        .when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & value.try_cast("date").isNotNull(), _DATE)
        .when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9:.]+\z") & value.try_cast("timestamp").isNotNull(), _TIME)
        .otherwise(_TEXT)
    )


def _kinds(text: DataFrame, columns: list[str]) -> DataFrame:
    """The kinds of the columns' values, an array for each row.

    One function over the fields as an array: measured at half the time of an
    expression for each column.
    """
    return text.select(F.transform(F.array(*[F.col(f"`{c}`") for c in columns]), _kind).alias("kinds"))


def _join_of(bits: int) -> str:
    """The least type that holds all the kinds seen: int < long < decimal < double, date < timestamp, and text above all."""
    if bits and not bits & ~(_INT | _LONG | _DECIMAL | _DOUBLE):
        return next(t for b, t in ((_DOUBLE, "double"), (_DECIMAL, "decimal(38,0)"), (_LONG, "bigint"), (_INT, "int")) if bits & b)
    if bits and not bits & ~(_DATE | _TIME):
        return "timestamp" if bits & _TIME else "date"
    return "boolean" if bits == _BOOL else "string"


def inferred_types(text: DataFrame, columns: list[str]) -> dict[str, str]:
    """The type of each text column over all rows, whatever their order and files: one aggregate of OR-ed kinds.

    Empty fields have no kind; a column of nothing else is text.
    """
    seen = _kinds(text, columns).agg(*[F.bit_or(F.get("kinds", i)).alias(str(i)) for i in range(len(columns))]).first()
    return {c: _join_of(seen[i] or 0) for i, c in enumerate(columns)}


def scan_expected(spark: SparkSession, path: str | list[str], multi_line: bool | str = "auto", expected: list[str] = RAW_COLUMNS) -> DataFrame:
    """The expected columns of CSV extracts, the file name and the malformed flag."""
    return expected_columns(CsvBatch(spark, path, multi_line, expected), expected)


def expected_columns(batch: CsvBatch, expected: list[str] = RAW_COLUMNS) -> DataFrame:
    """The expected columns of a batch (blank or missing -> ``''``), the file name and the malformed flag."""
    found = batch.frame(expected)
    return found.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in expected], FILE_NAME, F.col(CORRUPT).alias("_malformed"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write text columns as a CSV extract with a header row."""
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)
    return path
