"""Versioned tables: Parquet folders that become visible when a log entry names them.

A table is a folder with ``data/<id>`` (what one write made) and ``_log``, one
small JSON entry per version. An entry lists the data folders of its version,
so a reader opens the latest entry and sees whole writes only; a failed write
leaves folders that no entry names. A version is published by renaming its
entry to the next number without overwriting (atomic in a distributed file
system). A writer that finds its number taken gets a :class:`Conflict` and
decides again on what was published meanwhile.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

LOG = "_log"


class Conflict(RuntimeError):
    """Another writer has published the version that was to be written."""


@dataclass(frozen=True)
class Entry:
    """One version: its data folders and rows, and what the writer noted."""

    version: int
    data: tuple[str, ...] = ()  # relative to the table's folder
    rows: int = 0  # -1: not counted
    notes: dict = field(default_factory=dict)


EMPTY = Entry(-1)


class Files:
    """The few file operations that Spark's readers and writers do not offer."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._root = self._path(path)
        self.fs = self._root.getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        target = self._path(path)
        return [s.getPath().getName() for s in self.fs.listStatus(target)] if self.fs.exists(target) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> bool:
        """Write a whole file under a new name; False if the name is taken."""
        scratch, target = self._path(f"{os.path.dirname(path)}/.{uuid.uuid4().hex}.tmp"), self._path(path)
        stream = self.fs.create(scratch, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        jvm = self._jvm.org.apache.hadoop.fs
        context = jvm.FileContext.getFileContext(self.fs.getUri(), self._conf)
        no_options = SparkContext._active_spark_context._gateway.new_array(jvm.Options.Rename, 0)
        try:
            context.rename(self.fs.makeQualified(scratch), self.fs.makeQualified(target), no_options)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e.java_exception.getClass().getName()):
                raise
            self.fs.delete(scratch, False)
            return False

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def remove(self, path: str) -> None:
        self.fs.delete(self._path(path), True)


class VersionedTable:
    """A folder of Parquet data whose versions are listed in its log."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.files = Files(spark, self.path)

    def versions(self) -> list[int]:
        found = self.files.names(f"{self.path}/{LOG}")
        return sorted(int(n[:-5]) for n in found if n.endswith(".json") and n[:-5].isdigit())

    def entry(self, version: int) -> Entry:
        made = json.loads(self.files.read(self._entry_path(version)))
        return Entry(version, tuple(made["data"]), made["rows"], made["notes"])

    def latest(self) -> Entry:
        """The last published version; version -1 without data if there is none."""
        versions = self.versions()
        if versions:
            return self.entry(versions[-1])
        if strange := [n for n in self.files.names(self.path) if n not in ("data", "_index", LOG)]:
            raise ValueError(f"{self.path} holds {strange[0]} but no log: not a versioned table of Parquet folders")
        return EMPTY

    def since(self, version: int) -> list[Entry]:
        """What was published after a version."""
        return [self.entry(v) for v in self.versions() if v > version]

    def _entry_path(self, version: int) -> str:
        return f"{self.path}/{LOG}/{version:020d}.json"

    def folder(self, kind: str = "data") -> str:
        """A new folder (relative) for what a writer makes; nothing there counts before it is published."""
        return f"{kind}/{uuid.uuid4().hex}"

    def at(self, folder: str) -> str:
        return f"{self.path}/{folder}"

    def publish(self, base: Entry, data: tuple[str, ...], rows: int, **notes) -> Entry:
        """Make a version that follows ``base``; :class:`Conflict` if another one does already."""
        made = Entry(base.version + 1, data, rows, notes)
        text = json.dumps({"data": list(data), "rows": rows, "notes": notes})
        if not self.files.write_new(self._entry_path(made.version), text):
            raise Conflict(f"{self.path}: version {made.version} is there already")
        return made

    def frame(self, entry: Entry | None = None) -> DataFrame | None:
        """The rows of a version (default: the latest), None before the first."""
        entry = entry or self.latest()
        if not entry.data:
            return None
        return self.spark.read.parquet(*map(self.at, entry.data))

    def replace(self, df: DataFrame, partition_by: list[str] | None = None, **notes) -> Entry:
        """Publish ``df`` as the whole table; readers keep the version before until then, also if the write fails."""
        folder = self._write(df, partition_by)
        while True:
            try:
                return self.publish(self.latest(), (folder,), -1, **notes)
            except Conflict:
                continue  # a refresh replaces whatever is there

    def append(self, df: DataFrame, **notes) -> Entry:
        """Publish the rows of ``df`` beside those of the latest version (no partition columns)."""
        folder = self._write(df)
        while True:
            base = self.latest()
            try:
                return self.publish(base, (*base.data, folder), -1, **notes)
            except Conflict:
                continue  # what others append stays

    def _write(self, df: DataFrame, partition_by: list[str] | None = None) -> str:
        folder = self.folder()
        writer = df.write.mode("errorifexists")
        try:
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.at(folder))
        except Exception:
            self.files.remove(self.at(folder))
            raise
        return folder

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove folders that none of the last ``keep`` versions names; returns them.

        Not to be run while a writer is at work: folders not yet published count as unnamed.
        """
        kept = {f for v in self.versions()[-keep:] for e in [self.entry(v)] for f in (*e.data, *(s["folder"] for s in e.notes.get("segments", [])))}
        gone = [f"{kind}/{n}" for kind in ("data", "_index") for n in self.files.names(f"{self.path}/{kind}") if f"{kind}/{n}" not in kept]
        for folder in gone:
            self.files.remove(self.at(folder))
        return gone


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The latest version of the table at ``path``; an error if there is none."""
    found = VersionedTable(spark, path).frame()
    if found is None:
        raise FileNotFoundError(f"{path}: no version was published")
    return found
