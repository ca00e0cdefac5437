"""Delta-maintained token counts by source, language and tokenizer version.

A batch of changes (inserted, deleted, revised counts) becomes signed deltas,
added up per group, in a folder of its own. A batch takes effect with a commit
marker that names its folder; the marker is written aside and renamed without
overwriting, so it is whole or not there, and a batch counts once however often
it is sent or retried. Totals are the sum of the last snapshot and the
committed deltas that it does not hold. ``compact`` folds the batches that it
has listed, and no others, into a new snapshot and then retires their markers:
of a folded batch an empty file stays that tells its id is taken, which is
looked up by name and never read. So a reader lists the batches since the last
snapshot only. A marker that cannot be read (by an older writer that was lost)
counts as not committed, and the batch may be sent again.

Defined results: a null source, language or version is a group of its own; a
null count is 0. A revision moves a document from its old group and count to
the new ones. Repeated rows of a batch count each. An empty batch commits
nothing but its marker. Groups whose
documents and tokens are both 0 are not listed.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.sources.versioned import Files

GROUP = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def changes(op: str, docs: DataFrame, n_tokens: Column, tokenizer: Column, old: dict[str, Column] | None = None) -> DataFrame:
    """Change rows from documents with source and lang. old: for revisions, the columns that were counted before."""
    now = {"source": F.col("source"), "lang": F.col("lang"), "tokenizer": tokenizer, "n_tokens": n_tokens}
    before = now | (old or {})
    image = lambda columns: F.struct(*(c.cast("long" if k == "n_tokens" else "string").alias(k) for k, c in columns.items()))
    empty = F.lit(None).cast("struct<source:string,lang:string,tokenizer:string,n_tokens:bigint>")
    return docs.select(
        (image(before) if op in ("delete", "revise") else empty).alias("old"),
        (image(now) if op in ("insert", "revise") else empty).alias("new"),
    )


def signed_deltas(changed: DataFrame) -> DataFrame:
    """One row a group: documents and tokens to add. The old image counts negative; each task adds up before the shuffle."""
    signed = F.explode(
        F.filter(
            F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("row"))),
            lambda x: x["row"].isNotNull(),
        )
    )
    rows = changed.select(signed.alias("s")).select("s.sign", "s.row.*")
    return rows.groupBy(*GROUP).agg(
        F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.coalesce("n_tokens", F.lit(0))).cast("long").alias("n_tokens")
    )


class TokenRollup:
    """The rollup stored under a folder: deltas/, snapshots/, commits/ and folded/."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.files = Files(spark, self.path)

    def _at(self, *parts: str) -> str:
        return "/".join([self.path, *parts])

    def _read_mark(self, name: str) -> dict | None:
        """A marker's content; None if it is torn."""
        try:
            return json.loads(self.files.read(self._at("commits", name)))
        except ValueError:
            return None

    def _names(self, kind: str) -> list[str]:
        return sorted(n for n in self.files.names(self._at("commits")) if n.startswith(kind))

    def commits(self) -> dict[str, dict]:
        """The last snapshot's marker and those of batches, by name."""
        for _ in range(100):
            names = [*self._names("snapshot-")[-1:], *self._names("batch-")]
            try:
                return {n: m for n in names if (m := self._read_mark(n)) is not None}
            except Py4JJavaError as e:  # retired between listing and reading: the next listing has the snapshot
                if "FileNotFoundException" not in e.java_exception.getClass().getName():
                    raise
        raise RuntimeError("commit markers change too often to be read")

    def commit(self, batch_id: str, changed: DataFrame) -> bool:
        """Add a batch; False (and no effect) if one of that id was committed."""
        if not re.fullmatch(r"[A-Za-z0-9-]+", batch_id):
            raise ValueError("a batch id has letters, digits and hyphens")
        name = f"batch-{batch_id}"
        if self.files.exists(self._at("folded", name)):
            return False
        if self.files.exists(self._at("commits", name)):
            if self._read_mark(name) is not None:
                return False
            self.files.remove(self._at("commits", name))
        folder = f"deltas/{uuid.uuid4().hex}"  # another attempt writes elsewhere
        signed_deltas(changed).write.parquet(f"{self.path}/{folder}")
        return self.files.write_new(self._at("commits", name), json.dumps({"folder": folder}))

    def totals(self) -> DataFrame:
        """One row a group: ``n_docs`` and ``n_tokens``."""
        return self._totals(self.commits())

    def _totals(self, marks: dict[str, dict]) -> DataFrame:
        last = next((m for n, m in marks.items() if n.startswith("snapshot-")), {"batches": []})
        folders = [m["folder"] for n, m in marks.items() if n.startswith("batch-") and n not in set(last["batches"])]
        if "folder" in last:
            folders.append(last["folder"])
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(*(self._at(f) for f in folders))
        total = rows.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return total.where("n_docs != 0 or n_tokens != 0")

    def compact(self) -> bool:
        """Fold the batches committed so far into a snapshot; False if another compaction was first.

        The snapshot is made from the markers listed here: batches that come in
        meanwhile stay beside it.
        """
        marks = self.commits()
        batches = [n for n in marks if n.startswith("batch-")]
        before = next((n for n in marks if n.startswith("snapshot-")), "snapshot-000000000000")
        folder = f"snapshots/{uuid.uuid4().hex}"
        self._totals(marks).write.parquet(self._at(folder))
        name = f"snapshot-{int(before[9:]) + 1:012d}"
        if not self.files.write_new(self._at("commits", name), json.dumps({"folder": folder, "batches": batches})):
            self.files.remove(self._at(folder))
            return False
        for batch in batches:  # if this is lost midway, the snapshot still tells which are folded
            self.files.write_new(self._at("folded", batch), "")
            self.files.remove(self._at("commits", batch))
        self.files.remove(self._at("commits", before))
        return True
