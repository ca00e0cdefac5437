"""Corpus pipeline: each stage takes documents, applies one operator and returns what is kept of them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.llm import bpe, decontam, langid, minhash, secrets
from innkeep.llm.common import staged

VOCABULARY_FILE = "byte_bpe_50k.tiktoken"
#: Least similarity of near-duplicates in the corpus, in percent (85 is the contract of query op10 only).
NEAR_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not told clearly go; if no document has a label to learn from, all stay."""
    dictionaries = langid.fit(docs)
    if not dictionaries:
        return docs
    found = langid.identify(docs, dictionaries)
    return found.where(~F.col("rejected")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays: that with the smallest id (a null id last, of one id the smallest text hash)."""
    dropped = staged(minhash.surplus(docs.select("doc_id", "text"), percent=NEAR_PERCENT), "dropped")

    def is_in(rows: DataFrame, how: str) -> DataFrame:
        n = rows.count()
        rows = F.broadcast(rows) if n <= minhash.BROADCAST_IDS else rows
        return docs.join(rows, docs["doc_id"].eqNullSafe(rows["_id"]) & (F.xxhash64(docs["text"]) == rows["_hash"]), how)

    out = is_in(dropped, "left_anti")
    copied = dropped.where("stays")
    if copied.limit(1).count():
        out = out.union(is_in(copied, "left_semi").dropDuplicates(["doc_id", "text"]))
    return out


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.find_leaks(docs, benchmark).where(F.col("n_hit") == 0).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; the secrets in their texts are masked."""
    return secrets.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document; a document whose ids do not decode to its text fails the job."""
    vocabulary = bpe.broadcast_vocabulary(spark, public_tokenizers.path(VOCABULARY_FILE))
    back = bpe.round_trip(docs, vocabulary)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return back.where(F.when(same, True).otherwise(F.raise_error(F.lit("decoded text differs")).cast("boolean"))).drop("decoded")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mask_secrets", mask_secrets),
    ("tokenize", tokenize),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
