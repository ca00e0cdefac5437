"""The registered queries of the operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.llm import bpe, decontam, langid, license_scan, lm_score, minhash, prefix_trie, quality, secrets, sentence_bpe, source_audit, suffix_dedup, token_rollup
from innkeep.llm.common import WORD, crc_mod, staged
from innkeep.session import staging_path

VOCABULARY_FILE = "byte_bpe_50k.tiktoken"
PIECES_FILE = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert all documents under two tokenizers, revise those with repeated lines, withdraw toxic ones; every batch is sent twice."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.coalesce("text", F.lit("")).alias("text"))
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    lines = F.split("text", "\n", -1)
    counted = docs.select(
        "doc_id",
        "source",
        "lang",
        count(F.col("text"), WORD).alias("by_space"),
        count(F.col("text"), r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9\x20\x09-\x0D]").alias("by_class"),
        count(F.array_join(F.array_distinct(lines), "\n"), WORD).alias("cleaned"),
    )
    counted = staged(counted, "token-counts")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    version = {"by_space": F.lit("space-1"), "by_class": F.lit("class-1")}
    cleaned = F.col("cleaned")
    batches = [
        ("load-space", "insert", counted, F.col("by_space"), version["by_space"], None),
        ("load-class", "insert", counted, F.col("by_class"), version["by_class"], None),
        ("clean-lines", "revise", counted.where(cleaned != F.col("by_space")), cleaned, version["by_space"], {"n_tokens": F.col("by_space")}),
        ("withdraw", "delete", counted.join(toxic, "doc_id", "left_semi"), cleaned, version["by_space"], None),
    ]
    rollup = token_rollup.TokenRollup(spark, staging_path(spark, "token-rollup"))
    for batch_id, op, rows, n_tokens, tokenizer, old in batches:
        changed = token_rollup.changes(op, rows, n_tokens, tokenizer, old)
        rollup.commit(batch_id, changed)
        rollup.commit(batch_id, changed)
        if batch_id == "load-class":
            rollup.compact()
    return rollup.totals()


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, lang, coalesce(text, '') AS text,
         list_filter(list_transform(range(len(string_split(coalesce(text, ''), chr(10)))), lambda i: CASE WHEN list_position(string_split(coalesce(text, ''), chr(10)), string_split(coalesce(text, ''), chr(10))[i + 1]) = i + 1 THEN string_split(coalesce(text, ''), chr(10))[i + 1] END), lambda x: x IS NOT NULL) AS lines
  FROM documents),
c AS (
  SELECT doc_id, source, lang,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS by_space,
         len(regexp_extract_all(text, '[A-Za-z]+|[0-9]+|[^A-Za-z0-9\x20\x09-\x0D]')) AS by_class,
         len(regexp_extract_all(array_to_string(lines, chr(10)), '[^\x20\x09-\x0D]+')) AS cleaned
  FROM d),
kept AS (
  SELECT source, lang, 'space-1' AS tokenizer, cleaned AS n FROM c WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)
  UNION ALL
  SELECT source, lang, 'class-1' AS tokenizer, by_class AS n FROM c)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM kept GROUP BY ALL
"""


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = bpe.broadcast_vocabulary(spark, public_tokenizers.path(VOCABULARY_FILE))
    ids = bpe.encode(docs, vocabulary).select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"))
    return bpe.decode(ids, vocabulary).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality.judge(docs, keep=["doc_id"])


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    dictionaries = langid.fit(docs.where(~held_out))
    found = langid.identify(docs.select("doc_id", "text"), dictionaries)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = license_scan.best_license(F.col("licenses"))
    found = found.select("doc_id", F.size("licenses").cast("long").alias("n_notices"), best.alias("best"))
    return found.select(
        "doc_id", "n_notices", F.col("best.license").alias("license"), F.round(-F.col("best.c"), 4).alias("coverage"), F.col("best.start").alias("start"), F.col("best.end").alias("end")
    )


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 7) == 2
    found = lm_score.score(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs)
    spans, base = F.col("spans"), F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *(count(k.name) for k in secrets.BASE_KINDS),
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: ~s["base"])).cast("long").alias("n_linked"),
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_sentence_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = sentence_bpe.broadcast_model(spark, public_tokenizers.path(PIECES_FILE))
    listed = F.concat_ws(" ", F.col("token_ids").cast("array<string>"))
    ids = sentence_bpe.encode(docs, model).select("doc_id", "n_tokens", "token_ids", F.sha2(listed, 256).alias("ids_sha256"))
    return sentence_bpe.decode(ids, model).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


OP12_SQL = r"""
WITH rows_ AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t, turn FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, r, t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(r) || ':' || r || t)) - 1 AS place FROM rows_),
lens AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
             lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda k: 0::UBIGINT)), lambda v, k: xor(v >> 1, 3988292384::UBIGINT * (v & 1)))), 4294967295::UBIGINT) % 9 AS h
  FROM turns GROUP BY conv_id),
members AS (
  SELECT c.conv_id, c.base, c.h::BIGINT AS h, least(c.h::BIGINT, coalesce(b.n, 0)) AS head, least(c.h::BIGINT, coalesce(b.n, 0)) + greatest(c.n - c.h::BIGINT, 0) AS total
  FROM lens c LEFT JOIN lens b ON b.conv_id = c.base),
seqs AS (
  SELECT m.conv_id, m.total, t.place - m.h + m.head + 1 AS d, t.r, t.t FROM members m JOIN turns t ON t.conv_id = m.conv_id WHERE t.place >= m.h
  UNION ALL
  SELECT m.conv_id, m.total, t.place + 1, t.r, t.t FROM members m JOIN turns t ON t.conv_id = m.base WHERE t.place < m.h),
paths AS (
  SELECT conv_id, total, d, strlen(t) AS bytes, list({'r': r, 't': t}) OVER (PARTITION BY conv_id ORDER BY d) AS path FROM seqs
  UNION ALL
  SELECT conv_id, total, 0, 0, [] FROM members),
nodes AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved, (max(total) = d)::INT AS leaf,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (total = d), '') AS ends
  FROM paths GROUP BY d, path),
placed AS (
  SELECT p.conv_id AS member, p.d, n.conv_id, n.saved, n.leaf FROM paths p JOIN nodes n ON n.d = p.d AND n.path = p.path),
pairs AS (
  SELECT DISTINCT a.conv_id AS up, a.d AS up_d, b.conv_id, b.d, b.saved, b.leaf FROM placed a JOIN placed b ON a.member = b.member AND a.d <= b.d),
sums AS (
  SELECT up AS conv_id, up_d AS d, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens, count(*) FILTER (pairs.d = up_d + 1) AS n_children FROM pairs GROUP BY ALL),
parents AS (
  SELECT DISTINCT b.conv_id, b.d, a.conv_id AS parent_conv_id FROM placed a JOIN placed b ON a.member = b.member AND a.d + 1 = b.d)
SELECT n.conv_id::BIGINT AS conv_id, n.d::BIGINT AS depth, p.parent_conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs, s.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN sums s ON s.conv_id = n.conv_id AND s.d = n.d LEFT JOIN parents p ON p.conv_id = n.conv_id AND p.d = n.d
"""


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
tokens AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM tokens GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM tokens t JOIN kept k ON k.lang = t.lang AND k.term = t.term GROUP BY ALL),
sums AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(s.n, 0) + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 5)) // (l.n + 5 * l.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_bpe": op2_bpe,
    "op3_license_scan": op3_license_scan,
    "op4_lm_score": op4_lm_score,
    "op5_secrets": op5_secrets,
    "op6_quality": op6_quality,
    "op7_langid": op7_langid,
    "op8_decontamination": op8_decontamination,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_minhash": op10_minhash,
    "op11_sentence_bpe": op11_sentence_bpe,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_source_audit": op13_source_audit,
}
ORACLES: dict[str, str] = {"op1_token_counts": OP1_SQL, "op12_prefix_trie": OP12_SQL, "op13_source_audit": OP13_SQL}
