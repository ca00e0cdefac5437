"""The corpus pipeline against a brute-force version, and its stages on odd inputs."""

from __future__ import annotations

import base64
import random

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from innkeep.llm import langid, minhash

from . import brute
from .test_operators import folder

SECRET = "token = " + "0123456789abcdef" * 2
ITEM = "which of these nine rivers flows north through the quiet valley towards sea"


def texts():
    r = random.Random(7)
    en = ["the", "house", "river", "walked", "through", "north", "quickly", "window", "and", "children", "reading", "thought"]
    de = ["der", "und", "straße", "gelaufen", "zwischen", "fenster", "schnell", "kinder", "gedacht", "über", "nicht", "lesen"]
    rows = []
    for i in range(120):
        words = [w + r.choice(["", "s", "ing"] if i % 2 else ["", "en", "ung"]) for w in r.choices(en if i % 2 else de, k=r.randint(30, 120))]
        if i % 10 == 3:
            words[5:5] = [SECRET]
        if i % 17 == 4:
            words[9:9] = ITEM.upper().split()
        rows.append((i, " ".join(words)))
    rows += [(200 + k, rows[k][1]) for k in range(0, 40, 3)]
    rows += [(300 + k, rows[k][1] + " end") for k in range(0, 30, 4)]
    rows += [(400, None), (401, "12345 !!"), (402, "")]
    return rows


def expected(spark, path, rows):
    dictionaries = langid.fit(spark.read.parquet(f"{path}/documents.parquet"))
    classifier = langid.Classifier(dictionaries)
    rows = [(i, t) for i, t in rows if not classifier.predict(t)[2]]
    kept = {i for i, _, _, keep in brute.near_duplicates(rows) if keep}
    rows = [(i, t) for i, t in rows if i in kept]
    clean = {i for i, *_, hit in brute.leaks(rows, [(1, ITEM)]) if not hit}
    rows = [(i, t) for i, t in rows if i in clean]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for i, t in rows:
        masked, last = [], 0
        for a, _, b, _ in brute.secret_spans(t):
            if a >= last:
                masked += [t[last:a], "[SECRET]"]
            last = max(last, b)
        text = "".join([*masked, t[last:]])
        out.append((i, text, library.encode_ordinary(text)))
    return out


def test_pipeline(spark, tmp_path):
    rows = texts()
    path = folder(spark, tmp_path, rows, items=[(1, ITEM)])
    got = corpus_pipeline.run(spark, path)
    assert {"doc_id", "text", "lang", "source", "n_chars", "n_tokens", "token_ids"} <= set(got.columns)
    found = sorted((r["doc_id"], r["text"], list(r["token_ids"])) for r in got.collect())
    want = sorted(expected(spark, path, rows))
    assert found == want
    assert 80 < len(want) < 120 and any("[SECRET]" in t for _, t, _ in want) and not any(ITEM.upper() in t for _, t, _ in want)


def test_stages_on_empty_and_odd_documents(spark, tmp_path):
    for name, rows in (("edges", brute.EDGES), ("empty", [])):
        path = folder(spark, tmp_path / name, rows)
        docs = spark.read.parquet(f"{path}/documents.parquet").selectExpr("*", "1 AS _id", "'x' AS ids", "2 AS kept", "3 AS _dropped")
        for stage_name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, path)
            assert out.count() <= docs.count(), stage_name
            if stage_name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns, stage_name


def test_stages_take_effect_in_the_stated_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mask_secrets", "tokenize"]


def pairs_at_the_threshold():
    """Pairs of texts of similarity 0.80 to 0.85, and pairs of four and five shingles that share four."""
    r = random.Random(3)
    words = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    out = []
    for k in range(60):
        base, short = words(100 if k % 2 else 400), words(8)
        out += [base, [*base, *words((len(base) - 4) * r.randint(18, 25) // 100)], short, [*short, *words(1)]]
    return list(enumerate(" ".join(t) for t in out))


def test_near_dedup_stage_at_its_threshold(spark, tmp_path):
    rows = pairs_at_the_threshold()
    path = folder(spark, tmp_path, rows)
    want = sorted(i for i, _, _, keep in brute.near_duplicates(rows, 80) if keep)
    assert len(want) == 120 and all(keep for *_, keep in brute.near_duplicates(rows, 85))
    found = corpus_pipeline.near_dedup(spark, spark.read.parquet(f"{path}/documents.parquet"), path)
    assert sorted(r["doc_id"] for r in found.collect()) == want


def test_runs_at_the_thresholds():
    def missed(share):
        """Probability that SKETCH values, each shared with that probability, hold no run of RUN shared ones."""
        state = [1.0, *[0.0] * (minhash.RUN - 1)]
        for _ in range(minhash.SKETCH):
            state = [sum(state) * (1 - share), *(x * share for x in state[:-1])]
        return sum(state)

    assert missed(0.85) < 1e-9 and missed(0.80) < 1e-7
    assert [minhash.short_union(p) for p in (80, 81, 85, 99, 100)] == [5, 0, 0, 0, 0]
    with pytest.raises(ValueError, match="threshold"):
        minhash.near_duplicates(None, percent=minhash.LEAST_PERCENT - 1)


def test_near_dedup_stage_keeps_one_row_of_each_group(spark, tmp_path):
    r = random.Random(9)
    a, b, c, d, e = (" ".join(f"w{r.randrange(10**6)}" for _ in range(80)) for _ in range(5))
    groups = [
        [(1, a), (None, a + " end"), (7, a + " more")],
        [(None, b), (None, b), (None, b + " end")],
        [(7, c), (7, c), (7, c + " end")],
        [(None, d)],
        [(7, e)],
    ]
    path = folder(spark, tmp_path, [row for g in groups for row in g] + [(None, None), (None, None), (7, ""), (7, "")])
    found = corpus_pipeline.near_dedup(spark, spark.read.parquet(f"{path}/documents.parquet"), path)
    rows = [(x["doc_id"], x["text"]) for x in found.collect()]
    assert [sum(row in g for row in rows) for g in groups] == [1] * 5
    assert (1, a) in rows and sum(not t for _, t in rows) == 4 and len(rows) == 9


def test_without_labels_all_documents_stay(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, None)], "doc_id long, text string, lang string")
    assert sorted(map(str, corpus_pipeline.language_id(spark, docs, "").collect())) == sorted(map(str, docs.collect()))
