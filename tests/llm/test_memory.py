"""What Python workers hold on to between tasks (findings of round 3)."""

from __future__ import annotations

import os

import numpy as np
import pytest
import regex
from innkeep.llm import bpe, common

import corpus_pipeline


def held() -> int:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


@pytest.mark.skipif(not os.path.exists("/proc/self/statm"), reason="memory is read from /proc")
def test_free_memory_goes_back(spark):
    made = [bytes(1000) for _ in range(100_000)]
    kept = made[::1000]  # what is still in use stands between what is free
    before = held()
    del made
    common.give_back()
    assert before - held() > 50 << 20
    assert len(kept) == 100


def test_classes_of_code_points():
    kinds = bpe.char_classes()
    for at in np.random.default_rng(0).integers(0, 0x110000, 2000).tolist() + [0x20, 0x41, 0x39, 0xD7FF, 0xE000, 0x10FFFF]:
        if not 0xD800 <= at < 0xE000:
            one = chr(at)
            want = bpe.LETTER if regex.match(r"\p{L}", one) else bpe.NUMBER if regex.match(r"\p{N}", one) else bpe.SPACE if regex.match(r"\p{White_Space}", one) else bpe.OTHER
            assert kinds[at] == want
    assert (kinds[0xD800:0xE000] == bpe.OTHER).all()


def test_tokenize_has_one_python_worker_a_task(spark):
    docs = spark.createDataFrame([(1, "One's day, über 42!"), (2, None), (2, "")], "doc_id long, text string").selectExpr("*", "'x' AS ids", "'y' AS decoded", "0 AS n_tokens")
    out = corpus_pipeline.tokenize(spark, docs, "")
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    vocabulary = bpe.broadcast_vocabulary(spark, corpus_pipeline.public_tokenizers.path(corpus_pipeline.VOCABULARY_FILE))
    want = bpe.decode(bpe.encode(docs, vocabulary, arrays=True), vocabulary).drop("decoded")
    assert out.columns == want.columns and sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
