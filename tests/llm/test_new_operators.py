"""SentencePiece codes, the conversation trie and the source audit against brute force and the library."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from innkeep.llm import prefix_trie, queries, sentence_bpe, source_audit

from . import brute

PIECES = public_tokenizers.path("piece_bpe_32k.model")


# ---------------------------------------------------------------- op11
@pytest.fixture(scope="module")
def model():
    return sentence_bpe.Model.load(PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def random_texts(n: int, seed: int) -> list[str]:
    r = random.Random(seed)
    signs = "ab etnsr\n\t  ▁'é漢🙂\x00\x7f<s></s>0x0A the hello wörld�​"
    return ["".join(r.choice(signs) for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_ids_and_texts_are_those_of_the_library(model, library):
    texts = random_texts(3000, 1) + ["", " ", "▁", "  a", "x" * 5000, "ab " * 20000]
    expected = library.encode(texts)
    assert [a.tolist() for a in model.encode_all(texts)] == expected
    alone = sentence_bpe.Model.load(PIECES)
    assert [alone.encode(t).tolist() for t in texts[:50]] == expected[:50]
    plain = [t.replace("▁", " ") for t in texts]
    assert [model.decode(ids) for ids in expected] == plain
    assert decoded(model, expected) == plain


def decoded(model, lists):
    return model.decode_all(np.array([i for ids in lists for i in ids], np.int32), np.cumsum([0, *map(len, lists)])).to_pylist()


def test_any_ids_decode_like_the_library(model, library):
    r = random.Random(2)
    for _ in range(2000):
        ids = [r.randrange(32000) if r.random() < 0.4 else r.randrange(260) for _ in range(r.randint(0, 12))]
        assert model.decode(ids) == library.decode(ids)
        assert decoded(model, [ids, [5, 2], [], ids]) == [model.decode(x) for x in (ids, [5, 2], [], ids)]
    with pytest.raises(ValueError):
        model.decode([32000])


def test_long_texts_are_cut_between_words(model, library, monkeypatch):
    monkeypatch.setattr(sentence_bpe, "SLICE_CHARS", 50)
    text = " ".join(random_texts(200, 3))
    assert model.encode(text).tolist() == library.encode(text)


def test_side_by_side_agendas_equal_the_heap(model, monkeypatch):
    cuts = [c for c in {c for t in random_texts(500, 4) for c in model.cuts.findall(model.marked(t))} if len(c) <= 64]
    memo = sentence_bpe.Memo(model)
    memo._fill(cuts)
    assert len(memo) > 100
    monkeypatch.setattr(sentence_bpe, "MEMO_ENTRIES", 50)
    assert [a.tolist() for a in model.encode_all(random_texts(300, 4))] == [model.encode(t).tolist() for t in random_texts(300, 4)]
    for cut, ids in memo.items():
        assert ids == b"".join(i.to_bytes(4, "little") for i in model.cut_ids(cut))


def test_unused_pieces_are_taken_apart(model):
    small = sentence_bpe.Model.parse(model.content)
    whole = small.encode("hello").tolist()
    piece = small.pieces[whole[0]]
    small.unused, small.pairs = frozenset({piece}), None
    small.memo = sentence_bpe.Memo(small)
    parts = small.encode("hello").tolist()
    assert len(parts) > len(whole) and "".join(small.pieces[i] for i in parts) == "".join(small.pieces[i] for i in whole)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "kept") for i, t in rows], "doc_id long, text string, n_tokens string")


@pytest.mark.parametrize("rows", [brute.EDGES, brute.synthetic(), []], ids=["edges", "synthetic", "empty"])
def test_sentence_query(spark, library, tmp_path, rows):
    spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, token_ids string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for i, t in rows:
        ids = library.encode(t or "", add_eos=True)
        expected.append((i, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(library.decode(ids))))
    got = [tuple(r) for r in queries.op11_sentence_bpe(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_a_wrong_merge_fails_the_job(spark, model):
    path = PIECES

    class Wrong:
        @property
        def value(self):
            from innkeep.llm import sentence_bpe

            out = sentence_bpe.Model.load(path)
            out.memo["▁hello"] = (0).to_bytes(4, "little")
            return out

    with pytest.raises(Exception, match="differ from those of the library"):
        sentence_bpe.encode(docs_of(spark, [(1, "hello")]), Wrong()).collect()
    plain = sentence_bpe.encode(docs_of(spark, [(1, "hello")]), spark.sparkContext.broadcast(model), end=False, checked=False).first()
    assert plain["token_ids"] == model.encode("hello").tolist() and plain["n_tokens"] == len(plain["token_ids"])


# ---------------------------------------------------------------- op12
def trie_of(rows):
    """Brute force over (conv_id, turn, role, text) rows."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn), digest, role, text))
    for c in own:
        own[c].sort(key=lambda t: (t[0][0], t[0][1] or 0, t[1]))
    sequences = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        sequences[c] = [t[2:] for t in own.get(c - c % 5, [])[:h] + own[c][h:]]
    members = defaultdict(list)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return [
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         brute.sha(",".join(str(c) for c in sorted(m) if len(sequences[c]) == len(p))))
        for p, m in members.items()
    ]


CONVERSATIONS = "conv_id long, turn long, role string, text string, depth string"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def random_conversations(seed: int, n: int, longest: int, texts: int):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(3 * n), n):
        size = r.choice([1, 2, 5, 8, 9, 16, 17, longest])
        rows += [(c, k, "user" if k % 2 else None, f"text é {r.randrange(texts)}" if k > 3 * texts or r.random() < 0.2 else f"common {k}") for k in range(size)]
    r.shuffle(rows)
    return rows


TRIES = {
    "none": [],
    "edges": [
        (None, 1, "a", "lost"), (0, None, None, None), (0, None, "b", None), (0, 1, "b", ""), (0, 1, "b", ""), (0, 1, "a", "x"),
        (4, 0, "a", "x"), (7, 3, "a", "x" * 100_000), (9, 0, None, "y"), (10, 0, "ab", "c"), (15, 0, "a", "bc"), (11, 0, "q", "r"),
    ],
    "short": random_conversations(1, 60, 8, 2),
    "long": random_conversations(2, 40, 70, 1),
    "one hot": random_conversations(3, 30, 12, 2) + [(500, k, "u", f"t{k}") for k in range(1000)] + [(505, k, "u", f"t{k}" if k != 777 else "z") for k in range(1100)],
    "copies": [(5 * c, k, "u", f"t{k}") for c in range(300) for k in range(3)],
}


@pytest.mark.parametrize("rows", TRIES.values(), ids=TRIES.keys())
def test_trie(spark, rows):
    made = spark.createDataFrame([(*r, "x") for r in rows], CONVERSATIONS).repartition(4)
    got = prefix_trie.conversation_trie(made)
    assert got.columns == NODE
    assert sorted(map(tuple, got.collect()), key=str) == sorted(trie_of(rows), key=str)


def test_lists_that_fill_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 200)
    ends = spark.range(5000).selectExpr("CAST(CASE WHEN id % 3 = 0 THEN 'x' ELSE CONCAT('n', id % 50) END AS BINARY) AS name", "id - 700 AS conv_id")
    expected = defaultdict(list)
    for i in range(5000):
        expected[b"x" if i % 3 == 0 else f"n{i % 50}".encode()].append(i - 700)
    got = {bytes(r["name"]): r["digest"] for r in prefix_trie.list_digests(ends).collect()}
    assert got == {k: brute.sha(",".join(map(str, sorted(v)))) for k, v in expected.items()}


# ---------------------------------------------------------------- op13
def audit_of(rows, least=source_audit.LEAST_DOCUMENTS):
    terms = [(lang or "", source or "", Counter(source_audit.TERM.findall((text or "").encode().translate(source_audit._LOWER)))) for lang, source, text in rows]
    docs, groups = Counter(), defaultdict(Counter)
    for lang, source, found in terms:
        docs.update((lang, t) for t in found)
        groups[lang, source].update(found)
    out = []
    for lang in {g[0] for g in groups}:
        kept = {t for (k, t), n in docs.items() if k == lang and n >= least}
        own = {s: {t: n for t, n in c.items() if t in kept} for (k, s), c in groups.items() if k == lang}
        whole = sum((Counter(c) for c in own.values()), Counter())

        def shares(counts):
            total = sum(counts.values()) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts.get(t, 0) + 5) // total for t in kept}

        q, p = shares(whole), {s: shares(c) for s, c in own.items()}
        for s in own:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in own if o != s]
            term = [(p[s][t] - q[t], t) for t in own[s] if p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, 50)):
                found = sorted(found, key=lambda f: (-f[0], f[1]))[:most]
                out += [(lang, s, part, item.decode(), value, k) for k, (value, item) in enumerate(found, 1)]
    return out


def random_documents(seed: int, n: int):
    r = random.Random(seed)
    words = ["a", "of", "Über", "naïve", "word", "wordy", "wordless", "x" * 40, "x" * 41, "漢字", "Fünfzehnhundertjährige"] + [f"{a}{b}{c}" for a in "qrs" for b in "tuv" for c in "wxyz"]
    out = []
    for k in range(n):
        source = None if k % 17 == 0 else f"s{min(r.randrange(12), 4)}"
        text = None if k % 31 == 0 else " 1-".join(r.choice(words) if r.random() < 0.9 else f"rare{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}" for _ in range(r.randrange(40)))
        out.append(("en" if k % 3 else None, source, text))
    return out + [("no", "one", "few words here"), ("no", "two", None), ("no", "three", "1 2 3"), ("solo", "s", "alone")]


AUDITS = {"none": [], "edges": [(None, None, None), ("", "a", ""), ("en", "é", "a" * 200_000)], "random": random_documents(1, 900), "copies": [("en", f"s{k % 3}", "Same words again words") for k in range(95)]}


@pytest.mark.parametrize("rows", AUDITS.values(), ids=AUDITS.keys())
def test_audit(spark, rows):
    made = spark.createDataFrame([(*r, 1.5) for r in rows], "lang string, source string, text string, value double").repartition(4)
    got = source_audit.audit(made)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == sorted(audit_of(rows))


def test_audit_in_small_blocks_and_sums(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "CELLS", 16)
    monkeypatch.setattr(source_audit, "CELLS_A_PAIR", 1)
    monkeypatch.setattr(source_audit, "HELD_ROWS", 40)
    monkeypatch.setattr(source_audit, "FILTER_BITS", 16)
    rows = random_documents(2, 700)
    made = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    assert sorted(map(tuple, source_audit.audit(made).collect())) == sorted(audit_of(rows))


def test_levels_drop_rare_prefixes(spark):
    rows = random_documents(3, 600) + [("en", "s1", " ".join(f"seldom{a}{b}{c}" for a in "abcdef" for b in "ghijkl" for c in "mnopqr"))]
    made = spark.createDataFrame(rows, "lang string, source string, text string")
    documents = source_audit.staged(source_audit.document_terms(made), "terms")
    sent, levels = source_audit.frequent_filter(documents)
    assert levels == [6, 12, 24, 48]
    counted = source_audit._counted(documents, sent, levels).select("term").distinct().collect()
    assert not [r for r in counted if r["term"].startswith("seldom")]


def test_equal_cuts_of_a_slice_are_looked_up_once(model, library, monkeypatch):
    import pyarrow as pa

    asked = []
    find = sentence_bpe.Memo.find
    monkeypatch.setattr(sentence_bpe.Memo, "find", lambda self, cuts: asked.extend(cuts) or find(self, cuts))
    texts = ["hello world " * 500, None, "", "\nhello  ▁world\t", "hello"]
    flat, at = model.encode_batch(pa.array(texts))
    expected = library.encode([t or "" for t in texts])
    assert [flat[i:j].tolist() for i, j in zip(at[:-1], at[1:], strict=True)] == expected
    assert sorted(asked) == sorted(set(asked)) and asked.count(b" hello") == 1


def test_chunks_are_unpacked_one_at_a_time():
    import pyarrow as pa

    from innkeep.llm import lm_score

    rows = lm_score.rows_of(pa.RecordBatch.from_pylist([{"words": b"a", "n": 1}, {"words": None, "n": 2}]))
    assert next(rows) == (0, {"words": b"a", "n": 1}) and list(rows) == [(1, {"words": None, "n": 2})]
