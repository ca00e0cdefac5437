"""Plain Python versions of the text operators' contracts, for small fixtures."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return (text or "").translate(LOWER)


def crc(doc_id, mod):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lm_base(rows):
    tokens = [[*WORD.findall(lower(t)), "\0end"] for _, t in rows]
    c = Counter(w for (i, _), ws in zip(rows, tokens, strict=True) if crc(i, 7) != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, crc(i, 7) == 2, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for (i, _), ws in zip(rows, tokens, strict=True)]


def secret_spans(text):
    out = []
    for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or ""):
        if len(m[1]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(out)


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    found = Counter(tuple(words[i : i + 8]) for i in range(n - 7))
    covered = {j for i in range(n - 7) if found[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def leaks(docs, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        w = bench_words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i : i + size])].add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w = bench_words(text)
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def repeats(rows, size=200):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + size] for b in data for i in range(len(b) - size + 1))
    out = []
    for (i, _), b in zip(rows, data, strict=True):
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if seen[b[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return out


def near_duplicates(rows, percent=85):
    sets = []
    for _, text in rows:
        w = WORD.findall(lower(text))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    own = sorted({s for s in sets if s}, key=len)
    top = {s: s for s in own}

    def root(s):
        while top[s] is not s:
            top[s] = s = top[top[s]]
        return s

    lists = defaultdict(list)
    for a in own:
        common = Counter(b for v in a for b in lists[v])
        for v in a:
            lists[v].append(a)
        for b, n in common.items():
            if 100 * n >= percent * (len(a) + len(b) - n):
                top[root(a)] = root(b)
    least = {}
    for (i, _), s in zip(rows, sets, strict=True):
        if s and i is not None:
            least[root(s)] = min(i, least.get(root(s), i))
    out = []
    for (i, _), s in zip(rows, sets, strict=True):
        c = least.get(root(s), i) if s else i
        out.append((i, len(s), c, i == c))
    return out


def synthetic(seed=1, n=300):
    """Texts with copies, near copies, shared passages, a common line, junk and odd characters."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéfghß😀") for _ in range(r.randint(1, 8))) for _ in range(400)]
    passages = [" ".join(r.choices(vocabulary, k=60)) for _ in range(4)]
    line = " ".join(r.choices(vocabulary, k=12))
    base = r.choices(vocabulary, k=140)
    out = []
    for i in range(n):
        kind = r.random()
        if kind < 0.25:
            words = [r.choice(vocabulary) if r.random() < 0.012 else w for w in base]
        else:
            words = r.choices(vocabulary, k=r.randint(0, 200))
        text = " ".join(words)
        if r.random() < 0.3:
            text += "\n" + line + "\n" + " ".join(r.choices(vocabulary, k=9))
        if r.random() < 0.2:
            text = r.choice(passages) + " " + text
        out.append((i, text))
    out += [(n + k, out[k % 20][1]) for k in range(40)]
    return out


#: Null and empty texts, null and repeated ids, repeated rows, short, very long and odd texts.
EDGES = [
    (None, None), (None, "token = abcdefgh"), (5, None), (5, None), (6, ""), (7, " \n\t "), (8, "a"), (8, "a"), (9, "b" * 199), (10, "b" * 199),
    (11, "c" * 200), (12, "c" * 200), (13, "ab " * 40_000), (14, "x" * 120_000), (15, "!!! ... ???"), (16, "Don't 'sun 's's ''s　́ \x1c\x85"),
    (17, "one two three four five six seven eight nine ten eleven"),
]
