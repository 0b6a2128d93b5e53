"""Periodic runs against a plain search for every period, and the digests against Python."""

import hashlib
import random
import re
import zlib

import pytest

from tessera.llm import periodic_runs as P


def plain_runs(w, least, copies):
    """All runs, by comparing every word with the word q later, for every q."""
    found = {}
    for q in range(1, len(w) // copies + 1):
        k, last = 0, len(w) - q
        while k < last:
            j = k
            while j < last and w[j] == w[j + q]:
                j += 1
            if j > k and j - k + q >= max(least, copies * q):
                found.setdefault((k, j + q), q)
            k = max(j, k + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text, least=24, copies=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words, least, copies)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *first, sha(listed), sha(kept))


@pytest.mark.parametrize("least,copies,grid,pending", [(24, 3, 1 << 16, 1 << 18), (6, 3, 64, 50), (2, 2, 64, 50), (40, 4, 1 << 16, 50)])
def test_runs_against_plain_search(monkeypatch, least, copies, grid, pending):
    monkeypatch.setattr(P, "GRID", grid)
    monkeypatch.setattr(P, "PENDING", pending)
    rng, seen = random.Random(least), 0
    for _ in range(40):
        texts = []
        for _ in range(rng.randint(1, 10)):
            letters, words = "abcdefghijklmnopqrstuvwxyz"[: rng.choice([1, 2, 3, 26])], []
            while len(words) < rng.randint(0, 250):
                words += rng.choices(letters, k=rng.randint(1, 12)) * rng.choice([1, 1, 2, 3, 5, 9])
            texts.append(" ".join(words).encode())
        texts += texts[:2]
        for t, (words, runs) in zip(texts, P.texts_runs(texts, least, copies)):
            assert words == t.split() and runs == plain_runs(words, least, copies)
            seen += len(runs)
    assert seen > 20


def test_grammar_expands_and_extends():
    import numpy as np

    rng = np.random.default_rng(3)
    body = np.concatenate([rng.integers(0, 3, 200), np.tile([0, 1, 1], 50), np.zeros(70, int), rng.integers(0, 3, 80)])
    names = np.concatenate(([900], body, [901]))
    levels = P.recompress(names, 8)
    assert len(levels) > 5 and len(levels[-1].names) < 40
    a, b = np.triu_indices(len(body), 1)
    a, b = a[::7] + 1, b[::7] + 1
    want = [next(k for k in range(len(names)) if names[i + k] != names[j + k]) for i, j in zip(a, b)]
    assert P.extensions(levels, a, b).tolist() == want


def test_long_and_odd_texts(spark, docs):
    rows = [(1, "a b " * 100_000), (1, "a b " * 100_000), (2, None), (3, ""), (None, "x " * 30), (4, "\x0bé é\x0c" * 40), (5, "one two " * 11), (6, "u v w " * 8 + "u")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, runs int")
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in P.find_runs(df).collect()), key=str)
    assert got.count((1, [(0, 200_000, 2)], "a b")) == 2 and (2, [], "") in got and (3, [], "") in got
    assert (None, [(0, 30, 1)], "x") in got and (5, [], "one two " * 10 + "one two") in got and (6, [(0, 25, 3)], "u v w") in got
    assert (4, [(0, 39, 1)], "é é") not in got  # no break space joins words
    assert P.find_runs(docs).count() == docs.count() and P.find_runs(docs.limit(0)).count() == 0


def test_query_against_plain_search(spark):
    from tessera.llm.queries import op13_periodic_runs

    sf = "/root/testdata/sf0.001"
    got = {tuple(r)[:8] for r in op13_periodic_runs(spark, sf).collect()}
    want = {plain_digest(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert got == want and any(r[1] for r in want)


def test_planted_without_id_or_words(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    texts = ["a b  c\td e f g h i j k l m n o p q r s t u v w x y z", "", None]
    df = spark.createDataFrame([*zip(ids, texts), (None, "a  b")], "doc_id long, text string")
    got = {tuple(r)[:8] for r in P.digests(P.find_runs(P.planted(df))).collect()}
    assert got == {plain_digest(i, t) for i, t in [*zip(ids, texts), (None, "a  b")]}
