"""Ranked lexical search against a plain scoring of every document."""

import math
import random
import re

import numpy as np
import pytest

from tessera.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    """item_id, rank, doc_id, score of the k best, by the written formula."""
    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, total = len(bags), sum(len(b) for _, b in bags)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 100 - 50 + (50 * len(b) * n_docs) // total
            s = 0
            for t in set(terms(text)) & set(b):
                df = sum(t in set(x) for _, x in bags)
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((10**9 * b.count(t)) // (1000 * b.count(t) + 20 * m))
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(6))
def test_treap_search_is_exact(seed, monkeypatch):
    monkeypatch.setattr(L, "BEST", 3 if seed % 2 else 512)
    rng = np.random.default_rng(seed)
    n_rows, n_cols = int(rng.integers(1, 60)), int(rng.integers(1, 200))
    grid = np.where(rng.random((n_rows, n_cols)) < rng.choice([0.05, 0.4]), rng.integers(1, 4 if seed < 3 else 1000, (n_rows, n_cols)), 0)
    r, c = np.nonzero(grid)
    if not len(r):
        return
    treap = L.Treap(r, c, grid[r, c])
    assert treap.top[0] == grid.max() and len(treap.top) == len(treap.bits) == len(treap.first)
    assert treap.bits[-len(r) :].sum() == 0  # the last level is the cells
    weights = rng.integers(0, 9, n_rows)
    for _ in range(20):
        rows = np.unique(rng.integers(0, n_rows, 8))
        beyond = np.append(rows, [n_rows + 70, 1 << treap.depth])  # rows that the grid has not
        total = (weights[rows, None] * grid[rows]).sum(0)
        want = sorted((-s, j) for j, s in enumerate(total.tolist()) if s > 0)[:7]
        assert L.best_columns(treap, beyond, np.append(weights[rows], [5, 5]), 7, 0) == [(-s, j) for s, j in want]
        if len(want) == 7:
            assert L.best_columns(treap, rows, weights[rows], 7, -want[-1][0]) == [(-s, j) for s, j in want]


def test_search_against_plain_scoring(spark):
    rng = random.Random(5)
    words = ["Ab", "aB", "çé", "Ç", "x1", "the", "_", "of", "rare", "naïve", "日本"] + [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(150)]
    docs += [docs[3]] * 3 + [(900, None), (901, ""), (902, "... ---"), (None, "rare the the"), (903, "the " * 40_000 + "rare"), (904, "\x7f\x00{}")]
    items = [(0, "The rare w1 w2 w3 naïve"), (0, "of of OF"), (1, None), (2, "..."), (3, "absent"), (None, "日本 x1"), (4, " ".join(words))]
    d = spark.createDataFrame([(*r, 9) for r in docs], "doc_id long, text string, score int").repartition(3)
    b = spark.createDataFrame([(*r, 9) for r in items], "item_id long, text string, rank int")
    want = plain(docs, items, 10)
    for shard, seeds, block in ((4096, 16, 1024), (7, 3, 2), (1, 1, 1)):
        got = sorted((tuple(r) for r in L.search(d, b, k=10, shard_docs=shard, seeds=seeds, item_block=block).collect()), key=str)
        assert got == want
    assert L.search(d.limit(0), b, k=10).count() == 0 and L.search(d, b.limit(0), k=10).count() == 0
