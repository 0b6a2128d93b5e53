"""Decontamination against a plain version over all alignments, and copies in other capitals."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import decontamination as D

SF = "/root/testdata"
TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+")


def tokens(text):
    """(folded word, kind) of each token: n number, u unit, c capital, w plain word."""
    out = []
    for t in TOKEN.findall(text or ""):
        f = t.casefold()
        out.append((f, "n" if t[0].isdigit() else "u" if f in D.UNITS else "c" if t[0].casefold() != t[0] else "w"))
    return out


def keys(window):
    """Keys of a window with the slots that each leaves open."""
    words = tuple(w for w, _ in window)
    out = {("verbatim", words): (None,) * len(words)}
    for kinds in ("nuc", "nu"):
        slots = tuple(w if k in kinds else None for w, k in window)
        plain = sum(s is None for s in slots)
        if plain < len(words) and plain >= min(D.MIN_LITERALS, len(words)):
            out[("typed", tuple(k if k in kinds else w for w, k in window))] = slots
    return out


def places(text, width):
    t = tokens(text)
    return [keys(t[i : i + width]) for i in range(len(t) - width + 1)]


def plain(docs, items, coverage=D.COVERAGE):
    found = {}
    for d, text in docs:
        for i, item in items:
            width = min(D.WINDOW, len(tokens(item)))
            if not width:
                continue
            own, asked = places(text, width), places(item, width)
            met = defaultdict(set)
            for p, a in enumerate(asked):
                for q, b in enumerate(own):
                    for k in a.keys() & b.keys():
                        met[q - p].add((p, a[k], b[k]))
            counted, swapped = set(), False
            for windows in met.values():
                votes, first = Counter(), {}
                for p, x, y in {(p + j, x, y) for p, xs, ys in windows for j, (x, y) in enumerate(zip(xs, ys)) if x}:
                    votes[x, y] += 1
                    first[x, y] = min(first.get((x, y), p), p)
                chosen = {}
                for (x, y), n in votes.items():
                    rank = (n, x == y, -first[x, y])
                    if x not in chosen or rank > chosen[x][0]:
                        chosen[x] = (rank, y)
                for p, xs, ys in windows:
                    if xs == ys:
                        counted.add(p)
                    elif all(not x or chosen[x][1] == y for x, y in zip(xs, ys)):
                        counted.add(p)
                        swapped = True
            if len(counted) / len(asked) >= coverage:
                found[d, i] = (len(counted), len(asked), swapped)
    return found


def run(spark, docs, items, **options):
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return [((r.doc_id, r.item_id), (r.matched, r.windows, r.reparameterised)) for r in D.contaminated(d, b, **options).collect()]


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_alignments(spark, seed):
    rng = random.Random(seed)
    words = ["rain", "falls", "on", "the", "old", "town", "and", "all", "streets", "fill", "with", "water", "élan", "ночь"]
    slots = ["Mary", "Peter", "Иван", "Олег", "12", "7", "3.5", "kg", "miles", "The", "Élan"]
    items = [(i, " ".join(rng.choice(words if rng.random() < 0.65 else slots) for _ in range(rng.choice([2, 6, 8, 14, 22])))) for i in range(12)]
    docs = []
    for n in range(60):
        text = items[rng.randrange(12)][1]
        if rng.random() < 0.6:
            old, new = rng.choice(slots), rng.choice(slots)
            text = text.replace(old, new, rng.choice([1, -1]))
        text = rng.choice([str, str, str.lower, str.upper, str.title])(text)
        docs.append((n, f"{' '.join(rng.choices(words, k=3))}. {text}, {' '.join(rng.choices(words, k=3))}"))
    got, want = dict(run(spark, docs, items)), plain(docs, items)
    assert got == want and len(want) > 30


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_own_benchmark_is_found_in_any_capitals(spark, sf):
    bench = spark.read.parquet(f"{SF}/{sf}/benchmark.parquet")
    every = bench.count()
    for change in (F.lower("text"), F.upper("text"), F.initcap("text"), F.col("text")):
        copies = bench.select(F.col("item_id").alias("doc_id"), F.concat(F.lit("so. "), change, F.lit(" end")).alias("text"))
        found = D.contaminated(copies, bench).where("doc_id = item_id and coverage = 1.0")
        assert found.count() == every


def test_replaced_numbers_in_other_capitals(spark):
    item = "Anna walked 12 miles to the old mill and then rode 7 miles back home before the rain began to fall"
    docs = [(1, item.upper().replace("12", "15")), (2, item.lower().replace("7", "9")), (3, item.replace("Anna", "Boris")), (4, item.replace("12", "1").replace("mill", "barn").replace("rain began", "sun set").replace("rode", "ran"))]
    got = dict(run(spark, docs, [(1, item)]))
    assert {d for d, _ in got} == {1, 2, 3} and all(v[2] for v in got.values()) and got == plain(docs, [(1, item)])


def test_rows_without_an_id_are_judged_apart(spark):
    item = " ".join(f"w{chr(97 + i)}" for i in range(20))
    half = item.split()
    docs = [(None, " ".join(half[:11])), (None, " ".join(half[9:])), (None, "x " + item), (None, "x " + item), (5, item), (5, "nothing")]
    got = run(spark, docs, [(1, item)], coverage=0.6)
    assert sorted(got, key=str) == sorted([((None, 1), (13, 13, False)), ((5, 1), (13, 13, False))], key=str)
