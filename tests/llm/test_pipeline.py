"""The pipeline's stages against plain versions, and run() as their chain."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tessera.llm import language_id, mixing, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Two languages of made-up words, toxic ones among them, copies, benchmark passages, nulls."""
    rng = random.Random(12)
    stems = {"xx": [f"{a}{b}a" for a in "bcdfgh" for b in "aeiou"], "yy": [f"{a}{b}sch" for a in "klmnpr" for b in "äöüei"]}
    make = lambda lang, n: [rng.choice(stems[lang]) + rng.choice(stems[lang]) for _ in range(n)]
    items = [(i, " ".join(make("xx", 30))) for i in range(4)]
    rows, labels = [], []
    for i in range(600):
        lang = "xx" if i % 3 else "yy"
        words = make(lang, 60)
        if i % 10 == 0:
            words[5:5] = ["vileword", "nastyword"]
        if i % 50 == 7:
            words[20:20] = items[i % 4][1].split()
        rows.append((i, " ".join(words), lang, f"s{i % 2}"))
        labels.append((i, 1, int(i % 10 == 0)))
    for i in range(1, 600, 40):  # near and exact copies
        words = rows[i][1].split()
        rows.append((1000 + i, " ".join([*words[:-1], "other"]) if i % 80 == 1 else rows[i][1], rows[i][2], "s1"))
    rows += [(2000, None, "xx", "s0"), (2001, "", "xx", "s0"), (2002, "12 34", None, None), (None, rows[3][1], "xx", "s1"), (None, rows[3][1], "xx", "s1"), (2, rows[4][1] + " more", "xx", "s0"), rows[8]]
    folder = tmp_path_factory.mktemp("corpus")
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, dict(items), {i: t for i, _, t in labels}


def shingles(text, k=5):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def plain_near_duplicates(rows):
    named = [r for r in rows if r[0] is not None]
    root = {r[0]: r[0] for r in named}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(r[0], shingles(r[1])) for r in named]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                a1, b1 = find(a), find(b)
                root[max(a1, b1)] = min(a1, b1)
    return {r[0] for r in named if find(r[0]) == r[0]}


def plain_contaminated(text, items):
    """Items whose every window of eight words, in this corpus of verbatim passages, is held."""
    w = (text or "").split()
    held = {tuple(w[i : i + 8]) for i in range(len(w) - 7)}
    shares = []
    for t in items.values():
        own = t.split()
        shares.append(sum(tuple(own[i : i + 8]) in held for i in range(len(own) - 7)) / (len(own) - 7))
    return max(shares) >= 0.5


def test_language_and_toxicity_stages(spark, corpus):
    folder, rows, _, toxic = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = P.identify_language(spark, docs, folder)
    assert kept.columns == COLUMNS
    got = Counter(rows_of(kept))
    model = language_id.fit(docs)
    guessed, name = language_id.predict(docs, model)
    want = Counter(tuple(r)[:5] for r in guessed.collect() if r[name]["lang"] != "und" and not r[name]["ambiguous"])
    assert got == want and sum(got.values()) >= len(rows) - 6
    assert not {2000, 2001, 2002} & {r[0] for r in got}
    clean = P.drop_toxic(spark, docs, folder)
    assert clean.columns == COLUMNS
    ids = Counter(r.doc_id for r in clean.collect())
    judged = [(i, toxic[i]) for i in range(600)]
    assert sum(t and not ids[i] for i, t in judged) >= 0.9 * sum(toxic.values()) and sum(not t and not ids[i] for i, t in judged) == 0
    assert ids[2000] == ids[2001] == ids[2002] == 1 and ids[None] == 2 and ids[8] == 2  # null and empty texts, repeats
    scored, name = toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))
    assert Counter(rows_of(clean)) == Counter(tuple(r)[:5] for r in scored.collect() if r[name] < 0.5)


def test_near_duplicates_against_all_pairs(spark, corpus):
    folder, rows, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = P.drop_near_duplicates(spark, docs, folder)
    assert kept.columns == COLUMNS
    again = P.drop_near_duplicates(spark, docs.repartition(5), folder)
    assert rows_of(kept) == rows_of(again)  # which row of an id stays does not hang on their order
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids.pop(None) == 2 and set(ids.values()) == {1}
    assert set(ids) == plain_near_duplicates(rows)


def test_decontamination_against_plain_windows(spark, corpus):
    folder, rows, items, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = Counter((r.doc_id, r.text) for r in P.decontaminate(spark, docs, folder).collect())
    bad = {r[0] for r in rows if r[0] is not None and plain_contaminated(r[1], items)}
    assert len(bad) >= 10 and got == Counter((r[0], r[1]) for r in rows if r[0] not in bad)


def test_mixing_follows_its_rates(spark, corpus):
    folder = corpus[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = P.mix_sources(spark, docs, folder)
    assert out.columns[:5] == COLUMNS and len(out.columns) == 7
    rates = {r.source: (r.rate, r.n_docs) for r in mixing.rates(docs, F.length("text")).collect()}
    times = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    for s in ("s0", "s1"):
        rate, n = rates[s]
        assert abs(times[s] - rate * n) < 5 * (rate * n) ** 0.5
    copies = Counter((r.doc_id, r.text) for r in out.where("doc_id = 8").collect())
    assert copies[8, corpus[1][8][1]] % 2 == 0  # a repeated row has twice the copies


def test_run_is_the_chain_of_its_stages(spark, corpus):
    folder, rows, items, toxic = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in P.STAGES:
        docs = P.written(stage(spark, docs, folder), "chain")
    got = P.run(spark, folder)
    keys = lambda df: Counter((r.doc_id, r.text, r.copy) for r in df.collect())
    assert keys(got.where("doc_id is not null")) == keys(docs.where("doc_id is not null"))
    ids = {r.doc_id for r in got.select("doc_id").distinct().collect()} - {None}
    assert not any(toxic.get(i) for i in ids if i % 5) or len([i for i in ids if toxic.get(i)]) <= 3
    by_id = dict((r[0], r[1]) for r in rows)
    assert not any(plain_contaminated(by_id[i], items) for i in ids) and ids <= plain_near_duplicates(rows)
