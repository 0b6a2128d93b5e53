"""Small cases of every operator: nulls, empty and long texts, ties, repeats, empty tables,
clashing column names; brute force, round trips and held-out accuracy."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat, decontamination, html_extract, jaccard_join, language_id, mixing, nearest, revisits, token_counts, toxicity
from tessera.llm.components import components

SF = "/root/testdata/sf0.01"


def test_language_id_cases(spark, docs):
    model = language_id.fit(docs)
    out, name = language_id.predict(docs, model)
    assert out.columns[:-1] == docs.columns and out.count() == docs.count()
    got = [(r.doc_id, r[name]["lang"]) for r in out.collect()]
    assert (2, "und") in got and (3, "und") in got and (6, "und") in got
    assert language_id.fit(docs.limit(0)).languages == []
    assert language_id.predict(docs.limit(0), model)[0].count() == 0


def test_language_id_held_out(spark):
    from tessera.llm.queries import op8_language_id

    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    joined = op8_language_id(spark, SF).where("held_out").join(truth, "doc_id")
    assert joined.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97


def test_codewords_are_apart():
    for k in (2, 3, 4, 6, 9, 40):
        code = language_id.codewords(k).astype(int)
        gaps = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
        assert min(gaps) >= max(1, code.shape[1] // 4)


def test_toxicity_learns_and_defaults(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=40)) + (" nasty vile" if i % 8 == 0 else ""), int(i % 8 == 0)) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    extra = spark.createDataFrame([(9000, None), (9001, "")], "doc_id long, text string")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    out, name = toxicity.score(df.select("doc_id", "text").union(extra).withColumn("toxicity", F.lit("mine")), model)
    assert name != "toxicity"
    got = {r.doc_id: r[name] for r in out.collect()}
    assert all((got[i] >= 0.5) == bool(t) for i, _, t in rows) and got[9000] == got[9001] < 0.5
    none = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic").limit(0))
    assert toxicity.score_texts(none, ["nasty"])[0] < 0.5


def test_mixing_reaches_its_weights(spark, docs):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 6 == 0, "small").otherwise("big").alias("source"), F.lit("abcd").alias("text"), F.lit(1).alias("copy"))
    out, copy, order = mixing.replicate(df, F.length("text"), weights={"small": 0.5, "big": 0.5})
    assert copy != "copy"
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["small"] - 3000) < 250 and abs(n["big"] - 3000) < 250
    # Nulls, empty and long texts, repeated rows: counts as the rates say, repeated rows alike.
    rated = {r.source: r.rate for r in mixing.rates(docs, F.length("text")).collect()}
    assert rated[None] > 100 * rated["b"] > 0  # the null source is short, source b holds the long text
    times = mixing.replicate(docs, F.length("text"))[0].groupBy("doc_id").count()
    assert {r["doc_id"]: r["count"] for r in times.collect()}.get(1, 0) % 2 == 0
    assert mixing.replicate(docs.limit(0), F.length("text"))[0].count() == 0


def test_mixing_draws_rows_without_an_id_apart(spark):
    # Equal rows without an id, dealt over several partitions; one row with an id.
    df = spark.range(10_000, numPartitions=7).select(F.when(F.col("id") == 0, F.col("id")).alias("doc_id"), F.lit("s").alias("source"), F.lit("abcd").alias("text"))
    for seed in ("mix", "a", "b"):
        out, copy, order = mixing.replicate(df, F.length("text"), weights={"s": 1.0}, seed=seed)
        n = out.count()
        assert abs(n - 10_000) < 500 and out.columns == ["doc_id", "source", "text", "copy", "shuffle_key"]
        assert out.groupBy("copy").count().where("copy = 1").first()["count"] > 2000
        assert out.select(order).distinct().count() == n  # copies travel apart


def test_mixing_of_large_rates(spark):
    import duckdb

    from tessera.llm.sql import OP3

    # One short document without a source among long ones: its rate is 887.
    text = F.when(F.col("id") > 0, F.repeat(F.lit("x"), F.lit(40_000))).otherwise(F.lit("y"))
    df = spark.range(60).select(F.col("id").alias("doc_id"), F.when(F.col("id") > 0, F.concat(F.lit("s"), F.col("id") % 3)).alias("source"), text.alias("text"))
    out, copy, order = mixing.replicate(df, F.length("text"))
    got = sorted((r[0], str(r[1]), *r[2:]) for r in out.select("doc_id", "source", F.length("text"), copy, order).collect())
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    assert got == sorted((r[0], str(r[1]), *r[2:]) for r in con.execute(OP3).fetchall())
    # Split into draws of a mean of at most 50.
    split, copy, _ = mixing.replicate(df, F.length("text"), most=50.0)
    copies = sorted(r[0] for r in split.where("doc_id = 0").select(copy).collect())
    assert copies == list(range(len(copies))) and abs(len(copies) - 887) < 150
    many = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("a").alias("text"))
    n = [r["count"] for r in mixing.replicate(many, F.length("text"), epochs=120.0, most=50.0)[0].groupBy("doc_id").count().collect()]
    assert abs(np.mean(n) - 120) < 4 and 80 < np.var(n) < 170


def test_chat_round_trip(spark):
    odd = ["<|im_end|>", "<\\|x", "<\\\\|", "<", "|", "", "é\n<|im_start|>user\n", "a" * 300_000]
    for t in odd:
        assert chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t)
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(odd)] + [(2, None, None, None), (2, 0, "assistant", None), (None, 0, "user", "q"), (3, 0, "user", "same"), (3, 0, "user", "same")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    for size in (1 << 22, 64):
        got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df, chunk_bytes=size)).collect()}
        assert set(got) == {1, 2, 3, None}
        said = [t for i, t in enumerate(odd) if i % 2]
        assert got[1].loss_chars == sum(map(len, said)) and got[1].loss_sha256 == hashlib.sha256("".join(said).encode()).hexdigest()
        turns = "".join(f"{'assistant' if i % 2 else 'user'}\n{t}\n" for i, t in enumerate(odd))
        assert got[1].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest() and got[1].n_turns == len(odd)
        assert got[2].n_turns == 2 and got[3].n_turns == 2 and got[2].loss_chars == 0
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_chat_roles_of_several_lines(spark):
    turns = [("user\nsystem", "hi"), ("a\\n\nb", "\\n"), ("<|im_end|>\n", "x\ny"), ("\\<\\|", ""), ("plain", "t"), ("", "")]
    for role, _ in turns:
        assert chat.unescape_role(chat.escape_role(role)) == role and "\n" not in chat.escape_role(role)
    df = spark.createDataFrame([(1, i, *t) for i, t in enumerate(turns)], "conv_id long, turn long, role string, text string")
    formatted = "".join(r.formatted for r in chat.format_conversations(df).collect())
    assert list(chat.turns_of(formatted)) == turns
    assert chat.read_back(chat.format_conversations(df)).first().n_turns == len(turns)


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 16)) * rng.uniform(0.5, 2, (300, 1))
    x[10:40] = x[10]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [math.nan] * 16), (903, [None] * 16), (904, [1.0]), (None, [1.0] * 16)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    got = {}
    for r in nearest.nearest(df, F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == set(range(0, 300, 20))
    hits = 0
    for q, found in got.items():
        s = [(-math.fsum((x[q] * x[j]).tolist()), j) for j in range(300) if j != q]
        hits += len(set(found) & {j for _, j in sorted(s)[:5]})
    assert hits / (5 * len(got)) >= 0.9
    # Copies, repeated rows and an id with two vectors: all candidates fit into k.
    few = [(i, [1.0, 0.0]) for i in (9, 4, 7, 2)] * 2 + [(5, [0.5, -0.0]), (5, [2.0, 0.0])]
    few = spark.createDataFrame(few, "vec_id long, embedding array<double>")
    found = [tuple(r) for r in nearest.nearest(few, F.col("vec_id") < 6, k=3).orderBy("query_id", "rank").collect()]
    assert found == [(2, 1, 5, 2.0), (2, 2, 4, 1.0), (2, 3, 7, 1.0), (4, 1, 5, 2.0), (4, 2, 2, 1.0), (4, 3, 7, 1.0), (5, 1, 2, 2.0), (5, 2, 4, 2.0), (5, 3, 7, 2.0)]
    assert nearest.nearest(df.limit(0), F.lit(True)).count() == 0
    assert nearest.nearest(df.where("vec_id < 3"), F.lit(True)).count() == 6


def test_nearest_recall_on_the_table(spark):
    from tessera.llm.queries import op5_nearest

    pdf = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    x, ids = np.stack(pdf.embedding).astype(float), pdf.vec_id.to_numpy()
    got = op5_nearest(spark, SF).toPandas().groupby("query_id").vec_id.apply(set)
    hits = [len(got[i] & set(ids[np.lexsort((ids, -np.where(ids == i, -9, x @ x[j])))[:20]])) / 20 for j, i in enumerate(ids) if i % 20 == 0]
    assert np.mean(hits) >= 0.9


def test_html_cases(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = html_extract.fit(pages)
    page = "<html><body><nav><ul><li><a href=/>Home</a></ul></nav><article><h1>A &amp; B</h1><p>One<b>two</b>\n three<br>four<script>no()</script></article><div class=comments><p>First!</p></div><footer>&copy; me</footer>"
    odd = spark.createDataFrame([(1, "u", page, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", "<", "x"), (5, "u", "<nav>a" * 300, "x")], "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(odd, model).collect()}
    assert got[1] == ("A & B Onetwo three four", 23) and got[2] == got[3] == ("", 0) and len(got) == 5
    assert html_extract.extract(odd.limit(0), model).count() == 0
    assert html_extract.extract(odd, html_extract.fit(odd.limit(0))).agg(F.sum("n_chars")).first()[0] == 0


def test_html_without_semantic_tags_or_short_pages(spark):
    rng = random.Random(8)

    def words(n):
        return " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))

    for container, size in (("div class=content", 30), ("article", 700)):  # untagged; all over 20,000 characters
        rows, want = [], {}
        for i in range(60):
            main = [words(5)] + [words(size) for _ in range(8)]
            body = f"<h1>{main[0]}</h1>" + "".join(f"<p>{t}</p>" for t in main[1:])
            menu = "".join(f"<li><a href=/>{words(1)}</a></li>" for _ in range(4))
            rows.append((i, "u", f"<html><body><ul class=menu>{menu}</ul><{container}>{body}</{container.split()[0]}><div class=footer><p>{words(4)}</p></div></body></html>"))
            want[i] = " ".join(main)
        pages = spark.createDataFrame(rows, "page_id long, url string, html string")
        got = {r.page_id: r.text for r in html_extract.extract(pages, html_extract.fit(pages)).collect()}
        assert sum(got[i] == want[i] for i in want) >= 55
    # So few pages are chosen that there may be none: one is taken all the same.
    assert html_extract.fit(pages, max_chars=1, max_pages=1).bias != -30.0


def test_token_cache(spark, docs, tmp_path):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path, cache = public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "cache")
    tok = Tokenizer.from_file(path)
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = sorted((str(i), len(t.encode()), len(tok.encode(t, add_special_tokens=False).ids)) for i, t in texts)
    for _ in range(2):
        got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, path, cache).collect())
        assert got == want
    assert spark.read.parquet(cache).count() == len({t for _, t in texts})  # the second run encoded nothing
    assert token_counts.count_tokens(docs.limit(0), path).count() == 0


def brute_groups(rows, k, num, den):
    sets = {}
    for i, t in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set()
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = root[a], root[b]
                root = {i: min(x, y) if r in (x, y) else r for i, r in root.items()}
    return {i: (len(sets[i]), root[i]) for i in sets}


def test_jaccard_against_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    rows = []
    for g in range(12):
        base = [f"v{rng.randrange(400)}" for _ in range(rng.choice([3, 4, 8, 40, 90]))]
        for _ in range(rng.choice([1, 2, 6, 40])):
            w = list(base)
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = f"v{rng.randrange(400)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "Alone")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n long".replace("n long", "n string"))
    for k, num, den in ((4, 85, 100), (5, 80, 100), (1, 50, 100)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_groups(df, k, num, den).collect()}
        assert got == brute_groups(rows, k, num, den)


def test_jaccard_cases(spark, docs):
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard_join.jaccard_groups(docs).collect())
    assert got == [("1", 2, 1), ("1", 2, 1), ("2", 0, 2), ("3", 0, 3), ("5", 1, 5), ("6", 1, 6), ("None", 2, 1)]
    assert jaccard_join.jaccard_groups(docs.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_decontamination_finds_replaced_slots(spark):
    item = "Mary bought 12 apples for 3 dollars and then Mary sold half of them to her friend for 5 dollars each day"
    other = item.replace("Mary", "Peter").replace("12", "17").replace("3", "9")
    mixed = "Peter bought 12 apples for 3 dollars and then Susan sold half of them to her friend for 5 dollars each day"
    rows = [(1, "so " + item + " end"), (2, "now " + other), (3, "x " + mixed), (4, None), (5, ""), (6, "nothing of the kind is here at all today or any day"), (7, (item + ". ") * 400)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short")], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.contaminated(df, bench).collect()}
    assert set(got) >= {1, 2, 7} and not set(got) & {4, 5, 6}
    assert not got[1].reparameterised and got[2].reparameterised and got[1].coverage == 1.0
    assert 3 not in got or got[3].coverage < 1
    assert decontamination.contaminated(df, bench.limit(0)).count() == 0 and decontamination.contaminated(df.limit(0), bench).count() == 0


def test_decontamination_of_items_with_one_prompt(spark):
    rng = random.Random(6)
    prompt = "please read the following short question with care and then give one answer to it"
    tails = [" ".join(f"q{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(20)) for _ in range(30)]
    bench = spark.createDataFrame([(i, f"{prompt} {t}") for i, t in enumerate(tails)], "item_id long, text string")
    rows = [(i, f"so {prompt} {t} end") for i, t in enumerate(tails[:10])] + [(100, prompt), (101, f"{prompt} and nothing else"), (None, tails[20]), (102, " ".join(tails[21].split()[:12]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.matched / r.windows for r in decontamination.contaminated(df, bench).collect()}
    words = {k: t.split() for k, t in [*rows, *((f"b{i}", f"{prompt} {t}") for i, t in enumerate(tails))]}
    want = {}
    for d, _ in rows:
        have = {tuple(words[d][j : j + 8]) for j in range(len(words[d]) - 7)}
        for i in range(30):
            own = [tuple(words[f"b{i}"][j : j + 8]) for j in range(len(words[f"b{i}"]) - 7)]
            share = sum(w in have for w in own) / len(own)
            if share >= 0.4:
                want[d, i] = share
    assert {k: v for k, v in want.items() if v >= 0.5} == got
    loose = decontamination.contaminated(df, bench, coverage=0.4).collect()
    assert {(r.doc_id, r.item_id) for r in loose} == set(want)


def test_decontamination_judges_slots_by_window(spark):
    item = "Mary bought 12 apples for 3 dollars and then Mary sold half of them to her friend for 5 dollars each day while Mary slept"
    once = item.replace("Mary", "Anna", 1)
    most = item.replace("Mary", "Anna").replace("while Anna", "while Susan")
    df = spark.createDataFrame([(1, once), (2, most), (3, item)], "doc_id long, text string")
    got = {r.doc_id: r for r in decontamination.contaminated(df, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    n = got[3].windows
    # All but the one window that holds the replaced name; all but the two that hold Susan.
    assert (got[1].matched, got[1].reparameterised) == (n - 1, False)
    assert (got[2].matched, got[2].reparameterised) == (n - 2, True)
    assert (got[3].matched, got[3].reparameterised) == (n, False)


def test_decontamination_of_items_with_few_words(spark):
    items = ["What is 15 + 27 - 8 * 3?", "Anna Bob Carl Dora Emil Frank Gina Hugo Ida Jack", "7 apples", "1 2 3 4 5 6 7 8 9 10 11 12 a note on the days of rain here"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = [(i, f"so {t} end") for i, t in enumerate(items)] + [(10, "what is 15 + 27 - 8 * 4?"), (11, "Anna Bob Carl Dora Emma Frank Gina Hugo Ida Jack"), (12, "8 apples"), (13, "it is a note on the days of rain here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.coverage for r in decontamination.contaminated(df, bench).collect()}
    assert got == {(i, i): 1.0 for i in range(4)}


def test_revisits(spark):
    def h(*lines):
        return "\r\n".join(("HTTP/1.1 200 OK", *lines))

    rows = [
        ("r1", "response", "HTTP://Ex.org:80/a?b=1&utm_x=2#f", "2024-01-01 00:00:00", h('ETag: "1"', "Content-Type: text/html", "Cache-Control: a"), "body1"),
        ("r2", "response", "http://ex.org/a?b=1", "2024-01-03 00:00:00", h('ETag: "2"'), "body2"),
        ("v1", "revisit", "http://ex.org/a?b=1", "2024-01-02 00:00:00", h('ETag: W/"1"', "Cache-Control: b", "Content-Length: 0"), None),
        ("v2", "revisit", "http://ex.org/a?b=1", "2024-01-04 00:00:00", h('ETag: "1"'), None),
        ("v3", "revisit", "http://ex.org/a?b=1", "2024-01-01 00:00:00", h('ETag: "1"'), None),
        ("v4", "revisit", "http://ex.org/a?b=1", "2024-01-05 00:00:00", None, None),
        ("v5", "revisit", None, None, h('ETag: "1"'), None),
        ("x", "metadata", "http://ex.org/a?b=1", "2024-01-02 00:00:00", None, None),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "record_id string, warc_type string, target_uri string, warc_date string, http_headers string, payload string, url int").withColumn("warc_date", F.to_timestamp("warc_date"))
    got = {r.record_id: r for r in revisits.resolve(df).collect()}
    assert {k: v.outcome for k, v in got.items()} == {"v1": "resolved", "v2": "mismatch", "v3": "no_response", "v4": "no_validator", "v5": "no_response"}
    assert got["v1"].payload == "body1" and got["v1"].headers == 'Content-Type: text/html\r\nETag: W/"1"\r\nCache-Control: b'
    assert revisits.resolve(df.limit(0)).count() == 0


def test_revisits_with_ties_and_repeats(spark):
    rows = [
        ("b", "response", "http://ex.org/a", "2024-01-01 00:00:00", 'HTTP/1.1 200 OK\r\nETag: "1"', "first"),
        ("c", "response", "http://ex.org/a", "2024-01-01 00:00:00", 'HTTP/1.1 200 OK\r\nETag: "1"', "same date"),
        ("c", "response", "http://ex.org/a", "2024-01-01 00:00:00", 'HTTP/1.1 200 OK\r\nETag: "1"', "same date"),
        ("v", "revisit", "http://ex.org/a", "2024-01-01 00:00:00", 'HTTP/1.1 304\r\nETag: "1"', None),  # not later
        ("w", "revisit", "http://ex.org/a", "2024-01-01 00:00:01", 'HTTP/1.1 304\r\nETag: "1"', None),
        ("w", "revisit", "http://ex.org/a", "2024-01-01 00:00:01", 'HTTP/1.1 304\r\nETag: "1"', None),  # repeated
        ("x", "revisit", "http://ex.org/a", "2024-03-01 00:00:00", 'HTTP/1.1 304\r\nETag: "1"', None),  # many hours later
        ("y", "revisit", "", "2024-03-01 00:00:00", 'HTTP/1.1 304\r\nETag: "1"', None),
    ]
    df = spark.createDataFrame(rows, "record_id string, warc_type string, target_uri string, warc_date string, http_headers string, payload string").withColumn("warc_date", F.to_timestamp("warc_date"))
    got = sorted((r.record_id, r.outcome, r.response_id, r.payload) for r in revisits.resolve(df).collect())
    assert [g[:2] for g in got] == [("v", "no_response"), ("w", "resolved"), ("w", "resolved"), ("x", "resolved"), ("y", "no_response")]
    # Of responses of one date the greatest record id is taken, by every revisit alike.
    assert {g[2:] for g in got if g[1] == "resolved"} == {("c", "same date")}


def test_toxicity_held_out_rows(spark):
    from tessera.llm.queries import op2_toxicity

    sf = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    r = op2_toxicity(spark, sf).where("held_out").join(truth, "doc_id").agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("caught"), F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("alarms")
    ).first()
    assert r.caught > 0.75 and r.alarms < 0.02


def test_toxicity_of_repeated_and_long_rows(spark, docs):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=40)) + (" nasty vile" if i % 8 == 0 else ""), int(i % 8 == 0)) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    out, name = toxicity.score(docs.select("doc_id", "text").union(spark.createDataFrame([(70, "vile " * 60_000), (70, "vile " * 60_000)], "doc_id long, text string")), model)
    got = [(r.doc_id, r[name]) for r in out.collect()]
    assert len(got) == docs.count() + 2 and all(0 <= v <= 1 for _, v in got)
    assert len({v for i, v in got if i == 70}) == 1 and len({v for i, v in got if i == 1}) == 1  # equal texts score alike
    assert dict(got)[70] > dict(got)[5]


def test_sql_of_the_subpackage(spark):
    import duckdb

    from tessera.llm.queries import QUERIES, SQL

    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, text in SQL.items():
        df = QUERIES[name](spark, SF)
        res = con.execute(text)
        names = [d[0] for d in res.description]
        assert sorted(names) == sorted(df.columns)
        assert sorted(map(str, (tuple(r[c] for c in names) for r in df.collect()))) == sorted(map(str, res.fetchall())), name


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline as P

    docs = spark.createDataFrame([(1, "der die das und ist nicht mit von", "de", "a", 30), (2, "der die das und ist nicht mit von", "de", "a", 30), (3, None, "en", "a", 0), (4, "the and of with this that from by", "en", "b", 30)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = P.drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]
    assert sorted(r.doc_id for r in P.decontaminate(spark, docs, SF).collect()) == [1, 2, 3, 4]
    assert 3 not in [r.doc_id for r in P.identify_language(spark, docs, SF).collect()]


def test_pipeline_judges_rows_without_an_id(spark):
    import corpus_pipeline as P

    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    clean = "nothing of the kind is here at all today or any day"
    half = item.split()[: len(item.split()) // 2 - 1]
    rest = item.split()[len(item.split()) // 2 - 1 :][: len(half)]
    rows = [(None, f"so {item} end"), (None, clean), (1, f"so {item} end"), (2, clean), (None, None), (None, clean + " too"), (None, " ".join(half)[:40]), (None, " ".join(rest)[:40])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, text_key string")
    kept = P.decontaminate(spark, docs, SF)
    assert kept.columns == docs.columns
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted((r for r in rows if item not in (r[1] or "")), key=key)


def test_join_unique_with_a_hot_key(spark):
    from tessera.llm.common import join_unique

    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("is_hot"))
    table = spark.range(0, 9000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = join_unique(rows, table, ["k"])
    assert got.count() == 9000 and got.where("v IS NOT NULL AND v != 2 * k").count() == 0
    want = rows.join(table, "k", "left")
    assert got.select("k", "is_hot", "v").exceptAll(want.select("k", "is_hot", "v")).count() == 0
    assert join_unique(rows.limit(0), table, ["k"]).count() == 0 and join_unique(rows, table.limit(0), ["k"]).where("v IS NULL").count() == 9000
