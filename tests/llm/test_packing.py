"""Packing against the fewest sequences a plain search finds, and against the tokenizer."""

import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessera.llm import packing as K

JSON = public_tokenizers.path("byte_bpe_50k.json")


def fewest(sizes, capacity):
    """The fewest sequences, over all ways to fill them one piece at a time."""

    @lru_cache(None)
    def go(left, room):
        if not left:
            return 0
        best, tried = len(left), set()
        for i, s in enumerate(left):
            if s in tried:
                continue
            tried.add(s)
            rest = left[:i] + left[i + 1 :]
            best = min(best, go(rest, room - s) if s <= room else 1 + go(rest, capacity - s))
        return best

    return go(tuple(sorted(sizes, reverse=True)), 0)


def check_plan(plan, counts, capacity):
    used = Counter()
    for many, content in plan:
        assert many > 0 and sum(s * n for s, n in content.items()) <= capacity
        for s, n in content.items():
            used[s] += many * n
    assert used == Counter(counts)


@pytest.mark.parametrize("seed", range(4))
def test_completion_finds_the_fewest(seed):
    rng, gained = random.Random(seed), 0
    for _ in range(40):
        capacity = rng.choice([10, 20, 37])
        sizes = [rng.randint(1, rng.choice([capacity // 2, capacity])) for _ in range(rng.randint(1, 9))]
        counts = dict(Counter(sizes))
        plan, least = K.complete(counts, capacity)
        check_plan(plan, counts, capacity)
        got, want = sum(m for m, _ in plan), fewest(sizes, capacity)
        assert least <= want == got
        gained += sum(m for m, _ in K.best_fit(counts, capacity)) > got
    # Best fit alone needs four: 6 4 | 6 4 ... against the pairs that fit exactly.
    counts = {7: 2, 5: 2, 4: 2, 3: 3, 2: 1}
    assert sum(m for m, _ in K.complete(counts, 13)[0]) == fewest([s for s, n in counts.items() for _ in range(n)], 13)


def test_completion_beats_best_fit_and_scales():
    # Triplets that fill a sequence exactly: best fit leaves waste.
    rng = random.Random(9)
    counts = Counter()
    for _ in range(12):
        a, b = rng.randint(30, 45), rng.randint(25, 35)
        counts.update([a, b, 100 - a - b])
    plan, least = K.complete(dict(counts), 100, nodes=20_000)
    check_plan(plan, counts, 100)
    assert least == 12 and sum(m for m, _ in plan) < sum(m for m, _ in K.best_fit(dict(counts), 100))
    # Counts in the millions cost no more than their lengths.
    counts = {s: rng.randint(1, 10**7) for s in range(1, 2049, 3)}
    plan, least = K.complete(counts, 2048, nodes=50)
    check_plan(plan, counts, 2048)
    assert sum(m for m, _ in plan) <= 1.001 * least and len(plan) < 4 * 2048


def test_undominated_fillings_hold_a_best_one():
    rng = random.Random(4)
    for _ in range(60):
        counts, room = dict(Counter(rng.choices(range(1, 15), k=6))), rng.randint(1, 25)
        found = list(K.fillings(counts, room, 1 << 30))
        sums = {0}
        for s, n in counts.items():
            sums = {x + k * s for x in sums for k in range(n + 1)}
        best = max(x for x in sums if x <= room)
        assert max(sum(s * n for s, n in f.items()) for f in found) == best
        assert all(all(n <= counts[s] for s, n in f.items()) for f in found)


def test_encoder_equals_the_library():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(JSON)
    odd = [a + chr(c) + b for c in range(0x260) for a in ("", "a", " ", "1", "\n") for b in ("", "b", " 2", "!", "\n", " z")]
    odd += ["x<|endoftext|>y", "  a  b \n\n c\t", "日本 語 <|endoftext|>", "it's we'll'LL", "", "Ⅷ٣ 　x"]
    with open(JSON, encoding="utf-8") as f:
        spec = f.read()
    assert [x.tolist() for x in K.encoder(spec)(odd)] == [e.ids for e in tok.encode_batch(odd, add_special_tokens=False)]
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        other = f.read()
    tok = Tokenizer.from_str(other)
    assert [x.tolist() for x in K.encoder(other)(odd[:500])] == [e.ids for e in tok.encode_batch(odd[:500], add_special_tokens=False)]


def test_pieces_fill_sequences_and_read_back(spark, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(JSON)
    capacity = 64
    rows = docs.select("doc_id", "text", F.lit("x").alias("length"), F.lit(1).alias("task"))
    packed = K.pack(K.pieces(rows, JSON, capacity, keep_ids=True), capacity)
    got = packed.collect()
    want, texts = Counter(), docs.collect()
    for r in texts:
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % capacity + 1 if len(ids) > capacity else len(ids)
        for k, a in enumerate([0, *range(first, len(ids), capacity)]):
            part = ids[a : first if a == 0 else a + capacity]
            want[r.doc_id, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length, r.ids))
    whole = {r.sequence_id: (r.n_pieces, r.ids) for r in K.sequences(packed).collect()}
    for s, parts in held.items():
        at = 0
        for offset, length, ids in sorted(parts):
            assert offset == at and len(ids) == length
            at += length
        assert at <= capacity and whole[s] == (len(parts), [i for p in sorted(parts) for i in p[2]])
    assert len(whole) == len(held)
    assert K.pack(K.pieces(docs.limit(0), JSON, capacity), capacity).count() == 0


def test_query_packs_the_whole_table(spark):
    from tessera.llm.queries import op11_bestfit_packing

    sf = "/root/testdata/sf0.001"
    got = op11_bestfit_packing(spark, sf)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) == -(-total // 2048)
