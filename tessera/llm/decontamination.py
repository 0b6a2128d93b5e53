"""Benchmark decontamination by template canonicalisation.

Texts become canonical tokens: numbers, names (words that begin with a capital) and units
turn into typed placeholders, other words count case-folded. Windows of ``WINDOW`` tokens of
the benchmark are hash-joined with those of the documents under up to three keys:

* the folded tokens themselves, so a verbatim copy meets its original whatever its capitals;
* the template, so a question whose numbers or names were replaced still meets it;
* the template with names as plain words, where numbers or units stand beside capitals, so
  replaced numbers are found in a copy with other capitals too.

Templates of fewer than ``MIN_LITERALS`` plain words say too little and are no keys.

Matches of a document and an item are collected by alignment (document position minus
item position). A verbatim window always counts. One with replaced slots counts if they are
consistent: each value of the item is replaced by the value that takes its place at most
positions of the alignment (of equally many: itself, else the one that comes first). The
document is contaminated by the item if the windows that count cover at least ``coverage``
of the item's windows.

The documents' windows pass a fixed-size Bloom filter of the benchmark's keys before
the join, so only likely matches leave the scan; the joins have no hint. Windows that many
items share (a common prompt, say) must not pair every document with every such item: a
document that covers enough of an item meets one of any (all - needed + 1) of its windows,
so pairs are found on that many of each item's rarest windows, and only those pairs are
then matched on all windows.

Defined cases: null and empty texts have no windows; an item shorter than a window is one
window of its own length, and an item of a single token matches each text that has it;
repeated items and repeated rows count once each by id; rows of one id with different texts,
and rows without an id, are judged apart, the latter reported under the null id. Only ids
and texts are read. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import CHUNK, bounded_batches, grouped_by_bytes, mix, written

WINDOW = 8
MIN_LITERALS = 4
COVERAGE = 0.5
BLOOM_BITS = 24
#: Unit words that become a placeholder.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons pound pounds "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month "
    "months year years cent cents dollar dollars euro euros percent degree degrees"
).split()
# Byte classes: 0 separator, 1 digit, 2 letter.
_CLASS = np.array([1 if 48 <= b <= 57 else 2 if b >= 128 or 65 <= b <= 90 or 97 <= b <= 122 else 0 for b in range(256)], np.uint8)
_NUMBER, _NAME, _UNIT = (np.uint64(v) for v in (11, 13, 17))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WINDOWS = "id long, sub long, pos long, h long, slots array<long>, width int"


def _hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    powers = np.full(int(lengths.max()), _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    first = np.cumsum(lengths) - lengths
    step = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    return mix(np.add.reduceat((data[np.repeat(starts, lengths) + step].astype(np.uint64) + np.uint64(1)) * powers[step], first) + lengths.astype(np.uint64))


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and whether it is a number of every token."""
    kind = _CLASS[data]
    # A point or comma between digits belongs to the number.
    inner = np.flatnonzero((data[1:-1] == 44) | (data[1:-1] == 46)) + 1
    kind[inner[(kind[inner - 1] == 1) & (kind[inner + 1] == 1)]] = 1
    edge = np.flatnonzero(np.append(True, kind[1:] != kind[:-1]))
    ends = np.append(edge[1:], len(data))
    word = kind[edge] > 0
    return edge[word], (ends - edge)[word], kind[edge[word]] == 1


def _capital(data: np.ndarray, starts: np.ndarray, folded: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether folding changes the first character of each token."""
    differs = np.zeros(len(starts), bool)
    for j, least in ((0, 0), (1, 0x80), (2, 0xE0)):  # bytes of the character
        x, y = data[np.minimum(starts + j, len(data) - 1)], folded[np.minimum(at + j, len(folded) - 1)]
        differs |= (x != y) & (folded[at] >= least)
    return differs


Tokens = tuple[np.ndarray, np.ndarray, np.ndarray]


def _tokens(texts: list[bytes], folded: list[bytes]) -> Iterator[Tokens]:
    """For each text: folded hashes of its tokens, which are numbers or units, and which names."""
    joined = [np.frombuffer(b" " + b" ".join(t) + b" ", np.uint8) for t in (texts, folded)]
    starts, _, _ = _spans(joined[0])
    at, lengths, number = _spans(joined[1])
    if len(starts) != len(at) and len(texts) > 1:
        for t, f in zip(texts, folded):
            yield from _tokens([t], [f])
        return
    if len(at):
        plain = _hashes(joined[1], at, lengths)
        typed = np.where(number, _NUMBER, np.where(np.isin(plain, _unit_hashes()), _UNIT, np.uint64(0)))
    else:
        plain = typed = np.empty(0, np.uint64)
    same = len(starts) == len(at)  # folding splits no word, but for odd marks: then no names
    name = _capital(joined[0], starts, joined[1], at) & (typed == 0) if same and len(at) else np.zeros(len(at), bool)
    cuts = np.append(0, np.searchsorted(at, 1 + np.cumsum([len(f) + 1 for f in folded])))
    for a, b in zip(cuts, cuts[1:]):
        yield plain[a:b], typed[a:b], name[a:b]


def _unit_hashes() -> np.ndarray:
    lengths = np.array([len(u) for u in UNITS])
    return _hashes(np.frombuffer("".join(UNITS).encode(), np.uint8), np.cumsum(lengths) - lengths, lengths)


def canonical(texts: list[str | None]) -> Iterator[tuple[int, Tokens]]:
    """(index, tokens) of every text."""
    ready = [(t or "").encode("utf-8", "replace") for t in texts]
    for part in grouped_by_bytes(ready, 4096, CHUNK):
        folded = [(t or "").casefold().encode("utf-8", "replace") for t in texts[part]]
        yield from enumerate(_tokens(ready[part], folded), part.start)


def _rolled(tokens: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hash of every window of ``width`` tokens."""
    n = len(tokens) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h, size = mix(tokens + np.uint64(seed)), 1
    while 2 * size <= width:
        h, size = mix(h[:-size] * np.uint64(0xFF51AFD7ED558CCD) + h[size:]), 2 * size
    for j in range(size, width):
        h = mix(h[: len(h) - 1] * np.uint64(0xFF51AFD7ED558CCD) + mix(tokens[j : j + len(h) - 1] + np.uint64(seed)))
    return h[:n]


def windows(tokens: Tokens, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Places, keys, and slot values by token (0: a plain word) of each kind of key; verbatim
    keys have no slots."""
    plain, typed, name = tokens
    exact = _rolled(plain, width, 1)
    yield np.arange(len(exact)), exact, None
    kinds = []
    if name.any() or typed.any():
        kinds.append(np.where(name, _NAME, typed))
    if typed.any() and name.any():
        kinds.append(typed)
    done = np.full(len(exact), False)
    for slot in kinds:
        count = np.append(0, np.cumsum(slot != 0))
        slots = count[width:] - count[:-width]
        use = (slots > 0) & (width - slots >= min(MIN_LITERALS, width))
        if slot is typed:  # without a name in the window the template before is the same
            names = np.append(0, np.cumsum(name))
            use &= ~(done & (names[width:] == names[:-width]))
        else:
            done = use
        at = np.flatnonzero(use)
        if at.size:
            keys = _rolled(np.where(slot != 0, slot, plain), width, 0)
            yield at, keys[at], np.where(slot != 0, plain | np.uint64(1), np.uint64(0))


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h >> np.uint64(64 - BLOOM_BITS)).astype(np.int64), (h & np.uint64((1 << BLOOM_BITS) - 1)).astype(np.int64)


def _batch(ids, subs, pos, h, slots, width) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(subs, pa.int64()),
            pa.array(pos, pa.int64()),
            pa.array(np.asarray(h, np.uint64).view(np.int64)),
            pa.array([s.view(np.int64) for s in slots], pa.list_(pa.int64())),
            pa.array(width, pa.int32()),
        ],
        ["id", "sub", "pos", "h", "slots", "width"],
    )


def window_rows(texts: DataFrame, bloom: np.ndarray | None, widths: list[int] | None) -> DataFrame:
    """Window rows of (id, sub, text). Without ``widths`` each text gives its windows of
    ``WINDOW`` tokens, or one of its own length if it is shorter."""
    verbatim = np.empty(0, np.uint64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = np.unpackbits(bloom).astype(bool) if bloom is not None else None
        for batch in batches:
            ids, subs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[list] = [[], [], [], [], [], []]
            for i, tokens in canonical(batch.column(2).to_pylist()):
                for width in widths or [min(WINDOW, max(len(tokens[0]), 1))]:
                    for at, h, slots in windows(tokens, width):
                        if flat is not None and len(h):
                            x, y = _bits(h)
                            keep = flat[x] & flat[y]
                            at, h = at[keep], h[keep]
                        for p, k in zip(at.tolist(), h):
                            for column, value in zip(out, (ids[i], subs[i], p, k, verbatim if slots is None else slots[p : p + width], width)):
                                column.append(value)
                if len(out[0]) >= 10_000:
                    yield _batch(*out)
                    out = [[], [], [], [], [], []]
            if out[0]:
                yield _batch(*out)

    return texts.mapInArrow(cut, _WINDOWS)


def _bloom(items: DataFrame) -> np.ndarray:
    """Bit array of 2**BLOOM_BITS: its size does not follow the benchmark's."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.unique(np.concatenate(_bits(b.column(0).to_numpy().view(np.uint64)))) for b in batches]
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)) if found else np.empty(0, np.int64))], ["bit"])

    bits = items.select("h").mapInArrow(mark, "bit long").distinct().toPandas()["bit"].to_numpy(np.int64)
    flat = np.zeros(1 << BLOOM_BITS, bool)
    flat[bits] = True
    return np.packbits(flat)


def rarest(keys: DataFrame, coverage: float) -> DataFrame:
    """(item_id, h, width) of each item's rarest windows, one of which every text that
    covers ``coverage`` of the item holds."""
    times = keys.groupBy("h", "width").agg(F.count("*").alias("times"))
    places = keys.join(times, ["h", "width"]).groupBy("id", "pos", "windows").agg(F.sum("times").alias("times"))
    order = Window.partitionBy("id").orderBy("times", "pos")
    needed = F.ceil(F.lit(coverage) * F.col("windows") - F.lit(1e-9))
    ranked = places.withColumn("at", F.row_number().over(order)).where(F.col("at") <= F.col("windows") - needed + 1).select("id", "pos")
    return keys.join(ranked, ["id", "pos"]).select(F.col("id").alias("item_id"), "h", "width").distinct()


def consistent(at: list[int], item: list[list[int]], own: list[list[int]]) -> tuple[list[int], bool]:
    """Item positions of an alignment's windows that count, and whether any of them has
    replaced slots. ``item`` and ``own`` hold the slots of each window (0: a plain word)."""
    pairs = {(p + j, b, d) for p, bs, ds in zip(at, item, own) for j, (b, d) in enumerate(zip(bs, ds)) if b}
    votes: dict[tuple[int, int], list[int]] = {}
    for p, b, d in pairs:
        vote = votes.setdefault((b, d), [0, p])
        vote[0], vote[1] = vote[0] + 1, min(vote[1], p)
    chosen: dict[int, tuple] = {}
    for (b, d), (times, first) in votes.items():
        chosen[b] = max(chosen.get(b, (0,)), (times, b == d, -first, d))
    kept, swapped = [], False
    for p, bs, ds in zip(at, item, own):
        replaced = any(b != d for b, d in zip(bs, ds))
        if not replaced or all(not b or chosen[b][3] == d for b, d in zip(bs, ds)):
            kept.append(int(p))
            swapped |= replaced
    return kept, swapped


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", coverage: float = COVERAGE) -> DataFrame:
    """One row for each contaminated document and item: doc_id, item_id, matched, windows,
    coverage, and whether slots were replaced (``reparameterised``)."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("at array<long>, swapped boolean")
    def counting(at: pd.Series, item: pd.Series, own: pd.Series) -> pd.DataFrame:
        found = [consistent(a.tolist(), [s.tolist() for s in b], [s.tolist() for s in d]) for a, b, d in zip(at, item, own)]
        return pd.DataFrame(found, columns=["at", "swapped"])

    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.lit(0).cast("long").alias("sub"), F.col("text").alias("text"))
    keys = written(window_rows(items, None, None).drop("sub").dropDuplicates(["id", "pos", "h", "width"]), "benchmark-windows")
    widths = sorted(r[0] for r in keys.select("width").distinct().collect())  # at most WINDOW values
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("sub"), F.col(text).alias("text"))
    left = written(window_rows(rows, _bloom(keys), widths or [WINDOW]), "likely-windows")
    total = keys.groupBy("id").agg(F.count_distinct("pos").alias("windows"))
    right = keys.join(total, "id").select("h", "width", F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"), "windows")
    pairs = left.select("id", "sub", "h", "width").join(rarest(keys.join(total, "id"), coverage), ["h", "width"])
    pairs = pairs.select(F.col("id").alias("own"), F.col("sub").alias("own_sub"), "item_id").distinct()
    met = left.join(pairs, F.col("id").eqNullSafe(F.col("own")) & (F.col("sub") == F.col("own_sub"))).join(right, ["item_id", "h", "width"])
    met = met.select("id", "sub", "item_id", "windows", (F.col("pos") - F.col("item_pos")).alias("shift"), F.struct("item_pos", "item_slots", "slots").alias("w"))
    aligned = met.groupBy("id", "sub", "item_id", "windows", "shift").agg(F.collect_set("w").alias("w"))
    # Most alignments are verbatim throughout: all their windows count, and Python sees none.
    swapped = F.exists("w", lambda w: w["item_slots"] != w["slots"])
    judged = aligned.withColumn("some", swapped).withColumn("judge", F.filter("w", lambda w: F.col("some")))
    judged = judged.withColumn("c", counting("judge.item_pos", "judge.item_slots", "judge.slots"))
    counted = judged.select("id", "sub", "item_id", "windows", F.when(F.col("some"), F.col("c.at")).otherwise(F.col("w.item_pos")).alias("at"), F.col("c.swapped").alias("swapped"))
    found = counted.groupBy("id", "sub", "item_id", "windows").agg(F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("matched"), F.max("swapped").alias("reparameterised"))
    share = F.col("matched") / F.col("windows")
    out = found.where(share >= coverage).select("sub", F.col("id").alias("doc_id"), "item_id", "matched", "windows", share.alias("coverage"), "reparameterised")
    return out.drop("sub")
