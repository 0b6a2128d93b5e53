"""Periodic runs of words by recompression.

A run is a stretch of consecutive words with smallest period q, of at least
``min_length`` words and ``min_copies`` periods, that no neighbouring word extends.

Candidates come from the harmonic grid: a run of period p holds neighbouring multiples of p,
so for each p only the places 0, p, 2p, ... are compared with the next one, which is
n/1 + n/2 + ... = n log n places in all. A place stays a candidate where the windows of
``window`` words there and p words later have one hash; each run has such a place, its first
one on the grid.

The exact ends of a candidate are two longest common extensions, forward and backward, of
the place and the place p words later. They are read from a run-length grammar that
recompression builds over the documents that have candidates: rounds of block compression
(a maximal row of one symbol becomes one symbol) and pair compression (symbols are dealt to
a left and a right side, each left-right pair becomes one symbol) alternate until few
symbols are left. Equal symbols stand for equal words, so an extension climbs the rounds
while both places start a symbol, walks over equal symbols, and descends where symbols
differ. No suffix array is built. Symbols are named by sorting the pairs themselves, so
extensions do not rest on hashes.

Documents are worked on by task, in slices of a few megabytes, without a shuffle; a task
holds one slice, and one document if that is longer.

Defined cases: null and empty texts have no words and no runs; repeated rows come back as
often as they went in; rows without an id keep a null id; an empty table gives no rows. Of
the input only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, grouped_by_bytes, mix

#: Words of documents that share one grid and one grammar (one longer document may exceed it).
GROUP_WORDS = 1 << 17
#: Grid places compared at once, and candidates held before they are extended.
GRID, PENDING = 1 << 16, 1 << 18
ROUNDS = 200


# -- grammar ---------------------------------------------------------------------------


@dataclass
class Level:
    """Symbols of one round; ``parent`` and ``first`` lead to the next round and back."""

    names: np.ndarray
    parent: np.ndarray | None = None  # index of the next round's symbol that holds it
    first: np.ndarray | None = None  # first child of each symbol of the next round, and the end
    blocks: bool = False  # the next round's symbols are rows of one symbol

    def mirrored(self) -> Level:
        """The same round read from the right."""
        if self.parent is None:
            return Level(self.names[::-1])
        n, m = len(self.names), len(self.first) - 1
        return Level(self.names[::-1], m - 1 - self.parent[::-1], n - self.first[::-1], self.blocks)

    def rest(self, at: np.ndarray) -> np.ndarray | int:
        """Symbols from ``at`` to the end of its row of equal ones."""
        return self.first[self.parent[at] + 1] - at if self.blocks else 1


def _blocks(names: np.ndarray, taken: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First children and names after block compression."""
    first = np.concatenate(([0], np.flatnonzero(names[1:] != names[:-1]) + 1, [len(names)]))
    size, out = np.diff(first), names[first[:-1]]
    row = np.flatnonzero(size > 1)
    _, which = np.unique(out[row] * np.int64(len(names) + 1) + size[row], return_inverse=True)
    out[row] = taken + which
    return first, out, taken + int(which.max()) + 1


def _pairs(names: np.ndarray, taken: int, seed: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First children and names after pair compression; of the two ways to call the sides,
    the one with more pairs."""
    side = (mix(names.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)) & np.uint64(1)).astype(bool)
    one, two = ~side[:-1] & side[1:], side[:-1] & ~side[1:]
    left = one if np.count_nonzero(one) >= np.count_nonzero(two) else two
    inner = np.concatenate(([False], left))  # second symbol of a pair
    first = np.flatnonzero(~inner)
    pair = np.flatnonzero(left)
    out = names[first]
    if pair.size:
        _, which = np.unique(names[pair] * np.int64(taken) + names[pair + 1], return_inverse=True)
        out[np.searchsorted(first, pair)] = taken + which
        taken += int(which.max()) + 1
    return np.append(first, len(names)), out, taken


def recompress(names: np.ndarray, few: int) -> list[Level]:
    """Rounds over ``names`` (small non-negative integers) until ``few`` symbols are left.
    First and last name must be unlike all others."""
    names = names.astype(np.int64)
    levels, taken = [Level(names)], int(names.max()) + 1
    for step in range(ROUNDS):
        if len(names) <= few:
            break
        same = bool((names[1:] == names[:-1]).any())
        first, names, taken = _blocks(names, taken) if same else _pairs(names, taken, step)
        if len(first) - 1 == len(levels[-1].names):
            continue
        mark = np.zeros(first[-1], np.int64)
        mark[first[:-1]] = 1
        levels[-1].parent, levels[-1].first, levels[-1].blocks = np.cumsum(mark) - 1, first, same
        levels.append(Level(names))
    return levels


def extensions(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words agree from each place ``a`` and its place ``b`` > ``a`` on."""
    out = np.empty(len(a), np.int64)
    who, i, j = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
    stopped: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []
    for level in levels:  # climb
        here, up = [], []
        while who.size:
            if level.parent is not None:
                pi, pj = level.parent[i], level.parent[j]
                both = (level.first[pi] == i) & (level.first[pj] == j)
                up.append((who[both], pi[both], pj[both]))
                who, i, j = who[~both], i[~both], j[~both]
            same = level.names[i] == level.names[j]
            here.append((who[~same], i[~same], j[~same]))
            who, i, j = who[same], i[same], j[same]
            step = np.minimum(level.rest(i), level.rest(j))
            i, j = i + step, j + step
        stopped.append(here)
        if up:
            who, i, j = (np.concatenate(x) for x in zip(*up))
    who, i, j = (np.empty(0, np.int64) for _ in range(3))
    for at in range(len(levels) - 1, -1, -1):  # descend
        level = levels[at]
        if who.size:
            i, j = level.first[i], level.first[j]
        parts = [*stopped[at], (who, i, j)]
        who, i, j = (np.concatenate(x) for x in zip(*parts))
        moving = np.arange(len(who))
        while moving.size:
            moving = moving[level.names[i[moving]] == level.names[j[moving]]]
            step = np.minimum(level.rest(i[moving]), level.rest(j[moving]))
            i[moving] += step
            j[moving] += step
    out[who] = i
    return out - a


# -- runs ------------------------------------------------------------------------------


def window_for(min_length: int, min_copies: int) -> int:
    """Words of the windows compared on the grid: the largest power of two up to 8 for which
    every run agrees with itself, one period on, over the window at its first grid place."""
    if min_copies < 3:
        return 1
    return next(w for w in (8, 4, 2, 1) if 3 * w - 5 <= min_length)


def _window_hashes(names: np.ndarray, owner: np.ndarray, width: int) -> np.ndarray:
    h = mix(names.astype(np.uint64) + mix(owner.astype(np.uint64) + np.uint64(1)))
    step = 1
    while step < width:
        h = mix(h[:-step] * np.uint64(0xFF51AFD7ED558CCD) + h[step:])
        step *= 2
    return h


def _grid(h: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods) whose window agrees with that of the next place on the grid."""
    p0 = 1
    while p0 <= most:
        k = len(h) // p0 + 2
        p = np.arange(p0, min(most + 1, p0 + max(1, GRID // k)))
        x = p[:, None] * np.arange(k)
        inside = x < len(h)
        v = h[np.where(inside, x, 0)]
        row, col = np.nonzero((v[:, 1:] == v[:, :-1]) & inside[:, 1:])
        yield x[row, col], p[row]
        p0 = int(p[-1]) + 1


def _resolve(names: np.ndarray, owner: np.ndarray, cuts: np.ndarray, x: np.ndarray, p: np.ndarray, min_length: int, min_copies: int) -> np.ndarray:
    """Rows (start, end, period) of the runs behind the candidates, over a grammar of the
    documents that hold them. ``cuts`` are the places of the separators."""
    held = np.unique(owner[x])
    sizes = cuts[held + 1] - cuts[held]  # a document and the separator behind it
    base = np.concatenate(([1], 1 + np.cumsum(sizes)))
    take = np.repeat(cuts[held] + 1 - base[:-1], sizes) + np.arange(1, base[-1])
    symbols = np.concatenate(([cuts.size + int(names.max())], names[take]))
    levels = recompress(symbols, 2 * len(held) + 16)
    at = x - (cuts[held] + 1 - base[:-1])[np.searchsorted(held, owner[x])]
    ahead = extensions(levels, at, at + p)
    n = len(symbols)
    behind = extensions([v.mirrored() for v in levels], n - at - p, n - at)
    start, end = x - behind, x + p + ahead
    long = end - start >= np.maximum(min_length, min_copies * p)
    return np.stack((start[long], end[long], p[long]), axis=1)


def group_runs(docs: list[np.ndarray], taken: int, min_length: int, min_copies: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each document, by start, then period.
    Documents are arrays of word numbers below ``taken``."""
    width = window_for(min_length, min_copies)
    sizes = np.array([len(d) for d in docs])
    cuts = np.concatenate(([0], np.cumsum(sizes + 1)))
    names = np.empty(int(cuts[-1]) + width, np.int64)
    owner = np.repeat(np.arange(len(docs) + 1), np.concatenate((sizes + 1, [width])))
    for d, c in zip(docs, cuts):
        names[c + 1 : c + 1 + len(d)] = d
    names[cuts] = taken + np.arange(len(cuts))
    names[cuts[-1] + 1 :] = taken + len(cuts) + np.arange(width - 1)
    owner = np.concatenate(([0], owner[:-1]))  # a separator belongs to the document before it
    found: dict[tuple[int, int], int] = {}
    period, until = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    xs: list[np.ndarray] = []
    ps: list[np.ndarray] = []
    pending = 0

    def flush() -> None:
        x, p = np.concatenate(xs), np.concatenate(ps)
        rows = np.unique(_resolve(names, owner, cuts, x, p, min_length, min_copies), axis=0)
        for s, e, q in sorted(rows.tolist(), key=lambda r: (r[2], r[1] - r[0])):
            if found.setdefault((s, e), q) == q:
                period[s:e], until[s:e] = q, e
        xs.clear()
        ps.clear()

    for x, p in _grid(_window_hashes(names, owner, width), int(sizes.max()) // min_copies):
        # Places a known run covers with a divisor of p give that run again.
        q = period[x]
        new = (owner[x] == owner[x + p]) & ((q == 0) | (p % np.maximum(q, 1) != 0) | (x + p >= until[x]))
        if new.any():
            xs.append(x[new])
            ps.append(p[new])
            pending += len(xs[-1])
        if pending >= PENDING:
            flush()
            pending = 0
    if pending:
        flush()
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    for (s, e), q in found.items():
        d = int(owner[s])
        out[d].append((s - int(cuts[d]) - 1, e - s, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def texts_runs(texts: list[bytes], min_length: int, min_copies: int) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and runs of each text."""
    words = [t.split() for t in texts]  # ASCII white space: space and 9 to 13
    number: dict[bytes, int] = defaultdict(count().__next__)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted((i for i, w in enumerate(words) if len(w) >= min_length), key=lambda i: len(words[i]))
    group: list[int] = []
    size = 0

    def work(ids: list[int]) -> None:
        docs = [np.fromiter(map(number.__getitem__, words[i]), np.int64, len(words[i])) for i in ids]
        for i, runs in zip(ids, group_runs(docs, len(number), min_length, min_copies)):
            found[i] = runs

    for i in order:
        if group and size + len(words[i]) > GROUP_WORDS:
            work(group)
            group, size = [], 0
        group.append(i)
        size += len(words[i])
    if group:
        work(group)
    yield from zip(words, found)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of all runs and in each run's first period, joined by one space."""
    if runs:
        drop = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            drop[start + period] += 1
            drop[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0)]
    return b" ".join(words)


def find_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_length: int = 24, min_copies: int = 3) -> DataFrame:
    """doc_id, n_words, runs (start, length, period in words, by start, then period) and the
    collapsed text, which drops every word that a run holds after its first period."""
    if min_copies < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")
    bounded_batches(docs.sparkSession)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), pc.cast(batch.column(1), pa.binary()).to_pylist()
            for part in grouped_by_bytes(texts, len(texts) + 1):
                counts, runs, kept = [], [], []
                for words, found in texts_runs(texts[part], min_length, min_copies):
                    counts.append(len(words))
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    kept.append(collapse(words, found))
                columns = [ids.slice(part.start, part.stop - part.start), pa.array(counts, pa.int64()), pa.array(runs, run_type), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    read = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(work, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def planted(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and text, where texts of ids whose crc32 is divisible by 10 repeat themselves:
    with n words, h the crc32, g = h div 10, a = g mod n and p = 1 + (n - a) div (3 + g mod 8),
    each word i from a on becomes word a + (i - a) mod p. Rows without an id stay."""
    h = F.crc32(F.col(doc_id).cast("string"))
    n, g = F.size("w").cast("long"), F.floor(h / 10).cast("long")
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    named = read.withColumn("chosen", F.coalesce(h % 10 == 0, F.lit(False)))
    split = named.withColumn("w", F.when(F.col("chosen"), F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))))
    turned = split.withColumn("g", F.when(n > 0, F.struct(a.alias("a"), p.cast("long").alias("p"))))
    place = lambda i: F.when(i < F.col("g.a"), i).otherwise(F.col("g.a") + F.pmod(i - F.col("g.a"), F.col("g.p")))
    words = F.transform("w", lambda _, i: F.get(F.col("w"), place(i.cast("long")).cast("int")))
    return turned.select("doc_id", F.when(F.col("g").isNotNull(), F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def digests(runs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run with the greatest length / period, and hex digests of the runs
    and of the collapsed text."""
    over = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    nothing = F.lit(None).cast("struct<start: long, length: long, period: long>")
    best = F.aggregate("runs", nothing, lambda b, r: F.when(over(b, r), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = runs.select("doc_id", "n_words", "runs", "collapsed", best.alias("best"))
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
