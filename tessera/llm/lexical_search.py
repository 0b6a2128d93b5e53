"""Ranked lexical search over K2-treaps of the term-document grid.

The grid has a row for each term that the items ask for and a column for each document; a
cell holds the term's impact in the document, ``(10^9 tf) div (1000 tf + 20 m)``. Columns
are dealt to shards of at most ``shard_docs`` documents, and each shard's grid becomes a
K2-treap: a quadtree that halves rows and columns, of which only cells that are not empty
exist. A node holds four bits (which quarters exist), the rank of its first child, and the
largest impact below it; children lie in row-column order, so a child's place is its
parent's rank and a count of bits.

An item's score of a document is the sum of weight times impact over its distinct terms. In
a shard, the paths of the item's rows descend jointly: a range of columns carries one node a
row, its bound is the sum of weight times node maximum, and the ranges of the best bounds
are halved first. A range is dropped only if its bound, or the bound and the smaller ids of
equal scores, cannot enter the item's best ``k`` of the shard; so the result is exact. The
shards' lists are merged by one window, which Spark cuts to ``k`` rows an item before the
exchange.

Work is spread without a shuffle of texts: one pass hashes whole texts and writes the terms
asked for with their counts, document counts come from it by aggregates, and each task then
builds and searches the shards of its own rows. A first search of one document in ``seeds``
(by a hash) gives each item a score that ``k`` documents reach; the others start from it.
Items are worked on in blocks of ``item_block``, of which only hashed terms go to the
tasks, so memory does not follow the number of items.

Defined cases: null texts and texts without a term count in nothing and match nothing;
items without a term get no rows; equal items rank each for themselves; repeated
documents are documents of their own; documents without an id count in the statistics and
rank with a null id, behind others of their score; empty tables give no rows. Only ids and
texts are read. Terms are named by 64-bit hashes.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, class_table, hashed_words, written

#: Letters, digits and every byte of a character beyond ASCII belong to terms.
_TERM = class_table(lambda b: b >= 0x80 or chr(b).isalnum())
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Ranges halved together.
BEST = 512
_ONES = np.array([bin(b).count("1") for b in range(16)], np.int64)


# -- K2-treap --------------------------------------------------------------------------


def _spread(v: np.ndarray) -> np.ndarray:
    """Bits of ``v`` (below 2^31) at the even places."""
    v = v.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = (v | (v << np.uint64(shift))) & np.uint64(mask)
    return v


class Treap:
    """Compressed quadtree over cells (row, column, impact); the last level's nodes are the
    cells. Nodes of all levels lie in one array, the root first."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, impact: np.ndarray):
        side = int(max(rows.max(), cols.max())) + 1 if len(rows) else 1
        self.depth = max(1, (side - 1).bit_length())
        code = (_spread(rows) << np.uint64(1)) | _spread(cols)
        order = np.argsort(code, kind="stable")
        code, top = code[order], impact[order].astype(np.int64)
        maxima, bits = [top], [np.zeros(len(top), np.uint8)]
        for _ in range(self.depth):
            quarter, code = (code & np.uint64(3)).astype(np.uint8), code >> np.uint64(2)
            head = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.empty(0, np.int64)
            if len(code):
                bits.append(np.bitwise_or.reduceat(np.left_shift(np.uint8(1), quarter), head))
                top = np.maximum.reduceat(top, head)
                code = code[head]
            else:
                bits.append(np.zeros(0, np.uint8))
            maxima.append(top)
        self.top = np.concatenate(maxima[::-1])
        self.bits = np.concatenate(bits[::-1])
        # Children follow in the order of their parents: the rank of set bits so far.
        self.first = 1 + np.cumsum(_ONES[self.bits]) - _ONES[self.bits]

    def child(self, node: np.ndarray, quarter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each node has the quarter, and where."""
        bits = self.bits[node].astype(np.int64)
        return (bits >> quarter) & 1 == 1, self.first[node] + _ONES[bits & ((1 << quarter) - 1)]


def best_columns(treap: Treap, rows: np.ndarray, weights: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
    """(score, column) of the ``k`` best columns for the rows, by score, then column; those
    under ``floor`` are not looked for. The columns' order is that of equal scores."""
    inside = rows < 1 << treap.depth
    rows, weights = rows[inside], weights[inside]
    if not len(rows) or not len(treap.top):
        return []
    found: list[tuple[int, int]] = []  # heap of (score, -column): the worst first
    # Pending ranges: bound, level, number of the range; and a (range, row) list of nodes.
    bound = np.array([int(weights.sum()) * int(treap.top[0])])
    level, col = np.zeros(1, np.int64), np.zeros(1, np.int64)
    sizes, which, node = np.array([len(rows)]), np.arange(len(rows)), np.zeros(len(rows), np.int64)
    while len(bound):
        worst = max(floor, found[0][0] if len(found) == k else 1)
        last = -found[0][1] if len(found) == k and found[0][0] == worst else np.inf
        keep = (bound > worst) | ((bound == worst) & (col << (treap.depth - level) < last))
        chosen = np.flatnonzero(keep)
        if len(chosen) > BEST:
            chosen = np.sort(chosen[np.argpartition(-bound[chosen], BEST)[:BEST]])
        now = np.zeros(len(bound), bool)
        now[chosen] = True
        pairs, later = np.repeat(now, sizes), np.repeat(keep & ~now, sizes)
        w, nd = which[pairs], node[pairs]
        lv, at = np.repeat(level[now], sizes[now]), np.repeat(np.arange(len(chosen)), sizes[now])
        new = []
        for half in (0, 1):
            shift = treap.depth - 1 - lv
            there, place = treap.child(nd, 2 * ((rows[w] >> shift) & 1) + half)
            r, x, y = at[there], w[there], place[there]
            if not len(r):
                continue
            head = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
            total = np.add.reduceat(weights[x] * treap.top[y], head)
            owner = r[head]
            new.append((total, level[now][owner] + 1, 2 * col[now][owner] + half, np.diff(np.append(head, len(r))), x, y))
        rest = keep & ~now
        parts = [(bound[rest], level[rest], col[rest], sizes[rest], which[later], node[later]), *new]
        bound, level, col, sizes, which, node = (np.concatenate(p) for p in zip(*parts))
        done = level == treap.depth
        if done.any():
            good = done & (bound >= worst)
            for score, c in zip(bound[good].tolist(), col[good].tolist()):
                if len(found) < k:
                    heapq.heappush(found, (score, -c))
                elif (score, -c) > found[0]:
                    heapq.heapreplace(found, (score, -c))
            stay = np.repeat(~done, sizes)
            which, node = which[stay], node[stay]
            bound, level, col, sizes = bound[~done], level[~done], col[~done], sizes[~done]
    return [(s, -c) for s, c in sorted(found, reverse=True) if s > 0]


# -- Spark -----------------------------------------------------------------------------


def _terms_of(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    return hashed_words([t.translate(_LOWER) for t in texts], _TERM)


def item_terms(items: DataFrame, text: str, item_id: str) -> DataFrame:
    """item_id, number (unique a row) and the sorted distinct term hashes of each item that has any."""
    kind = items.schema[item_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pc.cast(b.column(1), pa.binary()).to_pylist()
            lists: list[np.ndarray] = [np.empty(0, np.uint64)] * len(texts)
            for i, h in _terms_of(texts):
                lists[i] = np.unique(h)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([t.view(np.int64) for t in lists], pa.list_(pa.int64()))], ["item_id", "terms"])

    read = items.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return read.mapInArrow(work, f"item_id {kind}, terms array<long>").where(F.size("terms") > 0)


def postings(docs: DataFrame, wanted: np.ndarray, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n (terms with repeats), rows and counts of the terms in the sorted array
    ``wanted``, of every document with a term."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pc.cast(b.column(1), pa.binary()).to_pylist()
            n = np.zeros(len(texts), np.int64)
            rows: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
            counts = list(rows)
            for i, h in _terms_of(texts):
                n[i] = len(h)
                at = np.searchsorted(wanted, h)
                at = at[wanted[np.minimum(at, len(wanted) - 1)] == h] if len(wanted) else at[:0]
                r, c = np.unique(at, return_counts=True)
                rows[i], counts[i] = r.astype(np.int32), c.astype(np.int64)
            out = pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(rows, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))], ["doc_id", "n", "rows", "counts"])
            yield out.filter(pa.array(n > 0))

    read = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return read.mapInArrow(work, f"doc_id {kind}, n long, rows array<int>, counts array<long>")


def _searched(found: DataFrame, items: list[tuple[int, np.ndarray]], weights: np.ndarray, floors: np.ndarray, n_docs: int, n_terms: int, k: int, shard_docs: int) -> DataFrame:
    """number, doc_id and score of the best of each shard."""
    kind = found.schema["doc_id"].dataType.simpleString()

    def search(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        table = table.take(pc.sort_indices(table, [("doc_id", "ascending")], null_placement="at_end")).combine_chunks()
        n = table["n"].to_numpy()
        lists, counts = table["rows"].combine_chunks(), table["counts"].combine_chunks().flatten().to_numpy()
        rows = lists.flatten().to_numpy()
        cols = np.repeat(np.arange(len(n)), np.diff(lists.offsets.to_numpy()))
        m = 100 - 50 + (50 * n * n_docs) // n_terms
        treap = Treap(rows, cols, (1_000_000_000 * counts) // (1000 * counts + 20 * m[cols]))
        numbers, places, scores = [], [], []
        for (number, asked), floor in zip(items, floors.tolist()):
            for score, col in best_columns(treap, asked, weights[asked], k, floor):
                numbers.append(number)
                places.append(col)
                scores.append(score)
        ids = table["doc_id"].combine_chunks().take(pa.array(places, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), ids, pa.array(scores, pa.int64())], ["number", "doc_id", "score"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            at = 0
            while at < b.num_rows:
                part = b.slice(at, shard_docs - size)
                held.append(part)
                size, at = size + part.num_rows, at + part.num_rows
                if size == shard_docs:
                    yield from search(held)
                    held, size = [], 0
        if size:
            yield from search(held)

    return found.mapInArrow(work, f"number int, doc_id {kind}, score long")


def _ranked(lists: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 50, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str | None = None, shard_docs: int = 4096, seeds: int = 16, item_block: int = 1024) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``k`` best documents of positive score,
    equal scores by id."""
    spark = docs.sparkSession
    bounded_batches(spark)
    asked = written(item_terms(items, item_text or text, item_id), "search-items")
    doc_kind, item_kind = docs.schema[doc_id].dataType.simpleString(), asked.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {doc_kind}, score long")
    rows = asked.toLocalIterator()
    while block := [r for _, r in zip(range(item_block), rows)]:
        wanted = np.unique(np.array([t for r in block for t in r.terms], np.int64).view(np.uint64))
        found = written(postings(docs, wanted, text, doc_id), "search-postings")
        n_docs, n_terms = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = found.select(F.explode("rows").alias("row")).groupBy("row").count().collect()  # a row a term of the block
        weights = np.zeros(len(wanted), np.int64)
        for r in held:
            weights[r["row"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
        terms = [(i, np.searchsorted(wanted, np.array(r.terms, np.int64).view(np.uint64))) for i, r in enumerate(block)]
        matched = found.where(F.size("rows") > 0)
        seed = F.pmod(F.xxhash64("doc_id", "n"), F.lit(seeds)) == 0
        none = np.zeros(len(block), np.int64)
        fixed = (int(n_docs), int(n_terms), k, shard_docs)
        first = written(_ranked(_searched(matched.where(seed), terms, weights, none, *fixed), k).select("number", "doc_id", "score"), "search-seeds")
        floors = none.copy()
        for number, score in first.groupBy("number").agg(F.count("*").alias("n"), F.min("score").alias("s")).where(F.col("n") == k).select("number", "s").collect():
            floors[number] = score
        others = _searched(matched.where(~seed), terms, weights, floors, *fixed)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(block)], f"number int, item_id {item_kind}")
        best = written(_ranked(first.unionByName(others), k), "search-best")
        out = out.unionByName(best.join(names, "number").select("item_id", "rank", "doc_id", "score"))
    return out
