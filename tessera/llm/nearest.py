"""Approximate nearest neighbours by low-dimensional stable projections and kd-trees.

Largest inner product becomes smallest distance by one more component, sqrt(M^2 - |x|^2)
with M the largest norm (queries get 0 there). Vectors are projected with a Gaussian
(2-stable) matrix to ``DIMS`` numbers; a projected squared distance over the true one is
chi-square with DIMS degrees of freedom. Neighbours are visited by growing projected
distance and verified on the original vectors; the search ends when the projected distance
exceeds what a neighbour better than the current k-th would show with probability ``p``.

The top of the kd-tree is fitted on a bounded sample (``SAMPLE`` rows) and deals all rows
into cells, each known by the box around its points; crowded cells are cut further by id.
Every query searches its home cell, then with the k-th distance from there the nearest
``NEAR_CELLS`` of the cells whose box passes the chi-square test, then with the better k-th
distance what cells still pass. In a cell, a local kd-tree gives leaves by growing box
distance, their points queue by projected distance, and the first of the queue is verified
as long as it passes the test. A unit of work is a part of a cell against at most
``QUERIES`` queries. ``report`` gives the shares of cells, leaves and points visited.

How much the test leaves out depends on the data. Boxes tell clusters apart; in data without
any structure, where the k-th neighbour is two thirds as far as the average point, every box
passes and only the test of single points stops the search.

Equal vectors are one point with its ``k`` + 1 smallest ids, which is all that ties by id
can need, and equal queries are searched once, for ``k`` + 1 neighbours: each asking id then
leaves itself out. So a group of copies meets in a pre-combined aggregate and never as
pairs. Scores are correctly rounded sums of double products.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no
part, nor those of another length than the most common one, nor rows with a null id; rows
with one id are one candidate with its best score, and never their own neighbour (if they
ask with several vectors, the best of their searches counts); with fewer than ``k`` candidates all are returned; ties go to the smaller id; an empty table
gives no rows. Only id and vector are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import unit_hash, written

DIMS = 32
SAMPLE = 20_000
CELL_ROWS = 4096
NEAR_CELLS = 3
MAX_CELLS = 1 << 16
QUERIES = 2048
LEAF = 64
CONFIDENCE = 0.9
#: Leaves opened and points verified at a time.
OPEN, VERIFY = 8, 128
_SCORED = "digest binary, vec_id long, score double, leaves long, points long"


def chi_square_bound(dims: int, p: float) -> float:
    """Quantile of the chi-square distribution (Wilson and Hilferty's cube)."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf(p)
    return dims * (1 - 2 / (9 * dims) + z * math.sqrt(2 / (9 * dims))) ** 3


def split_tree(points: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Dimensions and cut values of a complete kd-tree, level by level."""
    groups, levels = [points], []
    for _ in range(depth):
        dims, cuts, below = [], [], []
        for g in groups:
            d = int(np.argmax(g.max(0) - g.min(0))) if len(g) else 0
            c = float(np.median(g[:, d])) if len(g) else 0.0
            dims.append(d)
            cuts.append(c)
            right = g[:, d] > c
            below += [g[~right], g[right]]
        levels.append((np.array(dims), np.array(cuts)))
        groups = below
    return levels


def cell_of(points: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    cell = np.zeros(len(points), np.int64)
    rows = np.arange(len(points))
    for dims, cuts in levels:
        cell = 2 * cell + (points[rows, dims[cell]] > cuts[cell])
    return cell


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point to boxes."""
    gap = np.maximum(np.maximum(low - q, q - high), 0)
    return (gap * gap).sum(-1)


class LocalTree:
    """kd-tree leaves over distinct vectors, each with its ids in ascending order."""

    def __init__(self, ids: list[np.ndarray], x: np.ndarray, matrix: np.ndarray, top: float):
        order = np.argsort([i[0] for i in ids], kind="stable")
        self.ids, self.x = [ids[j] for j in order], np.ascontiguousarray(x[order])
        self.p = p = project(self.x, matrix, top)
        self.leaves: list[np.ndarray] = []
        todo = [np.arange(len(x))]
        while todo:
            g = todo.pop()
            if len(g) <= LEAF:
                self.leaves.append(g)
                continue
            d = int(np.argmax(p[g].max(0) - p[g].min(0)))
            g = g[np.argsort(p[g, d], kind="stable")]
            todo += [g[: len(g) // 2], g[len(g) // 2 :]]
        self.low = np.stack([p[g].min(0) for g in self.leaves])
        self.high = np.stack([p[g].max(0) for g in self.leaves])

    def search(self, q: np.ndarray, projected: np.ndarray, base: float, worst: float, most: int, bound: float) -> tuple[list[tuple[int, float]], int, int]:
        """Best ``most`` (id, score) of this part, leaves opened and points verified; ``base``
        - 2 score is the squared distance and ``worst`` the last wanted one known so far."""
        away = box_distance(projected, self.low, self.high)
        order = np.argsort(away, kind="stable")
        away = np.append(away[order], np.inf)
        opened, found, scores, best = 0, [], [], np.empty(0)
        queue, far = np.empty(0, np.int64), np.empty(0)  # points of open leaves by projected distance
        while True:
            ready = int(np.searchsorted(far, min(away[opened], bound * worst), "right"))
            if not ready:
                if opened == len(order) or away[opened] > bound * worst:
                    break
                g = np.concatenate([self.leaves[j] for j in order[opened : opened + OPEN]])
                gap = self.p[g] - projected
                queue, far = np.concatenate([queue, g]), np.concatenate([far, np.einsum("ij,ij->i", gap, gap)])
                by = np.argsort(far, kind="stable")
                queue, far, opened = queue[by], far[by], min(opened + OPEN, len(order))
                continue
            g, queue, far = queue[: min(ready, VERIFY)], queue[min(ready, VERIFY) :], far[min(ready, VERIFY) :]
            s = self.x[g] @ q
            found.append(g)
            scores.append(s)
            best = np.sort(np.concatenate([best, s]))[::-1][:most]
            if len(best) == most:
                worst = min(worst, max(base - 2 * best[-1], 0.0))
        if not found:
            return [], opened, 0
        g, s = np.concatenate(found), np.concatenate(scores)
        verified = len(g)
        if len(s) > most:
            keep = s >= np.partition(s, -most)[-most] - 1e-9 * max(1.0, abs(base))
            g = g[keep]
        out = []
        for j in g:
            score = math.fsum((self.x[j] * q).tolist())
            out += [(-score, int(i)) for i in self.ids[j]]
        once: dict[int, float] = {}
        for s, i in sorted(out):
            once.setdefault(i, -s)
        return list(once.items())[:most], opened, verified


def project(x: np.ndarray, matrix: np.ndarray, top: float) -> np.ndarray:
    """Projections of vectors with the component that evens their norms."""
    rest = np.sqrt(np.maximum(top - np.einsum("ij,ij->i", x, x), 0.0))
    return x @ matrix[:-1] + rest[:, None] * matrix[-1]


def _vectors(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _leaves(points):
    """Leaves of a local tree of that many points: halves until at most LEAF are left."""
    halvings = F.greatest(F.lit(0), F.ceil(F.log2(points / F.lit(LEAF))))
    return F.pow(F.lit(2.0), halvings)


def nearest(vectors: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", confidence: float = CONFIDENCE, seed: int = 5, cell_rows: int = CELL_ROWS, report: dict | None = None) -> DataFrame:
    """query_id, rank, vec_id and score for the rows where ``is_query`` (a column) holds; the
    shares of cells, leaves and points visited go into ``report`` if it is given."""
    spark = vectors.sparkSession
    numbers = F.transform(F.col(vector), lambda v: v.cast("double"))
    usable = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))) & F.exists("v", lambda e: e != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), numbers.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(usable)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = lengths["d"]
    squared = F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e)
    rows = rows.where(F.size("v") == dim)
    n, top = rows.agg(F.count("*"), F.max(squared)).first()
    matrix = np.random.default_rng(seed).standard_normal((dim + 1, DIMS))
    depth = max(0, min(int(math.log2(MAX_CELLS)), math.ceil(math.log2(max(n, 1) / cell_rows)) if n > cell_rows else 0))
    picked = rows.where(unit_hash(F.col("id"), seed=31) < SAMPLE / n).select("v").toPandas()["v"]
    sample = np.stack([np.asarray(v, np.float64) for v in picked]) if len(picked) else np.zeros((1, dim))
    levels = split_tree(project(sample, matrix, top), depth)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, dim) + 0.0  # -0.0 becomes 0.0
            home = cell_of(project(x, matrix, top), levels)
            # A query's norm-evening component is 0.
            asks = cell_of(x @ matrix[:-1], levels)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x], pa.binary()), b.column(2), pa.array(home), pa.array(asks)], ["id", "x", "asks", "cell", "ask_cell"])

    placed = rows.mapInArrow(place, "id long, x binary, asks boolean, cell long, ask_cell long").withColumn("digest", F.unhex(F.md5("x")))
    placed = written(placed, "nearest-cells")
    bound, counting = chi_square_bound(DIMS, confidence), report is not None
    most = k + 1  # an asking id is among the neighbours of its own vector
    ids = placed.select("digest", "id").distinct()
    order = F.row_number().over(Window.partitionBy("digest").orderBy("id"))
    ids = ids.withColumn("at", order).where(F.col("at") <= most).groupBy("digest").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    distinct = placed.groupBy("digest").agg(F.first("x").alias("x"), F.first("cell").alias("cell"), F.first("ask_cell").alias("ask_cell"), F.max("asks").alias("asks"))
    points = written(distinct.join(ids, "digest"), "nearest-points")
    # One row a cell: how many parts it is cut into.
    parts = points.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(2 * cell_rows)).cast("int").alias("parts"))

    def search(visits: DataFrame) -> DataFrame:
        """Best neighbours of visits (digest, q, worst, cell) in those cells."""
        chunks = visits.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(QUERIES)).cast("int").alias("chunks"))
        plan = parts.join(chunks, "cell")
        data = points.join(plan, "cell").select(
            "ids", "x", "cell", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
        )
        asks = visits.join(plan, "cell").select(
            "digest", "q", "worst", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("digest"), F.col("chunks")).cast("int").alias("chunk")
        )

        def unit(near: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
            out: list[tuple[bytes, int | None, float | None, int, int]] = []
            if len(near) and len(queries):
                tree = LocalTree(list(near["ids"]), _vectors(near["x"]), matrix, top)
                for name, q, worst in zip(queries["digest"], _vectors(queries["q"]), queries["worst"]):
                    base = top + float(q @ q)
                    near_ids, leaves, points = tree.search(q, q @ matrix[:-1], base, worst, most, bound)
                    out += [(name, i, s, 0, 0) for i, s in near_ids]
                    if counting:
                        out.append((name, None, None, leaves, points))
            return pd.DataFrame(out, columns=["digest", "vec_id", "score", "leaves", "points"]).astype({"vec_id": "Int64", "score": "float64", "leaves": "int64", "points": "int64"})

        key = ["cell", "part", "chunk"]
        return data.groupBy(*key).cogroup(asks.groupBy(*key)).applyInPandas(unit, _SCORED)

    def best(scored: DataFrame, key: str, limit: int) -> DataFrame:
        once = scored.where(F.col("vec_id").isNotNull()).groupBy(key, "vec_id").agg(F.max("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "vec_id"))
        return once.withColumn("rank", rank).where(F.col("rank") <= limit)

    asked = points.where("asks").select("digest", F.col("x").alias("q"), F.col("ask_cell").alias("home"))
    infinite = F.lit(float("inf"))
    at_home = written(search(asked.select("digest", "q", infinite.alias("worst"), F.col("home").alias("cell"))), "nearest-home")

    def corners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Boxes of the cells that a task has seen points of."""
        boxes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            if not b.num_rows:
                continue
            cells, p = b.column(0).to_numpy(), project(_vectors(b.column(1).to_pylist()), matrix, top)
            for c in np.unique(cells):
                own = p[cells == c]
                low, high = boxes.get(int(c), (own[0], own[0]))
                boxes[int(c)] = np.minimum(low, own.min(0)), np.maximum(high, own.max(0))
        for c, (low, high) in boxes.items():
            yield pa.RecordBatch.from_pydict({"cell": [c], "low": [low.tolist()], "high": [high.tolist()]})

    sides = [F.array(*[f(F.get(side, F.lit(j))) for j in range(DIMS)]).alias(side) for side, f in (("low", F.min), ("high", F.max))]
    drawn = points.select("cell", "x").mapInArrow(corners, "cell long, low array<double>, high array<double>").groupBy("cell").agg(*sides)
    boxes = drawn.orderBy("cell").collect()  # a row a cell, MAX_CELLS at most
    cells = np.array([r["cell"] for r in boxes], np.int64)
    low, high = (np.array([r[side] for r in boxes]).reshape(-1, DIMS) for side in ("low", "high"))

    def spread_to(first: int, last: int | None):
        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Cells of each query that pass the test, but its home, from place ``first`` to ``last``
            by box distance."""
            for b in batches:
                names, qs, homes, lasts, olds = (b.column(i).to_pylist() for i in range(5))
                for name, raw, home, score, old in zip(names, qs, homes, lasts, olds):
                    q = np.frombuffer(raw, np.float64)
                    limits = [math.inf if s is None else max(top + float(q @ q) - 2 * s, 0.0) for s in (old, score)]
                    away = box_distance(q @ matrix[:-1], low, high)
                    order = np.argsort(away, kind="stable")
                    # The places are those under the k-th distance that the first look knew.
                    order = order[(cells[order] != home) & (away[order] <= bound * limits[0])][first:last]
                    order = order[away[order] <= bound * limits[1]]
                    reach, n = cells[order], len(order)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.binary()), pa.array([raw] * n, pa.binary()), pa.array([limits[1]] * n, pa.float64()), pa.array(reach, pa.int64())], ["digest", "q", "worst", "cell"])

        return spread

    def kth(scored: DataFrame, name: str) -> DataFrame:
        return best(scored, "digest", most).where(F.col("rank") == most).select("digest", F.col("score").alias(name))

    schema = "digest binary, q binary, worst double, cell long"
    known = asked.join(kth(at_home, "old"), "digest", "left")
    near = written(known.select("digest", "q", "home", F.col("old").alias("last"), "old").mapInArrow(spread_to(0, NEAR_CELLS), schema), "nearest-visits")
    scored = written(search(near), "nearest-near")
    better = known.join(kth(at_home.union(scored), "last"), "digest", "left").select("digest", "q", "home", "last", "old")
    far = written(better.mapInArrow(spread_to(NEAR_CELLS, None), schema), "nearest-visits")
    rest = search(far)
    if counting:
        rest = written(rest, "nearest-rest")
    found = best(at_home.union(scored).union(rest), "digest", most)
    if counting:
        queries, seen = asked.count(), at_home.union(scored).union(rest).agg(F.sum("leaves"), F.sum("points")).first()
        total = points.count()
        leaves = points.join(parts, "cell").groupBy("cell", F.pmod(F.xxhash64("digest"), F.col("parts")).alias("part")).count().select(F.sum(_leaves(F.col("count")))).first()[0]
        report.update(cells=(queries + near.count() + far.count()) / max(1, queries * len(cells)), leaves=seen[0] / max(1, queries * leaves), points=seen[1] / max(1, queries * total))
    lists = found.groupBy("digest").agg(F.collect_list(F.struct("vec_id", "score")).alias("near"))  # at most k + 1
    asking = placed.where("asks").select(F.col("id").alias("query_id"), "digest").distinct()
    own = asking.join(lists, "digest").select("query_id", F.inline("near")).where("vec_id != query_id")
    return best(own, "query_id", k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
