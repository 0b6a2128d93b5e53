"""Exact metrics and summaries, all distributed.

* AUC is computed on the table of distinct scores (positives/negatives per score)
  with a distributed running sum of negatives; no row-level sort in one task.
* Exact quantiles use prefix counts over distinct values, then a join with the few
  wanted ranks; no percentile buffer holding every value of the column.
* Histograms and density grids are grouped counts; the smoothing kernel is a fixed
  list of (2r+1)^2 offsets exploded per cell, so its cost is cells x kernel, not rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.cumulative import running_sums
from tessera.session import written

DEFAULT_BINS = 10
QUARTILES = (0.25, 0.5, 0.75)


# ------------------------------------------------------------------ A18 / E8
def auc_exact(df: DataFrame, label_col: str, score_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """ROC AUC with ties counted half: one row ``auc, n_pos, n_neg`` (one a group, behind the
    group's columns, all from one running sum).

    ``sum over scores s of pos(s) * (neg(< s) + neg(s)/2) / (P * N)``; NULL when one
    class is missing. Rows without a score or a label take no part.
    """
    groups = list(group_cols)
    df = df.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
    per_score = df.groupBy(*groups, F.col(score_col).alias("s")).agg(
        F.sum((F.col(label_col) == 1).cast("bigint")).alias("pos"),
        F.sum((F.col(label_col) != 1).cast("bigint")).alias("neg"),
    )
    cum = running_sums(per_score, ["s"], {"cum_neg": F.col("neg")}, group_cols=groups)
    terms = cum.select(*groups, (F.col("pos").cast("double") * ((F.col("cum_neg") - F.col("neg")) + F.col("neg") / 2.0)).alias("t"), "pos", "neg")
    tot = terms.groupBy(*groups).agg(F.sum("t").alias("t"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return tot.select(
        *groups,
        F.try_divide(F.col("t"), F.col("n_pos").cast("double") * F.col("n_neg").cast("double")).alias("auc"),
        "n_pos",
        "n_neg",
    )


def accuracy(df: DataFrame, pred_col: str, label_col: str) -> DataFrame:
    """Share of rows where prediction equals label."""
    return df.agg(F.avg((F.col(pred_col) == F.col(label_col)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ quantiles / A14
def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """Linear-interpolation quantiles (pandas/NumPy default), one row per probability.

    Distinct values get prefix counts (distributed), each wanted rank ``h = p (n-1)``
    is matched to the value covering ``floor(h)`` and ``ceil(h)``.
    """
    valid = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col)))
    counts = valid.groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    cum = running_sums(counts, ["v"], {"cum": F.col("c")})
    n = valid.agg(F.count(F.lit(1)).alias("n"))  # partial counts, no grouping shuffle
    ranks = n.select(F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"), "n").select(
        "p",
        (F.col("p") * (F.col("n") - 1)).alias("h"),
        F.floor(F.col("p") * (F.col("n") - 1)).cast("bigint").alias("lo"),
        F.ceil(F.col("p") * (F.col("n") - 1)).cast("bigint").alias("hi"),
    )
    ends = ranks.select("p", "h", F.explode(F.array(F.struct(F.lit("lo").alias("side"), F.col("lo").alias("r")), F.struct(F.lit("hi").alias("side"), F.col("hi").alias("r")))).alias("e"))
    ends = ends.select("p", "h", "e.side", "e.r")
    # The ranks table has 2 rows per probability: a fixed, tiny broadcast side.
    hit = cum.join(F.broadcast(ends), (F.col("r") >= F.col("cum") - F.col("c")) & (F.col("r") < F.col("cum")))
    piv = hit.groupBy("p", "h").agg(
        F.max(F.when(F.col("side") == "lo", F.col("v"))).alias("v_lo"),
        F.max(F.when(F.col("side") == "hi", F.col("v"))).alias("v_hi"),
    )
    return piv.select("p", (F.col("v_lo") + (F.col("h") - F.floor("h")) * (F.col("v_hi") - F.col("v_lo"))).alias("q"))


def _nan_as_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing readings are skipped, whether they come as NULL or as NaN."""
    floats = [c for c, t in df.dtypes if c in set(cols) and t in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def describe(df: DataFrame, col: str, exact: bool = True) -> DataFrame:
    """A14 + A13: count, mean, sample std, min, quartiles, max, and ``0.5 - mean``.

    ``exact=False`` uses ``percentile_approx`` (one pass, bounded memory) instead of
    the exact distributed quantiles.
    """
    df = _nan_as_null(df, [col])
    x = F.col(col)
    base = df.agg(
        F.count(x).alias("count"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    )
    if exact:
        q = exact_quantiles(df, col, QUARTILES)
        qrow = q.agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(f"q{int(p * 100)}") for p in QUARTILES])
    else:
        qrow = df.agg(*[F.percentile_approx(x, p).cast("double").alias(f"q{int(p * 100)}") for p in QUARTILES])
    out = base.crossJoin(qrow)
    return out.select("count", "mean", "std", "min", "q25", "q50", "q75", "max", (F.lit(0.5) - F.col("mean")).alias("delta"))


# ------------------------------------------------------------------ A15
def histogram(df: DataFrame, cols: Sequence[str], bins: int = DEFAULT_BINS) -> DataFrame:
    """Equal-width bins per column between its min and max (max falls in the last bin).

    Output ``column, bin, lo, hi, count`` with empty bins present (count 0). A constant
    column puts every row in bin 0.
    """
    df = _nan_as_null(df, cols)
    ranges = df.agg(*[F.min(c).alias(f"mn_{i}") for i, c in enumerate(cols)], *[F.max(c).alias(f"mx_{i}") for i, c in enumerate(cols)])
    long_rng = ranges.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"mn_{i}").cast("double").alias("mn"), F.col(f"mx_{i}").cast("double").alias("mx")) for i, c in enumerate(cols)])).alias("r")
    ).select("r.column", "r.mn", "r.mx")
    long_rng = written(long_rng, "histogram-ranges")  # read twice below
    values = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])).alias("e")).select("e.column", "e.x")
    values = values.where(F.col("x").isNotNull())
    # One row per column: a bounded broadcast side.
    j = values.join(F.broadcast(long_rng), "column")
    width = (F.col("mx") - F.col("mn")) / F.lit(float(bins))
    b = F.coalesce(F.least(F.floor(F.try_divide(F.col("x") - F.col("mn"), width)), F.lit(bins - 1)), F.lit(0)).cast("int")
    counts = j.groupBy("column", b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = long_rng.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    w = (F.col("mx") - F.col("mn")) / F.lit(float(bins))
    # At most columns x bins rows.
    out = grid.join(F.broadcast(counts), ["column", "bin"], "left").select(
        "column",
        "bin",
        (F.col("mn") + F.col("bin") * w).alias("lo"),
        (F.col("mn") + (F.col("bin") + 1) * w).alias("hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )
    return out


# ------------------------------------------------------------------ A16
def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation per unordered pair in one aggregate; long ``col_a, col_b, r``.

    Pairs with a NULL in either column are skipped pairwise (as pandas does).
    """
    pairs = list(combinations(cols, 2))
    row = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(
        F.explode(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)])).alias("e")
    ).select("e.col_a", "e.col_b", "e.r")


# ------------------------------------------------------------------ A22
def dimension_stats(df: DataFrame, vec_col: str) -> DataFrame:
    """Mean and population std per position of an array column (``pos, mean, std``), in one
    mergeable buffer a task: ``Summarizer`` sums, for each vector, which positions it has, how
    far they are from a pilot value and the squares of that. Vectors may be NULL, differ in
    length or hold NULLs; a position without any value has neither mean nor std."""
    vec = F.col(vec_col)
    dim = df.agg(F.max(F.size(vec))).first()[0] or 0
    if dim <= 0:
        return df.sparkSession.createDataFrame([], "pos int, mean double, std double")
    first = df.where(F.size(vec) == dim).select(vec).first()[0]  # one row: a pilot near the data keeps the squares small
    pilot = F.array(*[F.lit(float(x) if x is not None and math.isfinite(x) else 0.0) for x in first])
    place = F.sequence(F.lit(0), F.lit(dim - 1))
    off = F.transform(place, lambda i: F.get(vec, i).cast("double") - F.get(F.col("_pilot"), i))
    held = df.where(vec.isNotNull()).withColumn("_pilot", pilot).select(off.alias("off"))
    parts = F.concat(
        F.transform("off", lambda x: x.isNotNull().cast("double")),
        F.transform("off", lambda x: F.coalesce(x, F.lit(0.0))),
        F.transform("off", lambda x: F.coalesce(x * x, F.lit(0.0))),
    )
    total = held.select(Summarizer.metrics("sum").summary(array_to_vector(parts)).alias("s")).select(vector_to_array("s.sum").alias("t"))
    rows = total.withColumn("_pilot", pilot).select("t", "_pilot", F.explode(place).alias("pos"))  # one row a position
    n, x, xx = (F.get("t", F.col("pos") + F.lit(k * dim)) for k in range(3))
    mean = F.try_divide(x, n)
    spread = F.try_divide(xx, n) - mean * mean
    return rows.select("pos", (F.get("_pilot", F.col("pos")) + mean).alias("mean"), F.sqrt(F.when(spread < 0, F.lit(0.0)).otherwise(spread)).alias("std"))


def normalise(df: DataFrame, vec_col: str, stats: DataFrame, out_col: str = "normalised") -> DataFrame:
    """``(x - mean) / std`` per position; the stats (one row per position) are bounded by
    the vector length and are attached as two arrays in one broadcast row."""
    arr = stats.agg(
        F.sort_array(F.collect_list(F.struct("pos", "mean", "std"))).alias("s")
    )
    j = df.crossJoin(F.broadcast(arr))
    z = F.transform(
        F.col(vec_col),
        lambda x, i: F.try_divide(x - F.get(F.col("s"), i)["mean"], F.get(F.col("s"), i)["std"]),
    )
    return j.withColumn(out_col, z).drop("s")


# ------------------------------------------------------------------ E15
def density_grid(df: DataFrame, x: str, y: str, wx: float, wy: float) -> DataFrame:
    """Counts per grid cell ``(gx, gy)`` of size ``wx`` x ``wy``."""
    return (
        df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(F.floor(F.col(x) / wx).alias("gx"), F.floor(F.col(y) / wy).alias("gy"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def density_smooth(grid: DataFrame, radius: int = 2, sigma: float = 1.0) -> DataFrame:
    """Gaussian-smoothed density on the cells: each cell spreads its count to cells
    within ``radius`` with weight ``exp(-d^2 / (2 sigma^2))``, normalised to sum to 1.

    Cost is cells x (2r+1)^2, independent of the row count.
    """
    offsets = [
        F.struct(F.lit(dx).cast("bigint").alias("dx"), F.lit(dy).cast("bigint").alias("dy"))
        for dx in range(-radius, radius + 1)
        for dy in range(-radius, radius + 1)
    ]
    grid = written(grid, "density-grid")  # cells, not rows; read for the total as well
    k = grid.select("gx", "gy", "n", F.explode(F.array(*offsets)).alias("o"))
    w = F.exp(-(F.col("o.dx") * F.col("o.dx") + F.col("o.dy") * F.col("o.dy")) / F.lit(2.0 * sigma * sigma))
    spread = k.select(
        (F.col("gx") + F.col("o.dx")).alias("gx"), (F.col("gy") + F.col("o.dy")).alias("gy"), (F.col("n") * w).alias("m")
    )
    dens = spread.groupBy("gx", "gy").agg(F.sum("m").alias("m"))
    # Every cell spreads the same kernel, so the mass is the count times the kernel's sum.
    kernel = sum(math.exp(-(dx * dx + dy * dy) / (2.0 * sigma * sigma)) for dx in range(-radius, radius + 1) for dy in range(-radius, radius + 1))
    total = grid.agg(F.sum("n") * F.lit(kernel)).scalar()
    return dens.select("gx", "gy", (F.col("m") / total).alias("density"))
