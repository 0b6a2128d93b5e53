"""Mixing sources to target weights by Poisson replication.

Each source's rate is the mean number of copies of its documents that brings the source
to its target share of ``epochs`` times the input's size: rate = epochs * total * weight /
size. A document's count is the inverse of the Poisson distribution with that mean at a
uniform number made from a hash of the document's id; it is exploded by that count, and
the copies are dealt out and sorted by another hash, a global shuffle. The table of
cumulative probabilities covers the counts within 12 standard deviations of the mean. A mean
above ``MAX_RATE`` is split into equal parts, each drawn by a hash of its own: a sum of
independent Poisson counts is one of the summed mean, so no rate is too large.

Everything on the path is DataFrame functions. Source sizes are one pre-combined
aggregate, so a source with a third of the rows costs one row a task; the table of
cumulative probabilities has one row a source and is joined without a hint. It is written
before, so that Spark plans the join by its measured bytes: texts travel by source only
where the table is too large to be sent to the tasks. Else the one exchange of texts goes
by a hash of the copy.

Defined cases: a null source is a source of its own; null texts and sizes count 0; a
source whose size is 0 has rate ``epochs``; sources without a target weight take weight 0
where weights are given; rows of one id get equal counts, repeated ones too; rows without an
id draw each for itself, by their place in the input (partition and row number, which a task
that is run again gives the same again), equal rows as well. All input columns are kept; the added ones take a variant
of their name if the input has it. The copy's number is an int.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from tessera.llm.common import fresh, written

#: Largest mean of one draw, whose table has about 24 * sqrt(mean) rows.
MAX_RATE = 1e6
#: Up to this mean the table starts at 0, where exp(-mean) is far from underflow.
FROM_ZERO = 500.0
#: Without given weights a source's weight is its size to this power, scaled to sum to 1.
TEMPERATURE = 0.5


def uniform(key: Column, seed: str | Column) -> Column:
    """Double in [0, 1): the first 13 hex digits of md5(seed, key) over 2**52."""
    hexed = F.substring(F.md5(F.concat(F.lit(seed), F.lit(":"), key.cast("string"))), 1, 13)
    return F.conv(hexed, 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, size: Column, source: str = "source", weights: dict[str | None, float] | None = None, epochs: float = 1.0) -> DataFrame:
    """(source, n_docs, size, weight, rate), one row a source."""
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n_docs"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("size"))
    if weights is None:
        raw = F.pow(F.col("size").cast("double"), F.lit(TEMPERATURE))
    else:
        raw = F.lit(0.0)
        for k, v in weights.items():
            raw = F.when(F.col("source").eqNullSafe(F.lit(k)), F.lit(float(v))).otherwise(raw)
    sized = sizes.withColumn("raw", raw)
    # One row of totals: a scalar subquery, not a join.
    totals = sized.agg(F.sum("size").cast("double").alias("size"), F.sum(F.when(F.col("size") > 0, F.col("raw"))).alias("raw"))
    total = totals.select("size").scalar()
    total_raw = totals.select("raw").scalar()
    weight = F.when((F.col("size") > 0) & (total_raw > 0), F.col("raw") / total_raw).otherwise(F.lit(0.0))
    rate = F.when(F.col("size") > 0, F.lit(float(epochs)) * total * F.col("weight") / F.col("size")).otherwise(F.lit(float(epochs)))
    rated = sized.withColumn("weight", weight).withColumn("rate", rate)
    return rated.select("source", "n_docs", "size", "weight", "rate")


def with_cdf(rated: DataFrame, most: float = MAX_RATE) -> DataFrame:
    """Adds ``parts``, the number of draws; ``mean`` of each; and ``cdf``: P(count <= k) of
    one draw for k = ``first``, first + 1, ... until beyond every uniform number."""
    rated = rated.withColumn("parts", F.greatest(F.ceil(F.col("rate") / most), F.lit(1)).cast("int")).withColumn("mean", F.col("rate") / F.col("parts"))
    mean, first = F.col("mean"), F.col("first")
    width = 12 * F.sqrt(mean) + 40
    rated = rated.withColumn("first", F.when(mean <= FROM_ZERO, 0).otherwise(F.floor(mean - width)).cast("int"))
    # ln P(count = first) by Stirling's series, in differences that stay small.
    gap = mean - first
    stirling = F.log(2 * math.pi * first) / 2 + 1 / (12 * first) - 1 / (360 * F.pow(first, F.lit(3.0)))
    p0 = F.when(first == 0, F.exp(-mean)).otherwise(F.exp(first * F.log1p(gap / first) - gap - stirling))
    rated = rated.withColumn("p0", p0)
    steps = F.sequence(first + 1, F.ceil(mean + width).cast("int"))
    # Running sums from the first probability: p(k) = p(k - 1) * mean / k.
    start = F.struct(F.col("p0").alias("p"), F.array(F.col("p0")).alias("c"))
    cdf = F.aggregate(
        steps,
        start,
        lambda a, k: F.struct((a["p"] * mean / k).alias("p"), F.concat(a["c"], F.array(F.element_at(a["c"], -1) + a["p"] * mean / k)).alias("c")),
        lambda a: a["c"],
    )
    return rated.withColumn("cdf", cdf).drop("p0")


def replicate(docs: DataFrame, size: Column, key: str = "doc_id", source: str = "source", weights: dict[str | None, float] | None = None, epochs: float = 1.0, seed: str = "mix", most: float = MAX_RATE) -> tuple[DataFrame, str, str]:
    """Every document as often as its count, in shuffled order; the names of the copy's
    number (from 0) and of the shuffle key (double, sorted within partitions)."""
    copy, order = fresh(docs.columns, "copy"), fresh(docs.columns, "shuffle_key")
    named = {"source": "__mix_source", "parts": "__mix_parts", "first": "__mix_first", "cdf": "__mix_cdf"}
    table = with_cdf(rates(docs, size, source, weights, epochs), most).select(*[F.col(k).alias(v) for k, v in named.items()])
    if table.schema[0].dataType == NullType():  # which Parquet can't hold
        table = table.withColumn("__mix_source", F.col("__mix_source").cast("string"))
    table = written(table, "mix-table")
    # A row without an id is named by its place, so such rows neither draw nor travel together.
    own = "__mix_key"
    docs = docs.withColumn(own, F.coalesce(F.col(key).cast("string"), F.concat(F.lit("row/"), F.monotonically_increasing_id().cast("string"))))
    joined = docs.join(table, F.col(source).eqNullSafe(F.col("__mix_source")), "left")
    seeds = F.transform(F.sequence(F.lit(1), F.col("__mix_parts")), lambda j: F.when(j == 1, F.lit(seed)).otherwise(F.concat(F.lit(seed + "-"), j.cast("string"))))
    draws = F.transform(seeds, lambda s: uniform(F.col(own), s))
    # Inverse of the distribution: the number of k with P(count <= k) <= u.
    counts = F.transform(draws, lambda u: F.col("__mix_first").cast("long") + F.size(F.filter(F.col("__mix_cdf"), lambda c: c <= u)))
    # Each draw's copies follow those of the draws before it.
    none = F.lit(0).cast("long")
    runs = F.aggregate(
        counts,
        F.array(F.struct(none.alias("a"), none.alias("b"))),
        lambda r, n: F.concat(r, F.array(F.struct(F.element_at(r, -1)["b"].alias("a"), (F.element_at(r, -1)["b"] + n).alias("b")))),
    )
    run = joined.withColumn("__mix_run", F.explode(F.filter(runs, lambda r: r["b"] > r["a"]))).drop(*named.values())
    copies = run.withColumn(copy, F.explode(F.sequence(F.col("__mix_run.a").cast("int"), F.col("__mix_run.b").cast("int") - 1))).drop("__mix_run")
    keyed = copies.withColumn(order, uniform(F.concat_ws("/", F.col(own), F.col(copy).cast("string")), seed + "-order"))
    return keyed.repartition(F.col(order)).sortWithinPartitions(order, own, copy).drop(own), copy, order
