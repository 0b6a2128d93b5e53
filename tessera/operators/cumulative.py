"""Distributed running sums and row positions.

A window ``ORDER BY`` without ``PARTITION BY`` runs in one task. Here the data is
range-partitioned on the ordering keys instead; each range partition computes local
running sums, the per-partition totals (a table of ``partitions x groups`` rows) get
their own exclusive prefix sums, and those offsets are added back. Every step is a
bounded per-partition job, so a hot key does not end up in one task as long as the
ordering keys are a total order (callers add a unique tie-breaker).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import written

_PID = "_range_pid"
_RID = "_range_row"


def _n_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def running_sums(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    sums: Mapping[str, Column | str],
    group_cols: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Add inclusive running sums ``sums`` ordered by ``order_cols`` within ``group_cols``.

    ``order_cols`` must define a total order inside each group for a deterministic
    result. The offsets table has one row per (range partition, group), so it stays
    small relative to the data; it is joined back without a broadcast hint and AQE
    picks the strategy from its measured size.
    """
    group_cols = list(group_cols)
    order_exprs = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    vals = {k: (F.col(v) if isinstance(v, str) else v) for k, v in sums.items()}
    tmp = {k: f"_v_{k}" for k in vals}
    staged = df.select("*", *[v.alias(tmp[k]) for k, v in vals.items()])
    keys = [*[F.col(g) for g in group_cols], *order_exprs]
    # Range bounds come from sampling, which can differ between two evaluations of the
    # same plan (and the two branches below are pruned differently, so their exchanges
    # are not shared). The range-partitioned rows are written once to the shared folder,
    # so both branches read one partitioning.
    ranged = staged.repartitionByRange(_n_partitions(df, partitions), *keys)
    ranged = written(ranged.withColumn(_PID, F.spark_partition_id()), "running-sums")

    local_w = (
        Window.partitionBy(_PID, *group_cols)
        .orderBy(*order_exprs)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = ranged.select("*", *[F.sum(F.col(tmp[k])).over(local_w).alias(f"_loc_{k}") for k in vals])

    totals = ranged.groupBy(_PID, *group_cols).agg(*[F.sum(F.col(tmp[k])).alias(f"_tot_{k}") for k in vals])
    off_w = Window.partitionBy(*group_cols).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        _PID,
        *group_cols,
        *[F.coalesce(F.sum(F.col(f"_tot_{k}")).over(off_w), F.lit(0)).alias(f"_off_{k}") for k in vals],
    )
    # A NULL group is a group like any other.
    renamed = offsets.withColumnsRenamed({_PID: "_off_pid", **{g: f"_off_g{i}" for i, g in enumerate(group_cols)}})
    cond = F.col(_PID) == F.col("_off_pid")
    for i, g in enumerate(group_cols):
        cond = cond & F.col(g).eqNullSafe(F.col(f"_off_g{i}"))
    joined = local.join(renamed, cond, "inner")
    out = joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_loc_{k}") + F.col(f"_off_{k}")).alias(k) for k in vals],
    )
    return out


def with_position(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    name: str = "pos",
    group_cols: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """0-based position of each row in ``order_cols`` order within ``group_cols``.

    One range exchange: the rows of a range partition are sorted in place and numbered by
    ``monotonically_increasing_id`` (partition in the high bits, position in the low 33),
    written once, and moved by the counts of the partitions before theirs. Without groups
    that is one row a partition, which is broadcast; with groups one row for each group of
    a partition, joined without a hint.
    """
    group_cols = list(group_cols)
    keys = [*[F.col(g) for g in group_cols], *[F.col(c) if isinstance(c, str) else c for c in order_cols]]
    sorted_rows = df.repartitionByRange(_n_partitions(df, partitions), *keys).sortWithinPartitions(*keys)
    kept = written(sorted_rows.withColumn(_RID, F.monotonically_increasing_id()), "positions")
    pid, local = F.shiftright(_RID, 33), F.col(_RID).bitwiseAND((1 << 33) - 1)
    runs = kept.groupBy(pid.alias("_off_pid"), *[F.col(g).alias(f"_off_g{i}") for i, g in enumerate(group_cols)]).agg(
        F.count(F.lit(1)).alias("_n"), F.min(local).alias("_first")
    )
    before = Window.partitionBy(*[f"_off_g{i}" for i in range(len(group_cols))]).orderBy("_off_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).drop("_n", "_first")
    cond = pid == F.col("_off_pid")
    for i, g in enumerate(group_cols):
        cond = cond & F.col(g).eqNullSafe(F.col(f"_off_g{i}"))
    joined = kept.join(offsets if group_cols else F.broadcast(offsets), cond)
    return joined.select(*[F.col(c) for c in df.columns], (local + F.col("_off")).alias(name))
