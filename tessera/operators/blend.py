"""Family E: score blending (J2, SC22-SC24, A21, E14, U3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators.joins import join_all


def blend_files(frames: Sequence[DataFrame], id_col: str, score_cols: Sequence[str], out_col: str = "mean") -> DataFrame:
    """Inner-join N score files on the id and add the row mean (missing skipped)."""
    joined = join_all(frames, id_col, "inner")
    return joined.withColumn(out_col, S.row_mean(score_cols))


def weighted(df: DataFrame, score_cols: Sequence[str], weights: Sequence[float], out_col: str = "blend") -> DataFrame:
    return df.withColumn(out_col, S.weighted_blend(score_cols, weights))


def snap(df: DataFrame, col: str, out_col: str = "snapped", high: float = 0.8, low: float = 0.2) -> DataFrame:
    return df.withColumn(out_col, S.snap_extremes(col, high, low))


def ensemble(long_scores: DataFrame, id_col: str, score_col: str, how: str = "avg", cut: float = 0.5) -> DataFrame:
    """Per id, combine the scores of all models/variants (long table, never
    positional columns) and threshold to 0/1. ``how`` is ``avg`` or ``max``."""
    agg = F.avg(score_col) if how == "avg" else F.max(score_col)
    per_id = long_scores.groupBy(id_col).agg(agg.alias("score"))
    return per_id.withColumn("label", S.threshold("score", cut))
