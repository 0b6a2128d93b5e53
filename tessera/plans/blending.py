"""Family E job: blend N score files.

  score CSVs (header replaced) -> inner join on id (J2) -> correlation matrix (A16)
  -> row mean or weighted blend (SC22/SC23) -> prediction CSV (SNK5, gzip = SNK8)
  -> snap extremes (SC24) -> profile: describe, histogram, 0.5 - mean (A13-A15)

The snap runs after the file is written only if asked (the original did, Q20); by
default the caller chooses the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import SparkSession

from tessera.operators import blend as BL
from tessera.operators import metrics as M
from tessera.sources import files, sinks


def run_job(
    spark: SparkSession,
    paths: Sequence[str],
    out_dir: str,
    id_col: str = "id",
    weights: Sequence[float] | None = None,
    snap_before_write: bool = True,
    compression: str | None = None,
) -> dict:
    """Whole job; returns output paths and the small summaries (collected: one row per
    column pair / statistic / bin, never per score row)."""
    names = [f"score_{i}" for i in range(len(paths))]
    frames = [files.read_score_file(spark, p, id_col, n) for p, n in zip(paths, names, strict=True)]
    joined = BL.blend_files(frames, id_col, names, out_col="mean").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        corr = [tuple(r) for r in M.correlation_matrix(joined, names).collect()]
        blended = BL.weighted(joined, names, weights, "label") if weights else joined.withColumnRenamed("mean", "label")
        if snap_before_write:
            blended = BL.snap(blended, "label", out_col="label")
        sinks.write_prediction_csv(blended, f"{out_dir}/blend", id_col, "label", compression)
        final = blended if snap_before_write else BL.snap(blended, "label", out_col="label")
        profile = M.describe(final, "label").collect()[0].asDict()
        hist = [tuple(r) for r in M.histogram(final, ["label"]).orderBy("bin").collect()]
    finally:
        joined.unpersist()
    return {"blend": f"{out_dir}/blend", "correlation": corr, "describe": profile, "histogram": hist}
