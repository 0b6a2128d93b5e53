"""The stopping test over several cells: recall against brute force, and what it leaves out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import nearest as N


def run(spark, x, cell_rows, k=10, every=20):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    report = {}
    got = N.nearest(df, F.col("vec_id") % every == 0, k=k, cell_rows=cell_rows, report=report).toPandas()
    lists = got.sort_values(["query_id", "rank"]).groupby("query_id").vec_id.apply(list)
    hits = []
    for q in range(0, len(x), every):
        s = x @ x[q]
        s[q] = -np.inf
        hits.append(len(set(lists[q]) & set(np.argsort(-s, kind="stable")[:k])) / k)
        assert len(lists[q]) == k
    return float(np.mean(hits)), report


def test_clusters_stop_the_search_early(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((24, 48)) * 3
    x = centres[rng.integers(0, 24, 4000)] + 0.5 * rng.standard_normal((4000, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    recall, report = run(spark, x, cell_rows=300)
    assert recall >= 0.9 and report["cells"] < 0.5 and report["leaves"] < 0.5 and report["points"] < 0.35


@pytest.mark.parametrize("cell_rows", [300, 4096])
def test_vectors_without_structure(spark, cell_rows):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    recall, report = run(spark, x, cell_rows=cell_rows)
    assert recall >= 0.9 and report["points"] < 0.75
