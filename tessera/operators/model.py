"""Boosted trees on Spark ML, batch scoring, importances, parameter comparison.

The original used a leaf-wise boosting library; Spark ML's ``GBTClassifier`` is the
distributed counterpart (same job, its own scores). Parameter mapping: learning rate ->
``stepSize``; bagging share -> ``subsamplingRate``; feature share ->
``featureSubsetStrategy``; min rows per leaf -> ``minInstancesPerNode``; leaves ->
``maxDepth`` with 2^depth >= leaves; early stopping -> ``validationIndicatorCol`` +
``validationTol``.

Above ``MOST_ROWS`` training rows, rows that no split can tell apart (same bins, label and
validation mark) are fitted as weighted rows, so the rounds cost no more than with that many
rows where bins repeat. Every row counts, with its weight; numbers are cut at quantiles, by a
stage of the fitted pipeline, as trees do on their own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalars import hash_unit
from tessera.session import written


def gbt_params(
    leaves: int = 60,
    min_rows: int = 60,
    learning_rate: float = 0.05,
    feature_share: float = 0.8,
    bagging_share: float = 0.8,
    rounds: int = 50,
    seed: int = 3,
) -> dict:
    """Spark ML parameters for one of the original parameter sets."""
    return {
        "maxDepth": max(1, min(30, math.ceil(math.log2(max(leaves, 2))))),
        "minInstancesPerNode": min_rows,
        "stepSize": learning_rate,
        "featureSubsetStrategy": str(feature_share),
        "subsamplingRate": bagging_share,
        "maxIter": rounds,
        "seed": seed,
    }


# The original's parameter sets.
PARAMETER_SETS = {
    "holdout": gbt_params(leaves=60, min_rows=60, learning_rate=0.05, feature_share=0.8, seed=3),
    "importance": gbt_params(leaves=60, min_rows=60, learning_rate=0.05, feature_share=0.8, seed=3),
    "validation": gbt_params(leaves=60, min_rows=60, learning_rate=0.02, feature_share=0.8, seed=3),
    "many leaves": gbt_params(leaves=200, min_rows=60, learning_rate=0.1, feature_share=0.8, seed=7),
    "previous": gbt_params(leaves=120, min_rows=40, learning_rate=0.05, feature_share=0.5),
    "old best": gbt_params(leaves=120, min_rows=40, learning_rate=0.05, feature_share=0.3, seed=133),
    "best": gbt_params(leaves=100, min_rows=100, learning_rate=0.05, feature_share=0.3, seed=133),
}


#: More training rows than these are condensed.
MOST_ROWS = 1 << 20
WEIGHT = "_weight"


def quantile_cuts(df: DataFrame, columns: Sequence[str], max_bins: int) -> dict[str, list[float]]:
    """Upper ends of at most ``max_bins`` bins for each column with more values than that;
    NULL and NaN are in none."""
    if not columns:
        return {}
    values = [F.col(f"`{c}`").cast("double") for c in columns]
    known = [F.when(~F.isnan(v), v) for v in values]
    shares = [i / max_bins for i in range(1, max_bins + 1)]
    found = df.agg(*[F.approx_count_distinct(v) for v in known], *[F.percentile_approx(v, shares, 10_000) for v in known]).first()
    return {c: sorted(set(found[len(columns) + i])) for i, c in enumerate(columns) if found[i] > max_bins}


def cut_sql(number: str, cuts: Sequence[float]) -> str:
    """SQL that gives each number the upper end of its bin (the last one above it, too)."""
    literal = [f"CAST('{x!r}' AS DOUBLE)" for x in cuts]
    return f"CASE WHEN {number} IS NULL OR isnan({number}) THEN {number} {' '.join(f'WHEN {number} <= {x} THEN {x}' for x in literal)} ELSE {literal[-1]} END"


def weighted(df: DataFrame, n: int, most: int) -> DataFrame:
    """The ``n`` rows of ``df`` as distinct rows with a weight. A weight stands for at most
    n / ``most`` rows, so that bagging still draws small shares of equal rows."""
    unit = -(-n // most)
    grouped = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_pieces", F.ceil(F.col("_n") / F.lit(unit)))
    pieces = grouped.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pieces") - 1)))
    weight = F.expr("(_n * (_piece + 1)) div _pieces - (_n * _piece) div _pieces").cast("double")
    return written(pieces.select(*df.columns, weight.alias(WEIGHT)).repartition(df.sparkSession.sparkContext.defaultParallelism), "weighted")


def weighted_params(params: dict, n: float) -> dict:
    """Parameters for weighted rows of total weight ``n``: the least rows of a leaf are a share."""
    least = params.get("minInstancesPerNode", 1)
    return {**params, "minInstancesPerNode": 1, "minWeightFractionPerNode": min(0.49, least / max(n, 1.0)), "weightCol": WEIGHT}


@dataclass(frozen=True)
class Ready:
    """Training rows and the stages that make their inputs; ``n`` is their weight, if weighted."""

    rows: DataFrame
    inputs: list[str]
    stages: list
    n: float | None = None


def ready(df: DataFrame, features: Sequence[str], keys: Sequence[str], valid_col: str | None = None, max_bins: int = 32) -> Ready:
    """``df`` for fits on ``features``, condensed if it has more than ``MOST_ROWS`` rows."""
    n = df.count()
    if n <= MOST_ROWS:
        return Ready(df, list(features), [])
    cuts = quantile_cuts(df, features, max_bins)
    parts = [f"{cut_sql(f'CAST(`{c}` AS DOUBLE)', x)} AS `_bin_{c}`" for c, x in cuts.items()]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")] if parts else []
    inputs = [f"_bin_{c}" if c in cuts else c for c in features]
    binned = stages[0].transform(df) if stages else df
    rows = weighted(binned.select(*keys, *inputs), n, MOST_ROWS)
    learnt = rows.where(~F.col(f"`{valid_col}`")) if valid_col else rows
    return Ready(rows, inputs, stages, learnt.agg(F.coalesce(F.sum(WEIGHT), F.lit(0.0))).first()[0])


def fit_ready(data: Ready, label: str, params: dict | None = None, validation_col: str | None = None) -> PipelineModel:
    own = params or gbt_params()
    assembler = VectorAssembler(inputCols=data.inputs, outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(featuresCol="features", labelCol=label, **(own if data.n is None else weighted_params(own, data.n)))
    if validation_col:
        gbt = gbt.setValidationIndicatorCol(validation_col)
    return PipelineModel([*data.stages, *Pipeline(stages=[assembler, gbt]).fit(data.rows).stages])


def train(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    params: dict | None = None,
    validation_col: str | None = None,
) -> PipelineModel:
    """Assemble features, fit boosted trees (early stop on ``validation_col`` rows)."""
    keys = [label, *([validation_col] if validation_col else [])]
    data = ready(df, features, keys, validation_col, (params or {}).get("maxBins", 32))
    return fit_ready(data, label, params, validation_col)


def score(model: PipelineModel, df: DataFrame, id_col: str, out_col: str = "score") -> DataFrame:
    """Id + probability of class 1."""
    return model.transform(df).select(id_col, vector_to_array("probability")[1].alias(out_col))


def auc(model: PipelineModel, df: DataFrame, label: str) -> float:
    """A18 via Spark's evaluator (approximate binning for very many distinct scores)."""
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    return ev.evaluate(model.transform(df))


def importances(model: PipelineModel, features: Sequence[str], fold: int, spark: SparkSession | None = None) -> DataFrame:
    """``feature, importance, fold`` (one row per feature: size bounded by the
    feature list, built on the driver from the fitted model)."""
    gbt = model.stages[-1]
    vals = gbt.featureImportances.toArray().tolist()
    spark = spark or SparkSession.getActiveSession()
    return spark.createDataFrame([(f, float(v), int(fold)) for f, v in zip(features, vals, strict=True)], "feature string, importance double, fold int")


def compare_params(df: DataFrame, features: Sequence[str], label: str, grid: dict, train_ratio: float = 0.8, seed: int = 15):
    """Hold-out comparison of parameter sets (parallel fits)."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(featuresCol="features", labelCol=label, seed=seed)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(gbt.getParam(name), values)
    tvs = TrainValidationSplit(
        estimator=Pipeline(stages=[assembler, gbt]),
        estimatorParamMaps=builder.build(),
        evaluator=BinaryClassificationEvaluator(labelCol=label),
        trainRatio=train_ratio,
        parallelism=4,
        seed=seed,
    )
    return tvs.fit(df)


def compare_sets(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    id_col: str,
    sets: dict[str, dict] | None = None,
    test_share: float = 0.2,
    valid_share: float = 0.1,
    parallelism: int = 4,
    seed: int = 15,
) -> DataFrame:
    """``name, auc`` of named parameter sets (default ``PARAMETER_SETS``): the exact AUC
    on the same hashed test share. Each fit stops early on ``valid_share`` of the rest."""
    from concurrent.futures import ThreadPoolExecutor
    from functools import reduce

    from tessera.operators.metrics import auc_exact

    sets = sets or PARAMETER_SETS
    marked = df.withColumns({"_is_test": hash_unit(id_col, seed) < F.lit(test_share), "_is_valid": hash_unit(id_col, seed + 1) < F.lit(valid_share)})
    marked = written(marked, "parameter-sets")
    test = marked.where("_is_test")
    data = ready(marked.where("not _is_test"), features, [label, "_is_valid"], "_is_valid", max(s.get("maxBins", 32) for s in sets.values()))

    def one(item: tuple[str, dict]) -> DataFrame:
        model = fit_ready(data, label, item[1], validation_col="_is_valid")
        scored = model.transform(test).select(label, vector_to_array("probability")[1].alias("score"))
        return auc_exact(scored, label, "score").select(F.lit(item[0]).alias("name"), "auc")

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(sets)))) as pool:
        return reduce(DataFrame.unionByName, pool.map(one, sets.items()))


def out_of_fold(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    id_col: str,
    fold_col: str,
    folds: Sequence[int],
    params: dict | None = None,
    parallelism: int = 4,
    valid_share: float = 0.1,
    seed: int = 21,
) -> tuple[DataFrame, DataFrame]:
    """E11 + E12: for each listed fold, fit on the other folds and score this one.

    The input is written once, so no fit derives it again. Each fit stops early on
    ``valid_share`` of its own training rows, chosen by the hash of the id.

    The folds are fitted concurrently from driver threads (as Spark ML's tuning does
    with ``parallelism``); each fit is a distributed Spark ML job. Returns (out-of-fold
    predictions ``id, fold, label, score``, importances ``feature, importance, fold``),
    each appended across folds with ``unionByName``.
    """
    from concurrent.futures import ThreadPoolExecutor

    df = written(df.withColumn("_is_valid", hash_unit(id_col, seed) < F.lit(valid_share)), "folds")

    def one(k: int):
        model = train(df.where(F.col(fold_col) != k), features, label, params, validation_col="_is_valid")
        scored = model.transform(df.where(F.col(fold_col) == k)).select(
            id_col, F.lit(int(k)).alias("fold"), F.col(label).alias("label"), vector_to_array("probability")[1].alias("score")
        )
        return scored, importances(model, features, k, df.sparkSession)

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(folds)))) as pool:
        results = list(pool.map(one, folds))
    preds, imps = results[0]
    for p, i in results[1:]:
        preds, imps = preds.unionByName(p), imps.unionByName(i)
    return preds, imps
