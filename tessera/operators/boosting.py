"""E9-E12 in full: boosted trees with patience, categories and missing values, and split counts.

* Rounds are fitted in growing blocks until the held-out loss has not fallen for
  ``patience`` rounds, or ``max_rounds`` are reached; the model is then cut to its best
  round, so scoring (E10) uses the best prefix. A block is a fit of its own whose trees
  begin with those of the block before (same data, same seeds), and doubles its length, so
  all blocks cost at most twice the last one.
* Categories become nominal attributes, on whose codes trees split by sets. A column keeps
  its ``max_codes`` most frequent values; all others, unseen ones and NULL share one code.
* A missing number (NULL or NaN) is filled with a constant, and a column of its own tells
  filled rows apart, for every column that has a missing value in training.
* Above ``model.MOST_ROWS`` training rows, equal vectors are fitted, and their loss taken, as
  weighted rows, and numbers are cut at quantiles (see ``model``).
* Importances are split counts, read from the fitted ensemble's node table.

The encoding is a pipeline of standard Spark ML stages, so a fitted model is saved and loaded
as any other. Only bounded data reach the driver: codes, one loss a round, one count a
feature.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import model as M
from tessera.operators.model import gbt_params
from tessera.session import checkpoint_dir, written

VECTOR = "_features"


@dataclass(frozen=True)
class Boosted:
    """A fitted model, cut to ``best_round`` trees."""

    model: PipelineModel
    columns: list[str]  # the input column behind each place of the feature vector
    losses: list[float]  # held-out loss after each fitted round
    best_round: int

    @property
    def rounds(self) -> int:
        return len(self.losses)


# -- encoding --------------------------------------------------------------------------


def frequent_codes(df: DataFrame, columns: Sequence[str], max_codes: int) -> dict[str, list[str]]:
    """The most frequent values of each column, equal counts by value; at most ``max_codes``
    a column, so what is collected is bounded."""
    if not columns:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]))
    counted = df.select(pairs.alias("p")).select("p.*").where(F.col("value").isNotNull()).groupBy("column", "value").count()
    order = Window.partitionBy("column").orderBy(F.desc("count"), "value")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in counted.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= max_codes).orderBy("column", "_rank").collect():
        found[r["column"]].append(r["value"])
    return found


def missing_columns(df: DataFrame, numeric: Sequence[str]) -> list[str]:
    """The numeric columns that hold a NULL or NaN (one pass)."""
    if not numeric:
        return []
    counts = df.agg(*[F.count(F.when(F.col(f"`{c}`").isNull() | F.isnan(F.col(f"`{c}`").cast("double")), 1)).alias(f"_{i}") for i, c in enumerate(numeric)]).first()
    return [c for i, c in enumerate(numeric) if counts[i]]


def encoding(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), max_codes: int = 1000, fill: float = 0.0, max_bins: int | None = None) -> tuple[PipelineModel, list[str]]:
    """Stages that turn rows into feature vectors with nominal attributes, and the column
    behind each place of the vector. With ``max_bins``, numbers are cut into that many bins."""
    codes = frequent_codes(df, categorical, max_codes)
    coded = [c for c in categorical if codes[c]]  # a column without any value says nothing
    gaps = missing_columns(df, numeric)
    number = lambda c: f"CAST(`{c}` AS DOUBLE)"
    filled = {c: f"coalesce(nanvl({number(c)}, NULL), CAST({fill!r} AS DOUBLE))" for c in numeric}
    if max_bins:
        cuts = M.quantile_cuts(df.select(*[F.expr(x).alias(c) for c, x in filled.items()]), numeric, max_bins)
        filled |= {c: M.cut_sql(filled[c], x) for c, x in cuts.items()}
    parts = [f"{filled[c]} AS `_number_{c}`" for c in numeric]
    parts += [f"CAST({number(c)} IS NULL OR isnan({number(c)}) AS DOUBLE) AS `_missing_{c}`" for c in gaps]
    parts += [f"CAST(`{c}` AS STRING) AS `_text_{c}`" for c in coded]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")]
    if coded:
        stages.append(StringIndexerModel.from_arrays_of_labels([codes[c] for c in coded], inputCols=[f"_text_{c}" for c in coded], outputCols=[f"_code_{c}" for c in coded], handleInvalid="keep"))
    inputs = [f"_number_{c}" for c in numeric] + [f"_missing_{c}" for c in gaps] + [f"_code_{c}" for c in coded]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=VECTOR))
    return PipelineModel(stages), [*numeric, *gaps, *coded]


def _arity(df: DataFrame) -> int:
    """The largest number of codes of a nominal attribute of the feature vector."""
    attrs = df.schema[VECTOR].metadata.get("ml_attr", {}).get("attrs", {})
    return max((len(a.get("vals", [])) for a in attrs.get("nominal", [])), default=0)


# -- fitting ---------------------------------------------------------------------------


def stop_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """(best round from 1, whether ``patience`` rounds without a fall followed it)."""
    best = 0
    for at, loss in enumerate(losses):
        if loss < losses[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first ``rounds`` trees."""
    sc = SparkSession.getActiveSession().sparkContext
    fitted, jvm, gateway = model._java_obj, sc._jvm, sc._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = fitted.trees()[i], fitted.treeWeights()[i]
    cut = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{model.uid}_{rounds}", trees, weights))
    return cut.setFeaturesCol(model.getFeaturesCol())


def fit(
    train: DataFrame,
    valid: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    params: dict | None = None,
    patience: int = 200,
    max_rounds: int = 10_000,
    block: int | None = None,
    max_codes: int = 1000,
    fill: float = 0.0,
) -> Boosted:
    """Fit until ``valid`` has not improved for ``patience`` rounds, keep the best prefix."""
    own = {k: v for k, v in (params or gbt_params()).items() if k != "maxIter"}
    n = train.count()
    many = n > M.MOST_ROWS
    encoder, columns = encoding(train, numeric, categorical, max_codes, fill, own.get("maxBins", 32) if many else None)
    target = F.col(f"`{label}`").cast("double").alias("_label")
    rows, held = (encoder.transform(df).select(target, VECTOR) for df in (train, valid))
    if many:
        rows, held = M.weighted(rows, n, M.MOST_ROWS), M.weighted(held, n, M.MOST_ROWS)
        own = M.weighted_params(own, float(n))
    else:
        rows, held = written(rows, "boost-train"), written(held, "boost-valid")
    if held.isEmpty():
        raise ValueError("patience needs held-out rows")
    own["maxBins"] = max(own.get("maxBins", 32), _arity(rows))
    rounds = min(max_rounds, block or 2 * patience)
    while True:
        fitted = GBTClassifier(featuresCol=VECTOR, labelCol="_label", maxIter=rounds, **own).fit(rows)
        losses = [float(x) for x in fitted.evaluateEachIteration(held)]
        best, stopped = stop_round(losses, patience)
        if stopped or rounds == max_rounds:
            return Boosted(PipelineModel([*encoder.stages, first_rounds(fitted, best)]), columns, losses, best)
        rounds = min(max_rounds, 2 * rounds)


# -- scoring and importances --------------------------------------------------------------


def score(fitted: Boosted, df: DataFrame, *keep: str, out_col: str = "score") -> DataFrame:
    """The columns to keep and the probability of class 1 at the best round."""
    scored = fitted.model.transform(df)
    return scored.select(*keep, vector_to_array("probability")[1].alias(out_col))


def nodes(fitted: Boosted) -> DataFrame:
    """The ensemble's node table: tree, node, whether it splits, and on which column."""
    model, session = fitted.model.stages[-1], SparkSession.getActiveSession()
    path = f"{checkpoint_dir(session)}/trees-{uuid.uuid4().hex}"
    model.write().save(path)
    table = session.read.parquet(f"{path}/data")
    column = F.array(*[F.lit(c) for c in fitted.columns])
    inner = F.col("nodeData.leftChild") >= 0
    return table.select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"), inner.alias("splits"), F.when(inner, F.get(column, F.col("nodeData.split.featureIndex"))).alias("feature")
    )


def split_counts(fitted: Boosted, features: Sequence[str], fold: int) -> DataFrame:
    """``feature, importance, fold``: how often the trees split on each column (or on
    whether it is missing), 0 for columns never used."""
    table = nodes(fitted)
    named = table.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    counted = table.where("splits").groupBy("feature").agg(F.count("*").alias("importance"))
    out = named.join(counted, "feature", "left")
    return out.select("feature", F.coalesce("importance", F.lit(0)).cast("double").alias("importance"), F.lit(int(fold)).alias("fold"))


def top_shares(importances: DataFrame, top: int = 1000) -> DataFrame:
    """Rows of the ``top`` features by mean importance, with each row's share of
    all of them in percent."""
    mean = importances.groupBy("feature").agg(F.avg("importance").alias("_mean"))
    kept = importances.join(mean.orderBy(F.desc("_mean"), "feature").limit(top).select("feature"), "feature", "left_semi")
    total = kept.agg(F.sum("importance")).scalar()
    return kept.withColumn("share", F.lit(100.0) * F.col("importance") / total)


def keep_list(importances: DataFrame, fold: int, least: float, top: int = 1000, least_share: float = 0.0) -> list[str]:
    """The features whose importance in ``fold`` is above ``least`` and whose share is
    above ``least_share``, by name; one name a feature reaches the driver."""
    kept = top_shares(importances, top).where((F.col("fold") == fold) & (F.col("importance") > least) & (F.col("share") >= least_share))
    return [r["feature"] for r in kept.select("feature").distinct().orderBy("feature").collect()]


def folds_with_patience(
    df: DataFrame, label: str, id_col: str, fold_col: str, folds: Sequence[int], numeric: Sequence[str], categorical: Sequence[str] = (), **options
) -> tuple[DataFrame, DataFrame, dict[int, Boosted]]:
    """For each fold, fit on the others with the fold as held-out rows, score it
    at the best round and count splits. Returns (id, fold, label, score), (feature,
    importance, fold) and the fits."""
    df = written(df, "patience-folds")
    preds = imps = None
    fits: dict[int, Boosted] = {}
    for k in folds:
        held = df.where(F.col(fold_col) == k)
        fits[k] = fit(df.where(F.col(fold_col) != k), held, label, numeric, categorical, **options)
        p = score(fits[k], held, id_col, F.lit(int(k)).alias("fold"), F.col(f"`{label}`").alias("label"))
        i = split_counts(fits[k], [*numeric, *categorical], k)
        preds, imps = (p, i) if preds is None else (preds.unionByName(p), imps.unionByName(i))
    return preds, imps, fits
