"""Boosted trees with patience, categories, missing values, split counts and the keep-list."""

import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tessera.functions.scalars import hash_unit
from tessera.operators import boosting as X
from tessera.operators.metrics import auc_exact

PARAMS = {"maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 1.0, "featureSubsetStrategy": "all", "minInstancesPerNode": 5, "seed": 3}


@pytest.fixture(scope="module")
def rows(spark):
    """A label that depends on a set of codes, on a missing number and on a number."""
    n = spark.range(3000).select(
        F.col("id"),
        (F.col("id") % 11).cast("string").alias("code"),
        F.when(F.col("id") % 5 == 0, F.when(F.col("id") % 2 == 0, F.lit(float("nan")))).otherwise((F.col("id") % 101).cast("double")).alias("x"),
        F.lit(7.0).alias("constant"),
    )
    sure = F.col("code").isin("2", "3", "7", "10") | (F.col("id") % 5 == 0)
    return n.withColumn("label", (sure != (hash_unit("id", 4) < 0.1)).cast("int")).withColumn("held", hash_unit("id", 9) < 0.25)


def test_stop_round():
    assert X.stop_round([5, 4, 3, 4, 5, 6, 1], 3) == (3, True)  # the later fall is not seen
    assert X.stop_round([5, 4, 3, 4, 5, 6, 1], 5) == (7, False)
    assert X.stop_round([1.0], 2) == (1, False) and X.stop_round([2, 2, 2], 2) == (1, True)


def test_codes_are_split_by_sets_at_depth_one(spark):
    df = spark.range(700).select((F.col("id") % 7).cast("string").alias("code"), (F.col("id") % 7).isin(1, 4, 6).cast("int").alias("label"))
    fitted = X.fit(df, df, "label", [], ["code"], PARAMS | {"maxDepth": 1, "minInstancesPerNode": 1}, patience=3, max_rounds=3)
    seen = {r.code: r.score for r in X.score(fitted, df.unionByName(spark.createDataFrame([("new", 0), (None, 0)], "code string, label int")), "code").distinct().collect()}
    assert all((seen[c] > 0.5) == (c in "146") for c in "0123456") and seen["new"] == seen[None]


def test_patience_keeps_the_best_prefix(spark, rows):
    train, held = rows.where("not held"), rows.where("held")
    fitted = X.fit(train, held, "label", ["x", "constant"], ["code"], PARAMS | {"maxDepth": 5, "minInstancesPerNode": 1, "stepSize": 0.9}, patience=4, max_rounds=60, block=4)
    assert fitted.rounds >= fitted.best_round + 4 or fitted.rounds == 60
    assert fitted.losses[fitted.best_round - 1] == min(fitted.losses[: fitted.best_round + 4]) and min(fitted.losses) < fitted.losses[-1]
    model = fitted.model.stages[-1]
    assert model.getNumTrees == fitted.best_round
    # The cut model has the loss of that round.
    scored = X.score(fitted, held, F.col("label").cast("double").alias("y"))
    p = F.when(F.col("y") == 1, F.col("score")).otherwise(1 - F.col("score"))
    assert math.isclose(2 * scored.agg(F.avg(-F.log(p))).first()[0], fitted.losses[fitted.best_round - 1], rel_tol=1e-6)


def test_missing_rows_score_alike_and_models_load(spark, rows, tmp_path):
    train, held = rows.where("not held"), rows.where("held")
    gaps, whole = [], []
    for fill in (0.0, -1e6, 1e6):
        fitted = X.fit(train, held, "label", ["x"], ["code"], PARAMS, patience=5, max_rounds=10, fill=fill)
        s = X.score(fitted, held.withColumn("gap", F.col("x").isNull() | F.isnan("x")), "gap", "label", "code")
        per = s.where("gap").groupBy("code").agg(F.min("score").alias("a"), F.max("score").alias("b")).collect()
        assert all(r.b - r.a < 1e-9 for r in per)  # NULL and NaN are one
        gaps.append(s.where("gap").agg(F.avg("score")).first()[0])
        whole.append(auc_exact(s, "label", "score").first()["auc"])
    assert max(gaps) - min(gaps) < 0.01 and min(gaps) > 0.8 and min(whole) > 0.85
    path = str(tmp_path / "model")
    fitted.model.write().save(path)
    again = X.Boosted(PipelineModel.load(path), fitted.columns, fitted.losses, fitted.best_round)
    assert X.score(again, held, "id").exceptAll(X.score(fitted, held, "id")).count() == 0


def test_rare_codes_share_one(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 990, (F.col("id") % 3).cast("string")).otherwise(F.concat(F.lit("rare"), F.col("id"))).alias("code"))
    assert X.frequent_codes(df, ["code"], 3) == {"code": ["0", "1", "2"]}
    assert X.frequent_codes(df, [], 3) == {} and X.missing_columns(df, []) == []


def test_split_counts_and_keep_list_drive_a_second_fit(spark, rows):
    data = rows.withColumn("fold", (hash_unit("id", 2) * 2).cast("int"))
    preds, imps, fits = X.folds_with_patience(data, "label", "id", "fold", [0, 1], ["x", "constant"], ["code"], params=PARAMS, patience=3, max_rounds=12)
    assert preds.count() == 3000 and preds.select("id").distinct().count() == 3000
    for k, fitted in fits.items():
        table = X.nodes(fitted)
        inner = table.where("splits").count()
        leaves = table.where("not splits").count()
        assert leaves == inner + fitted.best_round  # binary trees
        assert imps.where(F.col("fold") == k).agg(F.sum("importance")).first()[0] == inner
    got = {(r.feature, r.fold): r.importance for r in imps.collect()}
    assert got["constant", 0] == got["constant", 1] == 0 and got["code", 0] > 0 and got["x", 1] > 0
    shares = X.top_shares(imps, 2)
    assert {r.feature for r in shares.collect()} == {"x", "code"} and abs(shares.agg(F.sum("share")).first()[0] - 100) < 1e-9
    kept = X.keep_list(imps, fold=1, least=0)
    assert kept == ["code", "x"] and X.keep_list(imps, fold=1, least=1e9) == []
    again = X.fit(data.where("fold != 1"), data.where("fold = 1"), "label", [c for c in kept if c == "x"], [c for c in kept if c == "code"], PARAMS, patience=3, max_rounds=12)
    assert set(again.columns) == {"x", "code"}
    assert auc_exact(X.score(again, data.where("fold = 1"), "label"), "label", "score").first()["auc"] > 0.85


def test_shuffled_labels_teach_nothing(spark, rows):
    noise = rows.withColumn("label", (hash_unit("id", 77) < 0.5).cast("int"))
    fitted = X.fit(noise.where("not held"), noise.where("held"), "label", ["x"], ["code"], PARAMS, patience=3, max_rounds=10)
    assert auc_exact(X.score(fitted, noise.where("held"), "label"), "label", "score").first()["auc"] < 0.6


def test_held_out_rows_are_needed(spark, rows):
    with pytest.raises(ValueError):
        X.fit(rows, rows.limit(0), "label", ["x"], [], PARAMS, patience=2, max_rounds=2)


def test_many_rows_are_fitted_as_weighted_rows(spark, rows, monkeypatch):
    """Above a number of rows, equal ones are one row with a weight; none is left out."""
    from tessera.operators import model as M

    train, held = rows.where("not held"), rows.where("held")
    plain = X.fit(train, held, "label", ["x"], ["code"], PARAMS, patience=3, max_rounds=6)
    fits, n = [], train.count()
    seen = M.weighted
    monkeypatch.setattr(M, "MOST_ROWS", 200)
    monkeypatch.setattr(M, "weighted", lambda *a: fits.append(seen(*a)) or fits[-1])
    many = X.fit(train, held, "label", ["x"], ["code"], PARAMS, patience=3, max_rounds=6)
    assert fits[0].count() < n and fits[0].agg(F.sum(M.WEIGHT)).first()[0] == n and fits[1].agg(F.sum(M.WEIGHT)).first()[0] == held.count()
    assert many.rounds >= 3 and abs(min(many.losses) - min(plain.losses)) < 0.05
    auc = auc_exact(X.score(many, held, "label"), "label", "score").first()["auc"]
    assert auc > auc_exact(X.score(plain, held, "label"), "label", "score").first()["auc"] - 0.03


def test_compared_sets_share_the_weighted_rows(spark, rows, monkeypatch):
    from tessera.operators import model as M

    data = rows.select("id", "label", F.col("id").cast("double").alias("x"), (F.col("code").cast("int") % 3).alias("c"))
    sets = {"a": M.gbt_params(leaves=8, min_rows=30, rounds=4, learning_rate=0.3), "b": M.gbt_params(leaves=4, min_rows=10, rounds=4, learning_rate=0.3)}
    want = {r.name: r.auc for r in M.compare_sets(data, ["x", "c"], "label", "id", sets).collect()}
    made, seen = [], M.weighted
    monkeypatch.setattr(M, "MOST_ROWS", 100)
    monkeypatch.setattr(M, "weighted", lambda *a: made.append(seen(*a)) or made[-1])
    got = {r.name: r.auc for r in M.compare_sets(data, ["x", "c"], "label", "id", sets).collect()}
    assert len(made) == 1 and made[0].agg(F.max(M.WEIGHT)).first()[0] <= 24
    assert all(abs(got[k] - want[k]) < 0.08 for k in sets), (got, want)
    model = M.train(data, ["x", "c"], "label", sets["a"] | {"seed": 1})
    assert M.score(model, data, "id").where("score between 0 and 1").count() == data.count()
