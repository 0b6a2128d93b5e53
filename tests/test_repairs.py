"""Late and repeated documents, NaN and NULL values, big counts."""

import json

from pyspark.sql import functions as F

from tessera.operators import metrics
from tessera.operators.cumulative import with_position
from tessera.plans import logs
from tessera.streaming.incremental import create_only_stream


def test_create_only_stream_loses_and_repeats_nothing(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    days = [("a", "2024-01-01"), ("c", "2024-01-06"), ("a", "2024-01-12"), ("late", "2024-01-02"), ("d", "2024-01-13"), ("e", "2024-01-13")]
    for i, (k, d) in enumerate(days):
        (src / f"{i}.json").write_text(json.dumps({"_id": k, "@timestamp": f"{d} 00:00:00"}) + "\n")
    stream = spark.readStream.schema("_id string, `@timestamp` string").option("maxFilesPerTrigger", 1).json(str(src))
    there = spark.createDataFrame([("e",)], "_id string")
    out = create_only_stream(spark, stream, there, base_dir=str(tmp_path / "run"))
    assert sorted(r["_id"] for r in out.collect()) == ["a", "c", "d", "late"]


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([("x", 1), (None, 2), ("x", 3), (None, 4)], "g string, v int")
    got = {(r.g, r.v): r.pos for r in with_position(df, ["v"], group_cols=["g"]).collect()}
    assert got == {("x", 1): 0, ("x", 3): 1, (None, 2): 0, (None, 4): 1}


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    row = metrics.describe(df, "x").first()
    assert (row["count"], row["mean"], row["max"]) == (2, 2.0, 3.0)
    assert [r["count"] for r in metrics.histogram(df, ["x"], bins=2).orderBy("bin").collect()] == [1, 1]


def test_auc_skips_missing_scores(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (0, 0.2)], "y int, s double")
    row = metrics.auc_exact(df, "y", "s").first()
    assert (row["auc"], row["n_pos"], row["n_neg"]) == (1.0, 1, 2)


def test_analysed_host_with_underscore(spark):
    df = spark.createDataFrame([("web_1",), ("db-2",)], "host string")
    assert [r.host for r in df.where(logs.match_host("host", "web_1", analyzed=True)).collect()] == ["web_1"]
    assert df.select(F.count("*")).first()[0] == 2
