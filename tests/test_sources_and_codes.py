"""Reject routing of typed CSV, pruned binary scans, one-join coding, mergeable moments."""

import math
import os

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import metrics as M
from tessera.operators import tabular as TB
from tessera.operators.joins import label_files
from tessera.plans import features
from tessera.sources import files


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_malformed_lines_are_listed_not_nulled(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.ByteType()), T.StructField("x", T.FloatType())])
    path = write(tmp_path / "t.csv", 'a,n,x\nok,1,2.5\nempty,,\ntext,one,2\nbig,300,1\nshort,1\nlong,1,2,3\n"quoted, comma",4,1\nfloat,5,abc\n')
    rows, rejects = files.read_checked_csv(spark, path, schema)
    assert sorted(tuple(r) for r in rows.collect()) == [("empty", None, None), ("ok", 1, 2.5), ("quoted, comma", 4, 1.0)]
    assert sorted(r.line for r in rejects.collect()) == ["big,300,1", "float,5,abc", "long,1,2,3", "short,1", "text,one,2"]
    assert {r.file for r in rejects.collect()} == {"t.csv"}
    # Counting or choosing one column changes nothing about which lines are rejected.
    assert rows.count() == 3 and rejects.count() == 5 and rows.select("a").count() == 3
    empty, none = files.read_checked_csv(spark, write(tmp_path / "e.csv", "a,n,x\n"), schema)
    assert empty.count() == 0 and none.count() == 0


def test_the_prepare_job_lists_malformed_lines(spark, tmp_path):
    cols = "MachineIdentifier,ProductName,EngineVersion,AppVersion,AvSigVersion,OsBuildLab,IsBeta"
    good = "m1,win8,1.1.15100.1,4.18.1807.18075,1.273.1420.0,17134.1.amd64fre.rs4,0"
    bad = "m2,win8,1.1.15100.1,4.18.1807.18075,1.273.1420.0,17134.1.amd64fre.rs4,never"
    train, test = write(tmp_path / "a.csv", f"{cols}\n{good}\n{bad}\n"), write(tmp_path / "b.csv", f"{cols}\n{good}\n")
    paths = features.prepare(spark, train, test, str(tmp_path / "out"))
    assert [r.line for r in spark.read.parquet(paths["malformed/train"]).collect()] == [bad]
    assert spark.read.parquet(paths["malformed/test"]).count() == 0 and spark.read.parquet(paths["train"]).count() == 1


def test_contents_are_read_only_where_selected(spark, tmp_path):
    for i in range(4):
        os.makedirs(tmp_path / "img", exist_ok=True)
        (tmp_path / "img" / f"{i}.tif").write_bytes(bytes([i, 255, 0, 10]) * (i + 1))
    found = files.read_image_folder(spark, str(tmp_path / "img"), ".tif")
    labels = spark.createDataFrame([("1", 0), ("3", 1), ("9", 1)], "id string, label int")
    joined = label_files(found, labels)
    assert "content" not in plan(joined.select("id", "label", "length")).split("ReadSchema")[1].split("\n")[0]
    got = {r.id: (r.label, bytes(r.content)) for r in joined.select("id", "label", "content").collect()}
    assert got == {"1": (0, bytes([1, 255, 0, 10]) * 2), "3": (1, bytes([3, 255, 0, 10]) * 4)}


def test_thirty_columns_cost_as_many_shuffles_as_one(spark):
    names = [f"c{i}" for i in range(30)]
    df = spark.range(200).select("id", *[F.when(F.col("id") % 7 != i % 7, F.concat(F.lit(f"v{i}_"), F.col("id") % (3 + i))).alias(n) for i, n in enumerate(names)])
    codes = TB.fit_codes(df, names, "id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one, all_ = (plan(TB.apply_codes(df, codes, c)).count("Exchange hashpartitioning") for c in (names[:1], names))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert one == all_ <= 4
    got = {r.id: r for r in TB.apply_codes(df, codes, names).collect()}
    seen = [{} for _ in names]
    for r in df.orderBy("id").collect():
        for i, n in enumerate(names):
            want = -1 if r[n] is None else seen[i].setdefault(r[n], len(seen[i]))
            assert got[r.id][f"{n}_code"] == want and got[r.id][n] == r[n]


def test_codes_of_hot_repeated_and_unseen_rows(spark):
    rows = [("hot",)] * 300 + [(f"u{i}",) for i in range(50)] + [(None,), ("new",)]
    df = spark.createDataFrame(rows, "x string").withColumn("x_code", F.lit("clash"))
    codes = spark.createDataFrame([("x", "hot", 7)] + [("x", f"u{i}", i + 10) for i in range(50)] + [("y", "new", 1)], "column string, value string, code long")
    out = TB.apply_codes(df, codes, ["x"])
    got = {r.x: r.x_code for r in out.collect()}
    assert out.count() == len(rows) and got["hot"] == 7 and got["u9"] == 19 and got[None] == got["new"] == -1


def test_moments_take_one_buffer_a_task(spark):
    rng = np.random.default_rng(8)
    v = rng.normal(1e6, 3, (400, 5))
    rows = [(x.tolist(),) for x in v]
    df = spark.createDataFrame(rows, "v array<double>")
    stats = M.dimension_stats(df, "v")
    text = stats._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in text[text.index("Aggregate") :]
    got = {r.pos: (r.mean, r.std) for r in stats.collect()}
    for i in range(5):
        assert math.isclose(got[i][0], v[:, i].mean(), rel_tol=1e-12) and math.isclose(got[i][1], v[:, i].std(), rel_tol=1e-9)
    odd = spark.createDataFrame([([1.0, None, 5.0],), ([3.0],), (None,), ([],), ([2.0, None],)], "v array<double>")
    got = {r.pos: (r.mean, r.std) for r in M.dimension_stats(odd, "v").collect()}
    assert got[0] == (2.0, math.sqrt(2 / 3)) and got[1] == (None, None) and got[2] == (5.0, 0.0)
    assert M.dimension_stats(odd.limit(0), "v").count() == 0
