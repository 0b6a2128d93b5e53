"""Tabular preparation and blending jobs on temporary files."""

import os
import tempfile

from tessera.plans import blending, features


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_prepare_job(spark):
    d = tempfile.mkdtemp(prefix="tessera-prep-")
    cols = ["MachineIdentifier", "ProductName", "EngineVersion", "AppVersion", "AvSigVersion", "OsBuildLab", "IsBeta", "SmartScreen", "HasDetections"]
    train = _write(os.path.join(d, "train.csv"), ",".join(cols) + "\n"
                   "m1,win8,1.1.15100.1,4.18.1807.18075,1.273.1420.0,17134.1.amd64fre.rs4,0,Off,1\n"
                   "m2,win8,1.1.15200.1,4.18.1807.18075,1.273.1735.0,17134.1*x.amd64fre.rs4,0,,0\n"
                   "m3,mse,1.1,4.18.1807.18075,1.273.1420.0,17134.1.amd64fre.rs4,0,On,1\n"
                   "m4,win8,1.1.15100.1,4.18.1807.18075,1.273.1420.0,17134.1.amd64fre.rs4,1,On,0\n")
    test = _write(os.path.join(d, "test.csv"), ",".join(cols[:-1]) + "\n"
                  "t1,win8,1.1.15100.1,4.18.1807.18075,1.273.1420.0,17134.1.amd64fre.rs4,0,Prompt\n"
                  "t2,new,1.1.15100.1,4.18.1807.18075,1.273.9.0,17134.1.amd64fre.rs4,0,Off\n")
    spark.createDataFrame([("1.273.1420.0", "2018-08-29 00:00:00")], "version string, ts string").write.parquet(os.path.join(d, "lookup"))
    out = os.path.join(d, "out")
    paths = features.prepare(spark, train, test, out, lookup_path=os.path.join(d, "lookup"))
    tr = {r.MachineIdentifier: r for r in spark.read.parquet(paths["train"]).collect()}
    bad = {r.MachineIdentifier: r.reject_reason for r in spark.read.parquet(paths["rejects/train"]).collect()}
    assert bad == {"m3": "engine_num"}  # two-part engine version: the original raised
    assert set(tr) == {"m1", "m2", "m3", "m4"}  # listed as rejected, and kept with a default
    assert tr["m3"].engine_num == 0.0
    assert tr["m1"].engine_num == 15100.1 and tr["m2"].second == 1 and tr["m1"].Date is not None and tr["m2"].Date is None
    assert tr["m1"].ProductName_code == 0 and tr["m1"].SmartScreen_code == 0 and tr["m2"].SmartScreen_code == -1
    assert tr["m3"].SmartScreen_code == tr["m4"].SmartScreen_code == 1
    te = {r.MachineIdentifier: r for r in spark.read.parquet(paths["test"]).collect()}
    assert te["t1"].SmartScreen_code == -1 and te["t2"].ProductName_code == -1 and te["t2"].SmartScreen_code == 0


def test_blend_job(spark):
    d = tempfile.mkdtemp(prefix="tessera-blend-")
    a = _write(os.path.join(d, "a.csv"), "MachineIdentifier,HasDetections\nx,0.9\ny,0.1\nz,0.5\nw,0.3\n")
    b = _write(os.path.join(d, "b.csv"), "MachineIdentifier,HasDetections\nx,0.8\ny,0.3\nz,0.5\nq,1\n")
    res = blending.run_job(spark, [a, b], os.path.join(d, "out"))
    got = {r.id: float(r.label) for r in spark.read.option("header", True).csv(res["blend"]).collect()}
    assert got == {"x": 1.0, "y": 0.2, "z": 0.5}
    assert res["describe"]["count"] == 3 and abs(res["describe"]["delta"] - (0.5 - 1.7 / 3)) < 1e-12
    assert len(res["correlation"]) == 1 and len(res["histogram"]) == 10
