"""Command-line jobs, run in-process on the test session."""

import os
import tempfile

from tessera import cli

SF = "/root/testdata/sf0.001"


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_cli_flights_and_blend(spark):
    from tessera.plans import standins as D

    d = tempfile.mkdtemp(prefix="tessera-cli-")
    D.weather_lines(spark, SF).write.text(os.path.join(d, "weather"))
    D.flight_lines(spark, SF).write.text(os.path.join(d, "flights"))
    res = cli.main(["flights", "--weather", os.path.join(d, "weather"), "--flights", os.path.join(d, "flights"), "--out", os.path.join(d, "out"), "--legacy-text"])
    assert spark.read.text(res["airlines_number_flights"]).count() > 0
    a = _write(os.path.join(d, "a.csv"), "id,HasDetections\nx,0.9\ny,0.1\n")
    b = _write(os.path.join(d, "b.csv"), "id,HasDetections\nx,0.7\ny,0.5\n")
    res = cli.main(["blend", a, b, "--out", os.path.join(d, "blend"), "--weights", "0.7,0.3"])
    got = {r.id: float(r.label) for r in spark.read.option("header", True).csv(res["blend"]).collect()}
    assert got["x"] == 1.0 and abs(got["y"] - 0.22) < 1e-12


def test_cli_search_copy_train(spark):
    from tessera.plans import standins as D

    d = tempfile.mkdtemp(prefix="tessera-cli2-")
    D.log_docs(spark, SF).write.parquet(os.path.join(d, "docs"))
    res = cli.main(["search", "--docs", os.path.join(d, "docs"), "--host", "web-1", "--name", "error", "--out", os.path.join(d, "hits")])
    assert spark.read.parquet(res["hits"]).count() > 0
    res = cli.main(["copy", "--docs", os.path.join(d, "docs"), "--run-date", "2024-01-02", "--host-today", "web-2", "--out", os.path.join(d, "copies")])
    assert res["target"].endswith("copy-2024.01.02")
    first = spark.read.parquet(res["target"]).count()
    assert first > 0
    cli.main(["copy", "--docs", os.path.join(d, "docs"), "--run-date", "2024-01-02", "--host-today", "web-2", "--out", os.path.join(d, "copies")])
    assert spark.read.parquet(res["target"]).count() == first  # second run copies nothing new
    o = spark.read.parquet(f"{SF}/orders.parquet").selectExpr("o_orderkey", "o_totalprice", "CAST(year(o_orderdate) AS DOUBLE) AS yr", "CAST(o_orderstatus = 'F' AS DOUBLE) AS label")
    o.write.parquet(os.path.join(d, "orders"))
    res = cli.main(["train", "--data", os.path.join(d, "orders"), "--features", "o_totalprice,yr", "--label", "label", "--id", "o_orderkey", "--out", os.path.join(d, "model")])
    assert 0.0 <= res["valid_auc"] <= 1.0 and spark.read.parquet(res["valid_scores"]).count() > 0
