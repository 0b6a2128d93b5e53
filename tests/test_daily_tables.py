"""The daily copy between tables with a folder a day, and its late payload."""

import os
from datetime import date, datetime

from tessera import cli
from tessera.plans import logs as C

SCHEMA = "_id string, host string, `@timestamp` timestamp, day date, message string"


def docs(spark, *rows):
    return spark.createDataFrame([(i, h, datetime(2024, 1, d, t), date(2024, 1, d), m) for i, h, d, t, m in rows], SCHEMA)


def rows_of(spark, path):
    return sorted((r._id, str(r.target_day), r.run, r.priority, r.message) for r in spark.read.parquet(path).collect())


def test_two_days_are_read_and_a_second_run_adds_nothing(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    C.write_by_day(docs(spark, ("a", "h", 2, 5, "a2"), ("a", "h", 1, 1, "a1"), ("b", "h", 1, 3, "b1"), ("b", "h", 1, 3, "b1"), ("c", "o", 2, 3, "no"), ("d", "h", 3, 1, "d3")), source)
    want = [("a", "2024-01-02", 0, 0, "a2"), ("b", "2024-01-02", 0, 1, "b1")]
    assert C.copy_day(spark, source, target, "2024-01-02", "h", "h") == 0 and rows_of(spark, target) == want
    files = sorted(os.listdir(f"{target}/target_day=2024-01-02/run=0"))
    assert C.copy_day(spark, source, target, "2024-01-02", "h", "h") == 1 and rows_of(spark, target) == want
    assert sorted(os.listdir(f"{target}/target_day=2024-01-02")) == ["run=0"] and sorted(os.listdir(f"{target}/target_day=2024-01-02/run=0")) == files
    # A document that lands late is added in a run of its own; what is there stays, older offers too.
    C.write_by_day(docs(spark, ("a", "h", 2, 1, "earlier"), ("e", "h", 2, 2, "e2")), source)
    assert C.copy_day(spark, source, target, "2024-01-02", "h", "h") == 1
    assert rows_of(spark, target) == [*want, ("e", "2024-01-02", 1, 0, "e2")]
    # Another day leaves this one alone.
    C.copy_day(spark, source, target, "2024-01-03", "h", "h")
    assert [r for r in rows_of(spark, target) if r[1] == "2024-01-02"] == [*want, ("e", "2024-01-02", 1, 0, "e2")]
    assert {r[0] for r in rows_of(spark, target) if r[1] == "2024-01-03"} == {"a", "d", "e"}


def test_partition_filters_reach_both_scans(spark, tmp_path):
    source = str(tmp_path / "s")
    C.write_by_day(docs(spark, *[(f"i{d}", "h", d, 1, "m") for d in range(1, 9)]), source)
    table = spark.read.parquet(source)
    plan = C.daily_copy(table.withColumn("_row", table._id), "2024-01-05", "h", "h", row_id="_row")
    text = plan._jdf.queryExecution().executedPlan().toString()
    for line in (x for x in text.splitlines() if "FileScan" in x):
        assert "PartitionFilters: [" in line and "day#" in line.split("PartitionFilters: [")[1]
    read = plan.inputFiles()
    assert all("2024" in f for f in read)
    assert table.where("day = DATE'2024-01-05' OR day = DATE'2024-01-04'").count() == 2 == plan.count()


def test_no_payload_in_the_aggregate(spark):
    out = C.two_source_copy(docs(spark, ("a", "h", 2, 5, "a2"), ("a", "h", 2, 5, "a2"), ("a", "g", 1, 1, "a1")), "h", "g")
    text = out._jdf.queryExecution().optimizedPlan().toString()
    for line in (x for x in text.splitlines() if "Aggregate" in x):
        assert "message" not in line
    assert [(r._id, str(r.target_day), r.message) for r in out.collect()] == [("a", "2024-01-02", "a2")]


def test_cli_copies_a_table_day(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    C.write_by_day(docs(spark, ("a", "h", 2, 5, "a2")), source)
    args = ["copy-table", "--source", source, "--target", target, "--run-date", "2024-01-02", "--host-today", "h"]
    assert cli.main(args)["run"] == 0 and cli.main(args)["run"] == 1 and len(rows_of(spark, target)) == 1
