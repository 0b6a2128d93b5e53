"""Many small files: written by key by the tasks, listed by a bounded number of tasks."""

import hashlib
import os
import uuid

from __spark_entry__ import queries

from tessera.sources import files, sinks

SETTING = files.LISTING_TASKS


def tasks_of(spark, job):
    """Tasks of the Spark jobs that a call starts."""
    group, sc = uuid.uuid4().hex, spark.sparkContext
    sc.setJobGroup(group, "counted")
    try:
        job()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return sum(s.numTasks for s in stages if s is not None)


def test_each_key_has_one_file_with_its_rows(spark, tmp_path):
    path = str(tmp_path / "a b%20c")
    rows = [(1, "one"), (2, ""), (3, None), (4, "é\r\n漢"), (None, "no key"), (7, "same"), (7, "same"), (-9, "x" * 300_000)]
    df = spark.createDataFrame(rows, "id long, value string").repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # the rows of a key come in several batches
    try:
        sinks.write_key_files(df, path, "id", "page.gz")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    sinks.write_key_files(df, path, "id", "page.gz")  # as a task that runs again
    found = {os.path.join(os.path.basename(home), f): open(os.path.join(home, f), "rb").read() for home, _, names in os.walk(path) for f in names}
    want = {"1": "one\n", "2": "\n", "3": "\n", "4": "é\r\n漢\n", "__HIVE_DEFAULT_PARTITION__": "no key\n", "7": "same\nsame\n", "-9": "x" * 300_000 + "\n"}
    assert found == {f"id={k}/page.gz": v.encode() for k, v in want.items()}
    read = spark.read.format("binaryFile").load(path).collect()
    assert {r.id: bytes(r.content) for r in read} == {None if k.startswith("_") else int(k): v.encode() for k, v in want.items()}


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    n, most = 200, 4 * spark.sparkContext.defaultParallelism
    for i in range(n):
        (tmp_path / f"id={i}").mkdir()
        (tmp_path / f"id={i}" / "a.tif").write_bytes(bytes([i]))
    found = []
    assert tasks_of(spark, lambda: found.append(files.read_image_folder(spark, str(tmp_path), ".tif").drop("id"))) <= most < n
    assert found[0].count() == n and spark.conf.get(SETTING, None) is None
    spark.conf.set(SETTING, "50")  # a session's own number holds
    try:
        assert tasks_of(spark, lambda: files.read_image_folder(spark, str(tmp_path))) == 50
        assert spark.conf.get(SETTING) == "50"
    finally:
        spark.conf.unset(SETTING)


def test_page_files_take_no_task_each(spark, tmp_path):
    n = 300
    html = [None if i % 50 == 0 else f"<p>é {i}</p>\r\n" * (i % 7) for i in range(n)]
    spark.createDataFrame([(i, "u", h) for i, h in enumerate(html)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(0, n + 20, 3)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = []
    assert tasks_of(spark, lambda: got.extend(queries()["binary_files_labelled"](spark, str(tmp_path)).collect())) < n
    bodies = {i: ((h or "") + "\n").encode() for i, h in enumerate(html)}
    want = [(i, i % 2, len(bodies[i]), hashlib.sha256(bodies[i]).hexdigest()) for i in range(0, n, 3)]
    assert sorted(tuple(r) for r in got) == want
