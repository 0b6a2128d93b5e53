"""Streaming result equals the batch result."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_stream_create_only_equals_batch(spark):
    q = E.queries()
    s = sorted(tuple(r) for r in q["stream_create_only"](spark, SF).collect())
    b = sorted(tuple(r) for r in q["create_only_copy"](spark, SF).collect())
    assert s == b and len(s) > 0


def test_stream_mail_stats_equals_batch(spark):
    q = E.queries()
    s = sorted(tuple(r) for r in q["stream_mail_stats"](spark, SF).collect())
    b = sorted(tuple(r) for r in q["mail_user_stats"](spark, SF).collect())
    assert s == b and len(s) > 0


def test_stream_two_files_create_only_across_batches(spark):
    """Two landed files, read one per micro-batch: an id seen in the first batch is not
    appended again from the second (watermark state) and ids already in the destination
    are skipped."""
    import os
    import tempfile
    from datetime import datetime

    from tessera.streaming.incremental import create_only_stream

    src = tempfile.mkdtemp(prefix="tessera-stream-src-")
    schema = "_id string, host string, `@timestamp` timestamp, payload string"
    spark.createDataFrame(
        [("a", "h", datetime(2024, 1, 1, 1), "a1"), ("b", "h", datetime(2024, 1, 1, 2), "b1"), ("x", "h", datetime(2024, 1, 1, 2), "x1")], schema
    ).coalesce(1).write.parquet(os.path.join(src, "part1"))
    spark.createDataFrame(
        [("a", "h", datetime(2024, 1, 1, 5), "a2"), ("c", "h", datetime(2024, 1, 1, 6), "c1")], schema
    ).coalesce(1).write.parquet(os.path.join(src, "part2"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "part*"))
    destination = spark.createDataFrame([("x",)], "_id string")
    out = sorted((r._id, r.payload) for r in create_only_stream(spark, stream, destination).collect())
    assert out == [("a", "a1"), ("b", "b1"), ("c", "c1")]


def test_stream_mail_edges_equals_batch(spark):
    from tessera.plans import mail as B
    from tessera.plans import standins as D
    from tessera.plans.catalog import _file_stream
    from tessera.streaming.incremental import mail_edges_stream

    rows = D.mail_rows(spark, SF, lineitem=_file_stream(spark, SF, "lineitem"))
    s = sorted(tuple(r) for r in mail_edges_stream(spark, B.parse_records(rows)).collect())
    b = sorted(tuple(r) for r in E.queries()["mail_edges_all"](spark, SF).collect())
    assert s == b and len(s) > 0


def test_mail_streams_write_only_changed_keys(spark):
    """Two files in two micro-batches, then a rerun with a third: totals are those of all
    files, and a batch holds only the users it touched."""
    import os
    import tempfile

    from tessera.streaming.incremental import mail_edges_stream, mail_stats_stream

    src, base = tempfile.mkdtemp(prefix="tessera-mail-src-"), tempfile.mkdtemp(prefix="tessera-mail-run-")
    schema = "sender string, recipients array<string>"

    def land(name, *rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.parquet(os.path.join(src, name))

    def run(fn, folder):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "day*"))
        return sorted(tuple(r) for r in fn(spark, stream, base_dir=os.path.join(base, folder)).collect())

    land("day1", ("a", ["b", "c"]), ("a", ["b"]))
    land("day2", ("b", ["c"]))
    assert run(mail_stats_stream, "stats") == [("a", 0, 2), ("b", 2, 1)]
    assert run(mail_edges_stream, "edges") == [("a", "b", 2), ("a", "c", 1), ("b", "c", 1)]
    land("day3", ("c", ["a"]))
    assert run(mail_stats_stream, "stats") == [("a", 1, 2), ("b", 2, 1), ("c", 2, 1)]
    touched = spark.read.parquet(os.path.join(base, "stats", "totals", "delta", f"{2:012d}"))
    assert sorted(r.user for r in touched.collect()) == ["a", "c"]


def test_stream_resumes_from_its_checkpoint(spark):
    """With a stable base folder, a second run after a new file lands processes only the
    new file, and state from the first run still suppresses a repeated id."""
    import os
    import tempfile
    from datetime import datetime

    from tessera.streaming.incremental import create_only_stream

    src = tempfile.mkdtemp(prefix="tessera-resume-src-")
    base = tempfile.mkdtemp(prefix="tessera-resume-run-")
    schema = "_id string, host string, `@timestamp` timestamp, payload string"
    dest = spark.createDataFrame([], "_id string")

    def stream():
        return spark.readStream.schema(schema).parquet(os.path.join(src, "day*"))

    spark.createDataFrame([("a", "h", datetime(2024, 1, 1, 1), "a1")], schema).write.parquet(os.path.join(src, "day1"))
    first = sorted(r._id for r in create_only_stream(spark, stream(), dest, base_dir=base).collect())
    spark.createDataFrame([("a", "h", datetime(2024, 1, 1, 9), "a2"), ("b", "h", datetime(2024, 1, 1, 9), "b1")], schema).write.parquet(
        os.path.join(src, "day2")
    )
    second = sorted((r._id, r.payload) for r in create_only_stream(spark, stream(), dest, base_dir=base).collect())
    assert first == ["a"] and second == [("a", "a1"), ("b", "b1")]
