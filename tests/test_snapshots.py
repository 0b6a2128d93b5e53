"""Snapshot and delta tables, the bucketed key index, and the streams on top of them."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tessera.streaming.incremental import create_only_stream, mail_stats_stream
from tessera.streaming.snapshots import KeyIndex, Snapshots


def latest(rows):
    return rows.groupBy("k").agg(F.max_by("v", "batch").alias("v"))


def test_snapshots_read_few_folders_and_survive_replays(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, v long").schema
    table, want = Snapshots(spark, str(tmp_path / "t"), schema, latest, every=4), {}
    for b in range(18):
        rows = [(b % 5, b), (100 + b, b)]
        want.update(rows)
        table.write(spark.createDataFrame(rows, schema), b)
        if b in (5, 7, 11):  # the batch runs once more: as a delta, as the one that compacts
            table.write(spark.createDataFrame(rows, schema), b)
            assert b == 5 or table.folders()[0] == ("snapshot", b)
        assert len(table.folders()) <= 4
    assert dict(map(tuple, table.read().collect())) == want
    before = dict(map(tuple, table.read(before=16).collect()))
    assert before == {k: v for k, v in {**{b % 5: b for b in range(16)}, **{100 + b: b for b in range(16)}}.items()}
    # Retired: only the last two snapshots and what lies behind the older of them is kept.
    assert sorted(os.listdir(tmp_path / "t" / "snapshot")) == [f"{n:012d}" for n in (11, 15)]
    assert len(os.listdir(tmp_path / "t" / "delta")) == 6


def test_an_uncommitted_snapshot_does_not_count(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, v long").schema
    table = Snapshots(spark, str(tmp_path / "t"), schema, latest, every=3)
    for b in range(4):
        table.write(spark.createDataFrame([(b, b)], schema), b)
    os.remove(tmp_path / "t" / "snapshot" / f"{2:012d}" / "_SUCCESS")
    assert table.folders() == [("delta", b) for b in range(4)] and table.read().count() == 4


def test_key_index_reads_own_buckets_only(spark, tmp_path):
    schema = spark.createDataFrame([], "_id string").schema
    index, total, seen = KeyIndex(spark, str(tmp_path / "k"), schema, every=4, bucket_keys=32), 0, []
    for b in range(24):
        keys = spark.createDataFrame([(f"{b}-{i}",) for i in range(100)], schema)
        index.add(keys, b)
        total += 100
        probe = spark.createDataFrame([("0-0",), ("0-99",), (f"{b}-7",), ("nobody",)], schema)
        known = index.known(probe, b + 1)
        if b % 4 == 3:  # all merged: only buckets are read
            seen.append(known.count())
            assert [r[0] for r in probe.join(known, "_id", "left_anti").collect()] == ["nobody"]
            assert probe.join(index.known(probe, 2), "_id", "left_anti").count() >= 1  # earlier batches only
    assert total == 2400 and max(seen) <= 4 * 3 * 32 and max(seen[3:]) <= 2 * max(seen[:3])


def test_key_index_filters_partitions(spark, tmp_path):
    schema = spark.createDataFrame([], "_id string").schema
    index = KeyIndex(spark, str(tmp_path / "k"), schema, every=1, bucket_keys=8)
    index.add(spark.range(500).select(F.col("id").cast("string").alias("_id")), 0)
    plan = index.known(spark.createDataFrame([("7",)], schema), 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket#", "bucket#") or "PartitionFilters: [isnotnull(bucket" in plan


def test_stream_of_many_batches_copies_each_key_once(spark, tmp_path):
    src, schema = str(tmp_path / "src"), "_id string, `@timestamp` timestamp, payload string"
    start, want = datetime(2024, 1, 1), {}
    for b in range(7):
        rows = [(f"k{i}", start + timedelta(days=7 - b, minutes=i), f"b{b}") for i in range(b * 10, b * 10 + 20)]
        rows += [rows[0][:1] + (rows[0][1] - timedelta(hours=1), "early"), ("x1", start, "known")]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/part{b}")
        for k, t, p in sorted(rows, key=lambda r: r[1]):
            if k != "x1":
                want.setdefault(k, p)
    destination = spark.createDataFrame([("x1",), ("x2",)], "_id string")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/part*")
        return create_only_stream(spark, stream, destination, base_dir=str(tmp_path / "run"), every=3, bucket_keys=8)

    got = run()
    assert sorted(map(tuple, got.select("_id", "payload").collect())) == sorted(want.items())
    # A late row of an old key and a new key land afterwards.
    spark.createDataFrame([("k1", start - timedelta(days=99), "late"), ("new", start, "n")], schema).write.parquet(f"{src}/part9")
    again = {r._id: r.payload for r in run().collect()}
    assert again == {**want, "new": "n"}


def test_mail_totals_over_many_batches(spark, tmp_path):
    src, schema = str(tmp_path / "src"), "sender string, recipients array<string>"
    for b in range(6):
        spark.createDataFrame([(f"s{b % 2}", ["r", f"q{b}"])], schema).coalesce(1).write.parquet(f"{src}/day{b}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/day*")
    got = mail_stats_stream(spark, stream, include_receivers=True, base_dir=str(tmp_path / "run"), every=2)
    want = {("s0", 0, 3), ("s1", 0, 3), ("r", 6, 0), *((f"q{b}", 1, 0) for b in range(6))}
    assert {tuple(r) for r in got.collect()} == want
