"""What source mixing sends between tasks."""

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing


@pytest.fixture
def few_bytes(spark):
    """Tables above 64 KB are not broadcast, as the documents of a real run."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "64k")
    yield
    spark.conf.set(key, old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_travel_once(spark, tmp_path, few_bytes):
    text = F.concat_ws(" ", *[F.sha2(F.concat(F.col("id"), F.lit(f"/{j}")), 256) for j in range(8)])
    source = F.when(F.col("id") % 5 > 0, F.concat(F.lit("s"), F.col("id") % 5))
    spark.range(2000).select(F.col("id").alias("doc_id"), source.alias("source"), text.alias("text")).write.parquet(f"{tmp_path}/docs")
    out, copy, order = mixing.replicate(spark.read.parquet(f"{tmp_path}/docs"), F.length("text"))
    assert "SortMergeJoin" not in plan(out) and plan(out).count("Exchange hashpartitioning") == 1
    # The same copies as where the texts go by source.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    by_source = mixing.replicate(spark.read.parquet(f"{tmp_path}/docs"), F.length("text"))[0]
    assert "SortMergeJoin" in plan(by_source)
    got = sorted(tuple(r) for r in out.select("doc_id", F.md5("text"), copy, order).collect())
    assert len(got) > 1500 and got == sorted(tuple(r) for r in by_source.select("doc_id", F.md5("text"), copy, order).collect())


def test_source_without_a_type(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(None).alias("source"), F.lit("abcd").alias("text"))
    out = mixing.replicate(df, F.length("text"))[0]
    assert dict(out.dtypes)["source"] == "void" and abs(out.count() - 500) < 120
