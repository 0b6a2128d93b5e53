"""Family D job: tabular preparation for boosted trees.

  train/test CSV (declared types) -> date from the signature-version dictionary (J3)
  -> version features (SC17-SC20b) -> rejects listed apart, kept with default values (E2)
  -> first-seen category codes fitted on train, applied to train and test (E4, J8)
  -> Parquet (SNK6)

Each output is one write of one plan; the feature table feeds two writes (all rows and the
rejects), so it is persisted once. The outputs have a row for every input row.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import tabular as TB
from tessera.operators.joins import drop_checked, enrich_with_default
from tessera.sources import files, sinks

# The version columns the features are computed from, the id column,
# and the dictionary key column.
ENGINE, APP, SIGNATURE, BUILD_LAB = "EngineVersion", "AppVersion", "AvSigVersion", "OsBuildLab"
ID_COL = "MachineIdentifier"
DATE_COL = "Date"


def read_machines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC4: the header gives the column order, the declarations give the types; lines that do
    not fit them come apart."""
    header = spark.read.option("header", True).csv(path).columns
    return files.read_checked_csv(spark, path, files.machine_schema(header))


def add_features(df: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """J3 + SC17-SC20b: signature date (NULL when not in the dictionary) and features."""
    if lookup is not None:
        df = enrich_with_default(df, lookup.withColumnRenamed("version", SIGNATURE), [SIGNATURE], "ts", out_col=DATE_COL)
    return TB.version_features(df, ENGINE, APP, SIGNATURE, BUILD_LAB)


def prepare(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    out_dir: str,
    lookup_path: str | None = None,
) -> dict:
    """Whole job; returns the output paths."""
    lookup = files.read_lookup(spark, lookup_path) if lookup_path else None
    train_rows, train_malformed = read_machines(spark, train_path)
    test_rows, test_malformed = read_machines(spark, test_path)
    sinks.write_columnar(train_malformed, f"{out_dir}/malformed/train")
    sinks.write_columnar(test_malformed, f"{out_dir}/malformed/test")
    numbered = train_rows.withColumn("_order", F.monotonically_increasing_id())  # file order, before any join
    train = add_features(numbered, lookup).persist(StorageLevel.MEMORY_AND_DISK)
    test = add_features(test_rows, lookup).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train_bad, test_bad = TB.split_rejects(train)[1], TB.split_rejects(test)[1]
        train_all, test_all = TB.with_reject_defaults(train), TB.with_reject_defaults(test)
        sinks.write_columnar(train_bad.drop("_order"), f"{out_dir}/rejects/train")
        sinks.write_columnar(test_bad, f"{out_dir}/rejects/test")
        # Categorical columns are the text columns except the id.
        cats = [c for c in TB.columns_of_type(train_all, T.StringType) if c != ID_COL]
        codes = TB.fit_codes(train_all, cats, "_order")
        coded_train = TB.apply_codes(train_all.drop("_order"), codes, cats)
        coded_test = TB.apply_codes(test_all, codes, cats)
        # P5: the coded text columns are dropped by name; a missing name raises.
        sinks.write_columnar(drop_checked(coded_train, cats), f"{out_dir}/train")
        sinks.write_columnar(drop_checked(coded_test, cats), f"{out_dir}/test")
        sinks.write_columnar(codes, f"{out_dir}/codes")
    finally:
        train.unpersist()
        test.unpersist()
    return {k: f"{out_dir}/{k}" for k in ("train", "test", "codes", "rejects/train", "rejects/test", "malformed/train", "malformed/test")}
