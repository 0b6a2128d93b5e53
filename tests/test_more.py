"""Run-date copy, one-decimal formatting, parameter comparison."""

from datetime import date, datetime

from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.plans import logs as C

SF = "/root/testdata/sf0.001"


def test_daily_copy_reads_two_days_first_wins(spark):
    rows = [
        ("x", "h", datetime(2024, 1, 2, 5), date(2024, 1, 2), 1),
        ("x", "h", datetime(2024, 1, 1, 1), date(2024, 1, 1), 2),  # yesterday's copy loses
        ("y", "h", datetime(2024, 1, 1, 3), date(2024, 1, 1), 3),
        ("z", "other", datetime(2024, 1, 2, 3), date(2024, 1, 2), 4),  # other host
        ("w", "h", datetime(2023, 12, 31, 3), date(2023, 12, 31), 5),  # too old
    ]
    docs = spark.createDataFrame(rows, "_id string, host string, `@timestamp` timestamp, day date, _seq long")
    existing = spark.createDataFrame([(date(2024, 1, 2), "y")], "target_day date, _id string")
    out = C.daily_copy(docs, "2024-01-02", "h", "h", existing).collect()
    assert [(r._id, r.priority, r._seq) for r in out] == [("x", 0, 1)]
    assert C.target_name("copy", "2024-01-02") == "copy-2024.01.02"


def test_format_one_decimal(spark):
    df = spark.createDataFrame([(12.345,), (-0.04,), (100.0,)], "x double")
    assert [r[0] for r in df.select(S.format_one_decimal("x")).collect()] == ["12.3", "-0.0", "100.0"]


def test_compare_params_picks_a_model(spark):
    from tessera.operators import model as M

    o = spark.read.parquet(f"{SF}/orders.parquet").select(
        "o_totalprice", F.year("o_orderdate").cast("double").alias("yr"), (F.col("o_orderstatus") == "F").cast("double").alias("label")
    )
    fitted = M.compare_params(o, ["o_totalprice", "yr"], "label", {"maxDepth": [2, 3], "maxIter": [3]})
    assert len(fitted.validationMetrics) == 2
    assert all(0.0 <= m <= 1.0 for m in fitted.validationMetrics)


def test_checkpoint_dir_never_local_on_a_cluster():
    import pytest

    from tessera.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class SC:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Spark:
        sparkContext = SC()
        conf = Conf()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Spark())
