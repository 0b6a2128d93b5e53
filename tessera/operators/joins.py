"""Joins.

No join carries a broadcast hint. With AQE on, Spark measures the bytes of the shuffled
side at run time and turns the sort-merge join into a broadcast join only when they are
below ``spark.sql.adaptive.autoBroadcastJoinThreshold``; each join of a stage is bounded
that way, and no job runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def enrich_with_default(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    value_col: str,
    default=None,
    out_col: str | None = None,
    more: Sequence[str] = (),
) -> DataFrame:
    """Left join a dictionary that is unique on ``keys``; one row out per row in.

    Missing keys give ``default`` (NULL when ``default`` is None). The lookup must be
    unique on ``keys`` (aggregate it first); the row count of ``facts`` is preserved.
    The dictionary columns ``more`` come along under their own names.
    """
    out_col = out_col or value_col
    side = lookup.select(*keys, F.col(value_col).alias("_lookup_value"), *more)
    joined = facts.join(side, on=list(keys), how="left")
    val = F.col("_lookup_value") if default is None else F.coalesce(F.col("_lookup_value"), F.lit(default))
    return joined.withColumn(out_col, val).drop("_lookup_value")


def join_all(frames: Sequence[DataFrame], on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Chained equi-joins on one key (duplicate keys multiply, as in the original)."""
    return reduce(lambda a, b: a.join(b, on=on, how=how), frames)


def create_only(source: DataFrame, destination: DataFrame, key: str = "_id") -> DataFrame:
    """Rows of ``source`` whose key is not in ``destination`` (existing ones untouched)."""
    return source.join(destination.select(key), on=key, how="left_anti")


def keep_keys_in(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left semi join (``isin`` over a DataFrame of keys)."""
    return df.join(keys, on=on, how="left_semi")


def align_to_template(template: DataFrame, values: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """Keep every template row (and its position column), fill values by key."""
    out = template.join(values, on=key, how="left")
    return out.orderBy(order_col) if order_col else out


def label_files(files: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    """Files that have a label, with it. Only the keys travel: the contents of the files
    are read by whoever selects them."""
    return files.join(labels, on=key, how="inner")


def drop_checked(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P5: drop columns, raising on a missing name as pandas does."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)
