"""Feature preparation for tabular learning.

* version features with reject routing (E2)
* first-seen category coding fitted on one frame and applied to others (E4)
* stable hashed samples and folds (E5, E7), contiguous folds (E6)
* typed selection and a column profile (P7, P16)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import scalars as S
from tessera.functions import versions as V
from tessera.operators.cumulative import with_position
from tessera.session import written

UNSEEN_CODE = -1


# ------------------------------------------------------------------ E2 + SC17-SC20b
def version_features(df: DataFrame, engine: str, app: str, signature: str, build_lab: str) -> DataFrame:
    """Add the numeric version features and a ``reject_reason`` column.

    ``reject_reason`` lists (comma-joined, fixed order) the features whose parse would
    have raised in the original; NULL when the row is clean. The work is staged in
    three projections (split once, parse once, then defaults) so each parse is
    evaluated once per row and the generated code stays small.
    """
    inputs = {"engine": engine, "app": app, "signature": signature, "build_lab": build_lab}
    split_cols = {src: f"_parts_{src}" for src in inputs}
    staged = df.select("*", *[V.parts(F.col(col)).alias(split_cols[src]) for src, col in inputs.items()])
    staged = staged.select(
        "*",
        *[fn(F.col(split_cols[src])).alias(f"_raw_{name}") for name, (src, _, fn, _) in V.FEATURES.items()],
    )
    values, oks = [], []
    for name, (src, need, _, default) in V.FEATURES.items():
        applies = F.size(F.col(split_cols[src])) >= need
        raw = F.col(f"_raw_{name}")
        values.append(F.when(applies, raw).otherwise(F.lit(default)).alias(name))
        oks.append((~applies | raw.isNotNull()).alias(f"_ok_{name}"))
    staged = staged.select(*df.columns, *values, *oks)
    staged = staged.withColumn("fifth", V.join_as_decimal("first", "second"))
    reasons = F.concat_ws(
        ",", *[F.when(~F.col(f"_ok_{k}"), F.lit(k)) for k in V.FEATURES], F.when(F.col("fifth").isNull(), F.lit("fifth"))
    )
    staged = staged.withColumn("_reason", F.when(reasons != "", reasons)).drop(*[f"_ok_{k}" for k in V.FEATURES])
    # The reason is unpacked from a one-element generator. A filter on it (the reject
    # routing) then stays above the feature projection instead of being rewritten into
    # the whole parse expression, which would not fit one generated method.
    keep = [c for c in staged.columns if c != "_reason"]
    return staged.select(*keep, F.inline(F.array(F.struct(F.col("_reason").alias("reject_reason")))))


def with_reject_defaults(df: DataFrame, reason_col: str = "reject_reason") -> DataFrame:
    """Every row, without the reason; features that would have raised get the value of
    a version too short to hold them, so no id is lost (the reject table lists the rows)."""
    short = {name: default for name, (_, _, _, default) in V.FEATURES.items()}
    out = df.withColumns({name: F.coalesce(F.col(name), F.lit(default)) for name, default in short.items()})
    return out.withColumn("fifth", F.coalesce("fifth", V.join_as_decimal("first", "second"), F.lit(0.0))).drop(reason_col)


def split_rejects(df: DataFrame, reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows). Both come from one plan; cache the input when
    both are written."""
    return df.where(F.col(reason_col).isNull()).drop(reason_col), df.where(F.col(reason_col).isNotNull())


# ------------------------------------------------------------------ E4 / A17 / J8
def fit_codes(train: DataFrame, columns: Sequence[str], order_col: str) -> DataFrame:
    """First-seen coding dictionary ``(column, value, code)``, one per column.

    Codes are 0..n-1 in order of first appearance (``order_col``), missing values left
    out. All columns are coded in one pass: unpivot -> ``min(order)`` per (column,
    value) (map-side partial aggregate) -> distributed dense position per column.
    """
    long = train.select(
        F.col(order_col).alias("_order"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("_kv"),
    ).select("_order", "_kv.column", "_kv.value")
    first_seen = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.min("_order").alias("first_seen"))
    coded = with_position(first_seen, ["first_seen", "value"], name="code", group_cols=["column"])
    # The fitted dictionary (one row per distinct category, not per data row) is applied
    # once per column and to several frames, so it is written once.
    return written(coded.select("column", "value", "code"), "codes")


def apply_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Replace each category by its code; missing or unseen values get -1.

    All columns take one join: the rows are numbered and written once, their categories
    unpivoted to (row, column, value), joined to the whole dictionary, folded back to one
    row of codes (combined within a task first) and joined to the rows by number. So 30
    columns cost as many shuffles as one. No join has a hint: AQE broadcasts the dictionary
    where its measured bytes allow, and splits a value that many rows hold where not.
    """
    rid = "_rid"
    rows = written(df.withColumn(rid, F.monotonically_increasing_id()), "coding")
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])).alias("_kv")
    long = rows.select(rid, kv).select(rid, "_kv.column", "_kv.value").where(F.col("value").isNotNull())
    hits = long.join(codes.select("column", "value", "code"), ["column", "value"])
    named = {c: f"{c}{suffix}" for c in columns}
    wide = hits.groupBy(rid).agg(*[F.max(F.when(F.col("column") == F.lit(c), F.col("code"))).alias(name) for c, name in named.items()])
    out = rows.drop(*named.values()).join(wide, rid, "left")
    return out.withColumns({name: F.coalesce(F.col(f"`{name}`"), F.lit(UNSEEN_CODE).cast("bigint")) for name in named.values()}).drop(rid)


# ------------------------------------------------------------------ E5 / E6 / E7
def stable_sample(df: DataFrame, id_col: str, fraction: float, seed: int) -> DataFrame:
    """E5: repeatable sample of about ``fraction`` of the rows (hash of id and seed)."""
    return df.where(S.hash_unit(id_col, seed) < F.lit(fraction))


def hashed_folds(df: DataFrame, id_col: str, k: int, seed: int, name: str = "fold") -> DataFrame:
    """Fold in ``[0, k)`` from the hash of id and seed (shuffled K-fold without a shuffle)."""
    return df.withColumn(name, S.hash_bucket(id_col, seed, k))


def holdout_label(df: DataFrame, id_col: str, test_fraction: float, seed: int, name: str = "split") -> DataFrame:
    """The same membership as a column, in one pass."""
    return df.withColumn(name, F.when(S.hash_unit(id_col, seed) < F.lit(test_fraction), F.lit("valid")).otherwise(F.lit("train")))


def holdout_split(df: DataFrame, id_col: str, test_fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """train/validation split by hashed id."""
    u = S.hash_unit(id_col, seed)
    return df.where(u >= F.lit(test_fraction)), df.where(u < F.lit(test_fraction))


def contiguous_folds(df: DataFrame, order_cols: Sequence[str], k: int, name: str = "fold") -> DataFrame:
    """K contiguous blocks in ``order_cols`` order, the first ``n % k`` one row larger.

    Positions come from the distributed prefix count; ``n`` is a scalar subquery.
    """
    pos = with_position(df, list(order_cols), name="_pos")
    n = df.agg(F.count(F.lit(1))).scalar()  # scalar subquery, computed once
    j = pos.withColumn("_n", n)
    base = F.floor(F.col("_n") / k)
    extra = F.pmod(F.col("_n"), F.lit(k))
    big = extra * (base + 1)
    fold = F.when(F.col("_pos") < big, F.floor(F.col("_pos") / (base + 1))).otherwise(extra + F.floor((F.col("_pos") - big) / base))
    return j.withColumn(name, fold.cast("int")).drop("_pos", "_n")


# ------------------------------------------------------------------ P7 / P16
def columns_of_type(df: DataFrame, dtype: type[T.DataType] = T.StringType) -> list[str]:
    """Names of the columns of one type (schema only, no job)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, dtype)]


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: ``column_name, data_type, non_null, n_rows`` (one scan)."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count(F.col(f"`{c}`")).alias(f"_nn{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("data_type"), F.col(f"_nn{i}").alias("non_null"))
            for i, c in enumerate(df.columns)
        ]
    )
    return one.select(F.col("_n").alias("n_rows"), F.explode(entries).alias("e")).select("e.column_name", "e.data_type", "e.non_null", "n_rows")
