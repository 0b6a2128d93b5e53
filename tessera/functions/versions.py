"""SC17-SC20b: numeric features from dotted version texts.

Each feature returns ``(value, ok)``: ``value`` is the feature (with the job's default
when the text has too few parts), ``ok`` is false where the original row function would
have raised (too few parts for the indexes it reads, or a part that does not parse).
Rows with any failure are routed to a reject table by ``operators.tabular``.

A missing text behaves like the text ``'nan'`` did in the original (one part).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.scalars import _c, pad_left, parse_float, parse_int

# The defaults of the original feature functions.
NUMBER_DEFAULT = 0
TEXT_DEFAULT = "___"


def parts(v) -> Column:
    """``str(v).split('.')``; NULL behaves as one part."""
    return F.split(F.coalesce(_c(v).cast("string"), F.lit("nan")), "[.]")


def _p(arr: Column, i: int) -> Column:
    return F.get(arr, i)  # NULL out of range, never raises


# Each feature: (minimum number of parts for the parse to apply, parse of a parts
# array, default). Below the minimum the default applies; at or above it the parse
# must succeed or the row is rejected.
def engine_raw(p: Column) -> Column:
    """``float(p2 + '.' + p3)``."""
    return parse_float(F.concat(_p(p, 2), F.lit("."), _p(p, 3)))


def app_raw(p: Column) -> Column:
    """``float('{p1:0>2}{p2:0>5}.{p3}')``."""
    return parse_float(F.concat(pad_left(_p(p, 1), 2), pad_left(_p(p, 2), 5), F.lit("."), _p(p, 3)))


def signature_raw(p: Column) -> Column:
    """``float('{p0:0>2}{p1:0>3}{p2:0>4}.{p3}')``."""
    return parse_float(F.concat(pad_left(_p(p, 0), 2), pad_left(_p(p, 1), 3), pad_left(_p(p, 2), 4), F.lit("."), _p(p, 3)))


def lab_first_raw(p: Column) -> Column:
    return parse_int(_p(p, 0))


def lab_second_raw(p: Column) -> Column:
    return parse_int(F.substring_index(_p(p, 1), "*", 1))


def lab_third_raw(p: Column) -> Column:
    return _p(p, 2)


def lab_fourth_raw(p: Column) -> Column:
    return _p(p, 3)


# name -> (which input, minimum parts, raw parse, default)
FEATURES = {
    "engine_num": ("engine", 2, engine_raw, float(NUMBER_DEFAULT)),
    "app_num": ("app", 2, app_raw, float(NUMBER_DEFAULT)),
    "sig_num": ("signature", 4, signature_raw, float(NUMBER_DEFAULT)),
    "first": ("build_lab", 2, lab_first_raw, NUMBER_DEFAULT),
    "second": ("build_lab", 4, lab_second_raw, NUMBER_DEFAULT),
    "third": ("build_lab", 2, lab_third_raw, TEXT_DEFAULT),
    "fourth": ("build_lab", 2, lab_fourth_raw, TEXT_DEFAULT),
}


def feature(v, name: str) -> tuple[Column, Column]:
    """One feature of a version text as ``(value, ok)`` (single-column convenience)."""
    _, need, raw_fn, default = FEATURES[name]
    p = parts(v)
    raw = raw_fn(p)
    applies = F.size(p) >= need
    return F.when(applies, raw).otherwise(F.lit(default)), ~applies | raw.isNotNull()


def join_as_decimal(first, second) -> Column:
    """SC20b: ``float('{first}.{second}')`` (lossy: 1.1 and 1.10 collide)."""
    return parse_float(F.concat(_c(first).cast("string"), F.lit("."), _c(second).cast("string")))


def join_as_sort_key(first, second) -> Column:
    """Non-lossy alternative to SC20b for ordering."""
    return F.struct(_c(first).alias("first"), _c(second).alias("second"))
