"""Column -> Column functions with the exact semantics of the original jobs.

Everything here is a built-in Spark expression (whole-stage codegen, no Python UDF).
ANSI mode stays on: parsing uses ``try_cast`` / ``try_divide`` / ``get`` so bad input
becomes NULL instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text grammar Python's float() accepts for finite numbers
# (optional sign, digits with single underscores between them, optional
# fraction, optional exponent, surrounding white space), and its infinity words.
_DIGITS = r"[0-9](?:_?[0-9])*"
FLOAT_TEXT = (
    r"^\s*[+-]?(?:" + _DIGITS + r"(?:[.](?:" + _DIGITS + r")?)?|[.]" + _DIGITS + r")"
    r"(?:[eE][+-]?" + _DIGITS + r")?\s*$"
)
POS_INF_TEXT = r"^\s*[+]?(?i:inf|infinity)\s*$"
NEG_INF_TEXT = r"^\s*-(?i:inf|infinity)\s*$"
NAN_TEXT = r"^\s*[+-]?(?i:nan)\s*$"
INT_TEXT = r"^\s*[+-]?" + _DIGITS + r"\s*$"

# Fixed value: the lateness threshold in minutes of the delay flag.
LATE_MINUTES = 15.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Fixed value: the characters Python's str.strip() removes (ASCII white space).
WHITE_SPACE = " \t\n\r\x0b\x0c"
FLOAT_CORE = FLOAT_TEXT.replace(r"^\s*", "^").replace(r"\s*$", "$")
INT_CORE = INT_TEXT.replace(r"^\s*", "^").replace(r"\s*$", "$")


def strip_ws(x) -> Column:
    """Python ``str.strip()`` for ASCII white space."""
    return F.trim(_c(x), F.lit(WHITE_SPACE))


def parse_float(x) -> Column:
    """Python ``float(text)`` as a column: NULL where Python would raise.

    Accepts what Python accepts (``' 1e3 '``, ``'1_000'``, ``'inf'``, ``'nan'``) and
    rejects what Python rejects but Spark's cast would take (``'20d'``).
    """
    t = strip_ws(_c(x).cast("string"))
    word = F.lower(t)
    return (
        F.when(t.rlike(FLOAT_CORE), F.regexp_replace(t, "_", "").try_cast("double"))
        .when(word.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf")))
        .when(word.isin("-inf", "-infinity"), F.lit(float("-inf")))
        .when(word.isin("nan", "+nan", "-nan"), F.lit(float("nan")))
    )


def parse_int(x) -> Column:
    """Python ``int(text)``: NULL where Python would raise (or beyond 64 bits)."""
    t = strip_ws(_c(x).cast("string"))
    return F.when(t.rlike(INT_CORE), F.regexp_replace(t, "_", "").try_cast("bigint"))


def hour_of_hhmm(t) -> Column:
    """SC1: drop the last two characters of an HHMM text; texts of length <= 2 stay.

    ``'930' -> '9'``, ``'1530' -> '15'``, ``'45' -> '45'``, ``'' -> ''``.
    """
    t = _c(t)
    return F.when(F.length(t) <= 2, t).otherwise(t.substr(F.lit(1), F.length(t) - 2))


def delay_flag(delay, lower_case: bool = False) -> Column:
    """SC2: ``'Yes'`` when the text parses as a number strictly above 15, else ``'No'``."""
    # nanvl turns NaN into NULL (Spark orders NaN above every number, Python does not),
    # so the parse is referenced once.
    d = F.nanvl(parse_float(delay), F.lit(None).cast("double"))
    late = F.coalesce(d > F.lit(LATE_MINUTES), F.lit(False))
    yes, no = ("yes", "no") if lower_case else ("Yes", "No")
    return F.when(late, F.lit(yes)).otherwise(F.lit(no))


def route(origin, destination) -> Column:
    """SC4: ``origin-->destination``."""
    return F.concat(_c(origin), F.lit("-->"), _c(destination))


def pad_right(c, width: int, fill: str = "0") -> Column:
    """SC5: ``str.ljust(width, fill)``; never truncates (bare ``rpad`` would)."""
    c = _c(c)
    return F.when(F.length(c) >= width, c).otherwise(F.rpad(c, width, fill))


def pad_left(c, width: int, fill: str = "0") -> Column:
    """``'{:0>w}'.format(text)``; never truncates (bare ``lpad`` would)."""
    c = _c(c)
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, fill))


def fahrenheit_to_celsius(f) -> Column:
    """SC6: ``(f - 32) * 5 / 9`` in doubles."""
    return (_c(f).cast("double") - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)


def format_one_decimal(x) -> Column:
    """SC7: ``'%1.1f'`` for the legacy text sink."""
    return F.format_string("%.1f", _c(x))


def epoch_ms_to_iso(ms) -> Column:
    """SC8: ``datetime.utcfromtimestamp(ms / 1000).isoformat()``.

    Computed with integer arithmetic on the epoch, so the session time zone cannot
    change it: ``yyyy-MM-ddTHH:mm:ss`` plus ``.ffffff`` only when the milliseconds are
    not zero.
    """
    ms = _c(ms).cast("bigint")
    day = F.floor(ms / F.lit(86_400_000)).cast("int")
    rest = F.pmod(ms, F.lit(86_400_000))
    secs = F.floor(rest / F.lit(1000)).cast("int")
    frac = F.pmod(rest, F.lit(1000))
    two = lambda v: F.lpad(v.cast("string"), 2, "0")
    clock = F.concat_ws(":", two(F.floor(secs / 3600)), two(F.floor(F.pmod(secs, F.lit(3600)) / 60)), two(F.pmod(secs, F.lit(60))))
    base = F.concat(F.date_from_unix_date(day).cast("string"), F.lit("T"), clock)
    return F.when(frac == 0, base).otherwise(F.concat(base, F.lit("."), F.lpad((frac * 1000).cast("string"), 6, "0")))


def split_pipe(x) -> Column:
    """SC10: ``text.split('|')``; an empty text gives one empty element."""
    return F.split(_c(x), "[|]")


def recipients_of(x) -> Column:
    """SC9 + SC10: lower-cased recipient list."""
    return split_pipe(F.lower(_c(x)))


def attribute_list(recipients) -> Column:
    """SC11 + SC12: ``[{'name': 'number_of_recipients', 'value': len(list)}]``."""
    return F.array(F.struct(F.lit("number_of_recipients").alias("name"), F.size(_c(recipients)).alias("value")))


def stable_id(*parts) -> Column:
    """SC13 for re-runnable jobs: SHA-256 of the parts joined by ``|``."""
    return F.sha2(F.concat_ws("|", *[_c(p).cast("string") for p in parts]), 256)


def base_name(path) -> Column:
    """SC14: text after the last ``/``."""
    return F.substring_index(_c(path), "/", -1)


def id_from_path(path) -> Column:
    """SC21: after the last ``/``, before the first ``.``."""
    return F.substring_index(base_name(path), ".", 1)


def row_mean(cols: Sequence) -> Column:
    """SC22: mean over columns, missing values skipped; NULL when all are missing."""
    cols = [_c(c).cast("double") for c in cols]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols[1:]), F.coalesce(cols[0], F.lit(0.0)))
    n = sum((c.isNotNull().cast("int") for c in cols[1:]), cols[0].isNotNull().cast("int"))
    return F.try_divide(total, n.cast("double"))


def weighted_blend(cols: Sequence, weights: Sequence[float]) -> Column:
    """SC23: ``w1*a + w2*b + ...``; a missing input gives a missing blend."""
    terms = [F.lit(float(w)) * _c(c).cast("double") for c, w in zip(cols, weights, strict=True)]
    return sum(terms[1:], terms[0])


def snap_extremes(x, high: float = 0.8, low: float = 0.2) -> Column:
    """SC24: above ``high`` -> 1, below ``low`` -> 0, else unchanged (NaN stays NaN)."""
    x = _c(x).cast("double")
    return (
        F.when(F.isnan(x), x)
        .when(x > F.lit(high), F.lit(1.0))
        .when(x < F.lit(low), F.lit(0.0))
        .otherwise(x)
    )


def sigmoid(x) -> Column:
    """SC25."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x).cast("double")))


def threshold(x, cut: float = 0.5) -> Column:
    """SC26: ``(x > cut)`` as 0/1."""
    return (_c(x) > F.lit(cut)).cast("int")


def hash_bucket(id_col, seed: int | str, buckets: int) -> Column:
    """Stable bucket in ``[0, buckets)`` from the first 32 bits of ``md5(id:seed)``.

    md5 is used (rather than xxhash64) so that any SQL engine can recompute it.
    """
    h = F.conv(F.substring(F.md5(F.concat(_c(id_col).cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets))


def hash_unit(id_col, seed: int | str) -> Column:
    """Stable number in ``[0, 1)`` from the first 32 bits of ``md5(id:seed)``."""
    h = F.conv(F.substring(F.md5(F.concat(_c(id_col).cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("bigint")
    return h.cast("double") / F.lit(float(2**32))
