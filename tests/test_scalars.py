"""Scalar semantics: one row per trap of the original Python functions."""

import math

from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.functions import versions as V
from tessera.functions.geohash import with_geohash


def one(spark, col, values, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col).collect()]


def test_hour_of_hhmm(spark):
    assert one(spark, S.hour_of_hhmm("x"), ["930", "1530", "45", "", "0930", "5"]) == ["9", "15", "45", "", "09", "5"]


def test_parse_float_matches_python(spark):
    texts = ["15", "15.0", "15.1", "-3", " 20 ", "20d", "", "x", "1e3", " 1e3 ", "nan", "inf", "-Infinity", "1_000", ".5", "5.", "1__0"]
    got = one(spark, S.parse_float("x"), texts)
    for t, g in zip(texts, got):
        try:
            want = float(t)
        except ValueError:
            want = None
        if want is None:
            assert g is None, t
        elif math.isnan(want):
            assert math.isnan(g), t
        else:
            assert g == want, t


def test_delay_flag(spark):
    texts = ["", "x", "15", "15.0", "15.1", "-3", "nan", "inf", "20d", " 20 "]
    assert one(spark, S.delay_flag("x"), texts) == ["No", "No", "No", "No", "Yes", "No", "No", "Yes", "No", "Yes"]
    assert one(spark, S.delay_flag("x", lower_case=True), ["16"]) == ["yes"]


def test_pad_never_truncates(spark):
    assert one(spark, S.pad_right("x", 10), ["abc", "0123456789", "0123456789AB", ""]) == [
        "abc0000000", "0123456789", "0123456789AB", "0000000000"]
    assert one(spark, S.pad_left("x", 3), ["7", "1234"]) == ["007", "1234"]


def test_epoch_ms_to_iso_matches_python(spark):
    from datetime import datetime, timezone

    values = [0, 1517356800000, 1517356800123, 1517356801001, 951782400999]
    got = one(spark, S.epoch_ms_to_iso("x"), values, "x long")
    want = [datetime.fromtimestamp(v / 1000, tz=timezone.utc).replace(tzinfo=None).isoformat() for v in values]
    assert got == want


def test_split_pipe_and_recipients(spark):
    got = one(spark, F.size(S.split_pipe("x")), ["", "a", "a|b|a"])
    assert got == [1, 1, 3]
    assert one(spark, S.recipients_of("x"), ["A@X|b"]) == [["a@x", "b"]]


def test_row_mean_and_snap(spark):
    df = spark.createDataFrame([(0.1, None, 0.5), (None, None, None), (0.9, 0.9, 0.9), (0.2, None, None)], "a double, b double, c double")
    out = df.select(S.row_mean(["a", "b", "c"]).alias("m")).withColumn("s", S.snap_extremes("m")).collect()
    assert abs(out[0].m - 0.3) < 1e-12 and out[0].s == 0.3
    assert out[1].m is None
    assert out[2].s == 1.0
    assert out[3].s == 0.2  # exactly 0.2 stays


def test_snap_keeps_nan(spark):
    got = one(spark, S.snap_extremes("x"), [float("nan"), 0.85, 0.1], "x double")
    assert math.isnan(got[0]) and got[1:] == [1.0, 0.0]


def test_id_from_path(spark):
    assert one(spark, S.id_from_path("x"), ["/a/b/abc.tif", "/a/x.y.z", "/a/", "noslash"]) == ["abc", "x", "", "noslash"]


def _py_geohash(lat, lon, precision=12):
    base32 = "0123456789bcdefghjkmnpqrstuvwxyz"
    lat_i, lon_i = [-90.0, 90.0], [-180.0, 180.0]
    out, bits, ch, even = [], [16, 8, 4, 2, 1], 0, True
    bit = 0
    while len(out) < precision:
        if even:
            mid = (lon_i[0] + lon_i[1]) / 2
            if lon > mid:
                ch |= bits[bit]
                lon_i[0] = mid
            else:
                lon_i[1] = mid
        else:
            mid = (lat_i[0] + lat_i[1]) / 2
            if lat > mid:
                ch |= bits[bit]
                lat_i[0] = mid
            else:
                lat_i[1] = mid
        even = not even
        if bit < 4:
            bit += 1
        else:
            out.append(base32[ch])
            bit, ch = 0, 0
    return "".join(out)


def test_geohash_against_bisection(spark):
    import random

    rnd = random.Random(5)
    pts = [(42.6, -5.6), (90.0, 180.0), (-90.0, -180.0), (0.0, 0.0)] + [
        (rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(300)
    ]
    df = spark.createDataFrame(pts, "lat double, lon double")
    got = with_geohash(df, "lat", "lon", text_input=False).collect()
    for r in got:
        assert r.geohash == _py_geohash(r.lat, r.lon), (r.lat, r.lon)
    assert _py_geohash(42.6, -5.6) == "ezs42e44yx96"


def test_geohash_bad_text(spark):
    df = spark.createDataFrame([("", "1"), ("12.5", "x"), ("1", "2")], "lat string, lon string")
    got = [r.geohash for r in with_geohash(df, "lat", "lon").collect()]
    assert got[:2] == ["None", "None"] and got[2] == _py_geohash(1.0, 2.0)


def test_version_features(spark):
    df = spark.createDataFrame([("1.2.3.4",), ("7",), (None,), ("1.2",), ("1.2.3.4.5",), ("1.2.x.4",)], "v string")
    rows = df.select(*[V.feature("v", n)[0].alias(n) for n in ["engine_num", "app_num", "sig_num"]],
                     *[V.feature("v", n)[1].alias(f"ok_{n}") for n in ["engine_num", "app_num", "sig_num"]]).collect()
    assert (rows[0].engine_num, rows[0].app_num, rows[0].sig_num) == (3.4, 200003.4, 10020003.4)
    assert (rows[1].engine_num, rows[1].ok_engine_num) == (0.0, True)
    assert (rows[2].engine_num, rows[2].ok_engine_num) == (0.0, True)
    assert rows[3].ok_engine_num is False  # two parts: the original raised
    assert rows[4].sig_num == 10020003.4
    assert rows[5].ok_engine_num is False
