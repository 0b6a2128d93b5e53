"""Sources and sinks on temporary files (edge rows from FIXTURES.md)."""

import gzip
import os
import tempfile

from pyspark.sql import functions as F

from tessera.operators.joins import align_to_template, label_files
from tessera.plans import flights as A
from tessera.sources import files, sinks


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_flight_lines_edge_rows(spark):
    d = tempfile.mkdtemp(prefix="tessera-flights-")
    header = ",".join(["Date"] + [f"c{i}" for i in range(1, 19)])

    def row(date, dep, delay, lat="10", lon="20", code="AB", dest="JFK"):
        f = [date, "AA", "", dest, "", "BOS", "", dep, delay] + [""] * 6 + [lon, lat, "", code]
        return ",".join(f)

    lines = [
        header,
        row("2018-01-01", "930", "16"),
        row("2018-01-01", "930", "16"),  # exact duplicate line
        header,  # header twice
        row("2018-01-01", "45", "x"),
        row("2018-01-01", "1530", "15", code="0123456789AB"),
        row("2018-01-01", "", " 20 ", lat="", lon=""),
        row("2018-01-02", "5", "nan", dest='"N,Y"'),
    ]
    path = _write(os.path.join(d, "flights.csv"), "\n".join(lines) + "\n")
    weather = _write(os.path.join(d, "weather.csv"), "Date,Airport,Time,Temp\n2018-01-01,BOS,901,9\n2018-01-01,BOS,959,100\n2018-01-01,BOS,4510,50\n")
    dic = A.weather_dictionary(A.parse_weather(files.read_lines(spark, weather)))
    legacy = A.weather_dictionary(A.parse_weather(files.read_lines(spark, weather)), legacy_text_max=True)
    assert {(r.hour, r.temperature) for r in dic.collect()} == {("9", 100.0), ("45", 50.0)}
    assert {(r.hour, r.temperature_text) for r in legacy.where("airport = 'BOS'").collect()} == {("9", "9"), ("45", "50")}
    flights = A.project_flights(A.parse_flights(files.read_lines(spark, path)))
    out = A.enrich(flights, dic).collect()
    assert len(out) == 5  # duplicate and both headers removed
    by_dep = {r.dep_time: r for r in out}
    assert by_dep["930"].temperature == 100.0 and by_dep["930"].delay_flag == "Yes"
    assert by_dep["45"].temperature == 50.0 and by_dep["45"].delay_flag == "No"
    assert by_dep["1530"].code == "0123456789AB" and by_dep["1530"].delay_flag == "No"
    assert by_dep[""].geohash == "None" and by_dep[""].delay_flag == "Yes"
    assert by_dep["5"].route == "BOS-->N,Y"
    text = A.legacy_text(A.with_legacy_temperature(A.enrich(flights, dic)), "%s, %s", F.col("airline"), F.col("temperature"))
    tdir = os.path.join(d, "text")
    sinks.write_text_lines(text, tdir)
    got = spark.read.text(tdir).collect()
    assert sorted(r.value for r in got)[0].startswith("AA, ")
    assert any(r.value.endswith("9999.0") for r in got)


def test_typed_csv_and_score_files(spark):
    d = tempfile.mkdtemp(prefix="tessera-csv-")
    cols = ["MachineIdentifier", "EngineVersion", "IsBeta", "LocaleEnglishNameIdentifier", "CountryIdentifier", "AVProductsInstalled", "Census_OSBuildRevision", "HasDetections"]
    path = _write(os.path.join(d, "train.csv"), ",".join(cols) + "\nm1,1.1.15100.1,0,200,1,1.0,17134,1\nm2,,1,-5,2,,1,0\n")
    df = files.read_typed_csv(spark, path, files.machine_schema(cols))
    types = dict(df.dtypes)
    assert types["IsBeta"] == "tinyint" and types["LocaleEnglishNameIdentifier"] == "smallint"
    assert types["AVProductsInstalled"] == "float" and types["Census_OSBuildRevision"] == "int"
    rows = df.orderBy("MachineIdentifier").collect()
    assert rows[0].LocaleEnglishNameIdentifier == 200 and rows[1].EngineVersion is None
    s = _write(os.path.join(d, "s.csv"), "MachineIdentifier,HasDetections\nm1,0.3\nm2,\n")
    sc = files.read_score_file(spark, s, "id", "score_1").orderBy("id").collect()
    assert [(r.id, r.score_1) for r in sc] == [("m1", 0.3), ("m2", None)]


def test_lookup_and_prediction_sink(spark):
    d = tempfile.mkdtemp(prefix="tessera-lookup-")
    spark.createDataFrame([("1.2", "2018-08-29 00:00:00")], "version string, ts string").write.parquet(os.path.join(d, "lk"))
    lk = files.read_lookup(spark, os.path.join(d, "lk"))
    assert dict(lk.dtypes)["ts"] == "timestamp"
    preds = spark.createDataFrame([("a", 0.1), ("b", 0.9)], "id string, label double")
    out = os.path.join(d, "pred")
    sinks.write_prediction_csv(preds, out, compression="gzip")
    gz = [f for f in os.listdir(out) if f.endswith(".gz")]
    text = "".join(gzip.open(os.path.join(out, f), "rt").read() for f in gz)
    assert "id,label" in text and "b,0.9" in text


def test_image_folder_labels_and_template(spark):
    d = tempfile.mkdtemp(prefix="tessera-img-")
    for name in ["a1.tif", "b2.tif", "c3.x.tif", "skip.png"]:
        with open(os.path.join(d, name), "wb") as f:
            f.write(b"\x00\x01")
    imgs = files.read_image_folder(spark, d, suffix=".tif")
    assert sorted(r.id for r in imgs.collect()) == ["a1", "b2", "c3"]
    labels = spark.createDataFrame([("a1", 1), ("c3", 0), ("zz", 1)], "id string, label int")
    joined = label_files(imgs, labels)
    assert sorted(r.id for r in joined.collect()) == ["a1", "c3"]
    tpl = _write(os.path.join(d, "sample.csv"), "id,label\nc3,0\na1,0\nb2,0\n")
    template = files.read_id_template(spark, tpl).drop("label")
    preds = spark.createDataFrame([("a1", 0.7), ("c3", 0.2), ("q", 0.5)], "id string, label double")
    out = align_to_template(template, preds, "id", order_col="pos").collect()
    assert [(r.id, r.label) for r in out] == [("c3", 0.2), ("a1", 0.7), ("b2", None)]


def test_columns_of_type_and_profile(spark):
    from pyspark.sql import types as T

    from tessera.operators import tabular as TB

    df = spark.createDataFrame([("a", 1, None), (None, 2, 3.0)], "s string, i int, d double")
    assert TB.columns_of_type(df, T.StringType) == ["s"]
    prof = {r.column_name: (r.data_type, r.non_null, r.n_rows) for r in TB.column_profile(df).collect()}
    assert prof == {"s": ("string", 1, 2), "i": ("int", 2, 2), "d": ("double", 1, 2)}


def test_archive_keeps_carriage_returns(spark):
    d = tempfile.mkdtemp(prefix="tessera-arch-")
    raw = b"a,b\r\nc,d\n\r\n\xc3\xa9\n"
    with open(os.path.join(d, "raw.csv"), "wb") as f:
        f.write(raw)
    out = sinks.archive_raw(spark, os.path.join(d, "raw.csv"), os.path.join(d, "arch"), "2018-02-02")
    parts = sorted(p for p in os.listdir(out) if p.endswith(".gz"))
    assert b"".join(gzip.open(os.path.join(out, p)).read() for p in parts) == raw
