"""Whole jobs over files: write, read back (sinks SNK1-SNK6)."""

import gzip
import os
import tempfile

from tessera.plans import flights as A
from tessera.plans import mail as B
from tessera.plans import standins as D

SF = "/root/testdata/sf0.001"


def test_flight_job_writes_six_outputs(spark):
    out = tempfile.mkdtemp(prefix="tessera-flights-")
    paths = A.run_job(D.weather_lines(spark, SF), D.flight_lines(spark, SF), out)
    assert len(paths) == 6
    full = spark.read.parquet(paths["flights_full_details"])
    assert full.count() == D.flight_rows(spark, SF).count()
    assert full.where("temperature IS NULL").count() == 0


def test_mail_job_from_csv(spark):
    src_dir = tempfile.mkdtemp(prefix="tessera-mail-src-")
    path = os.path.join(src_dir, "mail-20180202.csv")
    with open(path, "w") as f:
        f.write('1517356800000,<a@x>,Alice@X,Bob@X|carol@x|BOB@x,,mail\n')
        f.write('1517356800123,<b@x>,bob@x,,,mail\n')
        f.write('1517356801001,"<c,1@x>",carol@x,alice@x,topic,mail\n')
    out = tempfile.mkdtemp(prefix="tessera-mail-out-")
    res = B.run_job(spark, path, out, run_date="2018-02-02")
    recs = spark.read.json(res["processed"]).orderBy("row_number").collect()
    assert [r.row_number for r in recs] == [1, 2, 3]
    assert recs[0]["recipients"] == ["bob@x", "carol@x", "bob@x"]
    assert recs[0]["timestamp_iso"] == "2018-01-31T00:00:00"
    assert recs[1]["timestamp_iso"] == "2018-01-31T00:00:00.123000"
    assert recs[1]["recipients"] == [""]
    assert recs[2]["message identifier"] == "<c,1@x>"
    st = spark.read.option("header", True).csv(res["stats"])
    assert st.columns == ["User", " Received_Emails", " Sended_Emails"]
    stats = {r[0]: (r[1], r[2]) for r in st.collect()}
    assert stats == {"alice@x": ("1", "1"), "bob@x": ("2", "1"), "carol@x": ("1", "1")}
    assert res["archive"].endswith("-processed-20180202")
    gz = [f for f in os.listdir(res["archive"]) if f.endswith(".gz")]
    with gzip.open(os.path.join(res["archive"], gz[0]), "rt") as fh:
        assert fh.read().count("\n") == 3


def test_flight_job_legacy_text(spark):
    out = tempfile.mkdtemp(prefix="tessera-flights-text-")
    paths = A.run_job(D.weather_lines(spark, SF), D.flight_lines(spark, SF), out, legacy_text=True, legacy_text_max=True)
    daily = spark.read.text(paths["airlines_day_max_temperature"]).collect()
    assert daily and all(len(r.value.split(", ")) == 3 for r in daily)
    details = spark.read.text(paths["flights_full_details"]).collect()
    assert any(r.value.endswith(",9999") for r in details)
    assert all(len(r.value.split(",")) == 9 for r in details)  # eight fields and the reading
    assert any(r.value.split(",")[-1].count(".") == 1 and len(r.value.split(",")[-1].split(".")[1]) == 2 for r in details)

    flights = spark.read.text(paths["airlines_number_flights"]).collect()
    assert sum(int(r.value.split(", ")[1]) for r in flights) == D.flight_rows(spark, SF).count()
