"""The archive of raw files: gunzip gives the source's bytes."""

import gzip
import os

import pytest

from tessera.sources import sinks

FILES = {
    "crlf.csv": b"a,b\r\nc,d\r\n",
    "no end.csv": b"1\n2\n3",
    "bytes=ß.bin": bytes(range(256)) * 40 + b"\xff\xfe\n\n\n\x00\x00",
    "empty.csv": b"",
    "newline.csv": b"\n",
    "long.csv": b"".join(b"line %d\n" % i for i in range(30_000)) + b"tail",
    "one.csv": b"x" * 100_000,
}


@pytest.mark.parametrize("member,split", [(8 << 20, "128m"), (1000, "4k")])
def test_every_file_comes_back(spark, tmp_path, monkeypatch, member, split):
    monkeypatch.setattr(sinks, "MEMBER", member)
    src = tmp_path / "raw"
    os.makedirs(src)
    for name, data in FILES.items():
        (src / name).write_bytes(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for _ in range(2):  # a rerun writes the same place
            target = sinks.archive_raw(spark, str(src), str(tmp_path / "arch"), "2018-02-02")
            assert target.endswith("/raw-processed-20180202")
            assert sorted(f for f in os.listdir(target) if f[0] not in "._") == sorted(f"{n}-processed-20180202.gz" for n in FILES)
            for name, data in FILES.items():
                with open(f"{target}/{name}-processed-20180202.gz", "rb") as f:
                    assert gzip.decompress(f.read()) == data, name
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_file_and_clashing_names(spark, tmp_path):
    for d in ("a", "b"):
        os.makedirs(tmp_path / "raw" / d)
        (tmp_path / "raw" / d / "x.csv").write_bytes(b"1\r\n")
    target = sinks.archive_raw(spark, str(tmp_path / "raw" / "a" / "x.csv"), str(tmp_path / "arch"), "2018-02-02")
    with gzip.open(f"{target}/x.csv-processed-20180202.gz") as f:
        assert f.read() == b"1\r\n"
    with pytest.raises(ValueError):
        sinks.archive_raw(spark, str(tmp_path / "raw"), str(tmp_path / "arch"), "2018-02-02")
