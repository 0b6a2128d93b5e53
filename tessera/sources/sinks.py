"""SNK1-SNK8: writers. All are distributed writes (one file per task, never per row, but for
``write_key_files``, which makes the many files that SRC10 reads)."""

from __future__ import annotations

import gzip
import itertools
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_text_lines(df: DataFrame, path: str, compression: str | None = None) -> None:
    """SNK1: single text column ``value``, sharded."""
    w = df.select("value").write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def write_key_files(df: DataFrame, path: str, key: str, name: str) -> None:
    """A folder ``<key>=<value>`` for each value of a whole-number column (or null), named as
    Spark's partitioned writers name it, with one file ``name``: the texts or bytes of the
    key's rows (column ``value``), each ended by ``\\n``.

    For many small files: the tasks write them through Arrow's file systems. Spark's writer goes
    through Hadoop's, whose local one starts processes to set the rights of a folder or file
    where Hadoop's native library is missing. A file gets its name when it is whole, so a task that
    runs twice leaves one whole file; Spark's readers pass over names that begin with a dot.
    """
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toUri().toString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pyarrow.fs.FileSystem.from_uri(uri)
        rows = (row for b in batches for row in zip(b.column(key).to_pylist(), b.column("value")))
        written = 0
        for value, group in itertools.groupby(rows, key=lambda row: row[0]):
            home = f"{root}/{key}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
            part, whole = f"{home}/.{name}-{uuid.uuid4().hex}", f"{home}/{name}"
            files.create_dir(home)
            with files.open_output_stream(part, compression=None) as out:
                for _, data in group:
                    if data.is_valid:
                        out.write(data.as_buffer())
                    out.write(b"\n")
            try:
                files.move(part, whole)
            except OSError:  # some file systems replace no file: the one there is whole
                if files.get_file_info(whole).type != pyarrow.fs.FileType.File:
                    raise
                files.delete_file(part)
            written += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([written], pa.int64())})

    rows = df.select(key, F.col("value").cast("binary").alias("value"))
    rows.repartition(key).sortWithinPartitions(key).mapInArrow(write, "files long").write.format("noop").mode("overwrite").save()


def write_json_records(df: DataFrame, path: str) -> None:
    """SNK2: JSON lines, one object per record (the record carries source file and row number)."""
    df.write.mode("overwrite").json(path)


def _file_sizes(spark: SparkSession, src: str) -> dict[str, int]:
    """Names and sizes of the files at or below a path (Spark's readers skip empty ones)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(src)
    found, sizes = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True), {}
    while found.hasNext():
        file = found.next()
        name = file.getPath().getName()
        if name[0] in "._":
            continue
        if name in sizes:
            raise ValueError(f"files named {name} in several folders below {src}")
        sizes[name] = file.getLen()
    return sizes


#: Bytes of a gzip member; below 2^24, so that the member's last byte, the high byte of its
#: length, is zero.
MEMBER = 8 << 20


def archive_raw(spark: SparkSession, src: str, archive_dir: str, run_date: str) -> str:
    """SNK3: a gzip archive of each raw file, ``<file>-processed-<yyyyMMdd>.gz``, in the folder
    ``<name>-processed-<yyyyMMdd>``; gunzip gives the file's bytes, whatever they are.

    ``run_date`` is a parameter (``yyyy-MM-dd``) so that reruns write the same place. The
    files are read in splits, as bytes between ``\\n``, and put in order by file, split and
    line; a task then writes its files one after another, a member of at most 8 MB at a time.
    A member ends in a zero byte, which is the line separator of Spark's text writer, so each
    member is one line of the file. An empty file gives an empty archive. Files of one name
    in several folders raise an error.
    """
    name, stamp = src.rstrip("/").split("/")[-1], run_date.replace("-", "")
    target = f"{archive_dir.rstrip('/')}/{name}-processed-{stamp}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    sizes = _file_sizes(spark, src)
    rows = spark.read.options(lineSep="\n", recursiveFileLookup=True).text(src)
    named = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))  # Spark gives it as part of a URI
    place = [named.alias("name"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")]
    lines = rows.select(*place, F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("bytes"))
    ordered = lines.repartition("name").sortWithinPartitions("name", "block", "line")
    most = MEMBER

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, size, seen, number = None, 0, 0, 0
        held: list[bytes] = []
        waiting = 0

        def packed(data: bytes) -> pa.RecordBatch:
            nonlocal number
            number += 1
            return pa.RecordBatch.from_pydict({"name": [file], "number": [number], "member": [gzip.compress(data, mtime=0)[:-1]]})

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            data = b"".join(held)
            if last and seen == size + 1:  # the last line has no end
                data = data[:-1]
            for at in range(0, len(data), most):
                yield packed(data[at : at + most])

        for batch in batches:
            for n, s, b in zip(batch.column("name").to_pylist(), batch.column("size").to_pylist(), batch.column("bytes").to_pylist()):
                if n != file:
                    if file is not None:
                        yield from flush(True)
                    file, size, seen, number, held, waiting = n, s, 0, 0, [], 0
                if waiting >= most:
                    yield from flush(False)
                    held, waiting = [], 0
                held.append(b + b"\n")
                seen += len(b) + 1
                waiting += len(b) + 1
        if file is not None:
            yield from flush(True)

    stream = ordered.mapInArrow(members, "name string, number long, member binary")
    nothing = gzip.compress(b"", mtime=0)[:-1]
    empty = spark.createDataFrame([(n, 1, nothing) for n, size in sizes.items() if size == 0], "name string, number long, member binary")
    staged = f"{target}/_members"
    out = stream.unionByName(empty).sortWithinPartitions("name", "number").select("name", F.col("member").cast("string").alias("value"))
    out.write.mode("overwrite").option("lineSep", "\0").partitionBy("name").text(staged)
    for folder in fs.listStatus(path(staged)):  # names only: the driver moves no bytes
        if not folder.isDirectory():
            continue
        file = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder.getPath().getName().removeprefix("name="))
        archive = path(f"{target}/{file}-processed-{stamp}.gz")
        (part,) = [p.getPath() for p in fs.listStatus(folder.getPath()) if p.getPath().getName().startswith("part-")]
        fs.delete(archive, False)
        if not fs.rename(part, archive):
            raise OSError(f"{part} could not be moved to {archive}")
    fs.delete(path(staged), True)
    return target


# Fixed value: the statistics header, spaces included.
STATS_HEADER = ("User", " Received_Emails", " Sended_Emails")


def write_stats_csv(df: DataFrame, path: str) -> None:
    """SNK4: statistics CSV with header ``User, Received_Emails, Sended_Emails``, sorted by
    user (range-partitioned sort: part files are in user order). The CSV writer quotes and
    escapes users that need it (the original wrapped them in quotes without escaping)."""
    out = df.select(
        F.col("user").alias(STATS_HEADER[0]),
        F.col("received").alias(STATS_HEADER[1]),
        F.col("sent").alias(STATS_HEADER[2]),
    ).orderBy(STATS_HEADER[0])
    out.write.mode("overwrite").options(header=True, quoteAll=False, escape='"', ignoreLeadingWhiteSpace=False).csv(path)


def write_prediction_csv(df: DataFrame, path: str, id_col: str = "id", label_col: str = "label", compression: str | None = None) -> None:
    """SNK5 (+SNK8 with ``compression='gzip'``): ``id,label`` CSV with header."""
    w = df.select(id_col, label_col).write.mode("overwrite").option("header", True)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def write_columnar(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """SNK6: Parquet."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
