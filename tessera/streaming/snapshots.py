"""Tables that micro-batches extend: a snapshot, deltas behind it, and an index of keys.

``Snapshots`` keeps a folder a batch (a delta) and, every ``every`` batches, merges the last
snapshot and the deltas behind it into a new snapshot. A snapshot counts from the moment its
job has committed (Spark's success marker is the pointer), under the number of the last
batch it holds. A reader needs the newest snapshot and the deltas behind it, ``every``
folders at most, however many batches there were. What a snapshot has merged is retired one
snapshot later, so that a batch which is replayed after a crash, its own compaction included,
still finds all it read the first time.

``KeyIndex`` holds known keys in hash buckets, as many as keep a bucket near
``bucket_keys``: a batch reads the buckets its own keys fall into, and the few deltas that
are not merged yet. More batches make more buckets, not larger ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path that a finished job has written."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    done = lambda p: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory() and done(s.getPath()))


def remove_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Snapshots:
    """Rows by batch under ``base``; ``merge`` turns the rows of several batches (with their
    number in ``batch``) into those that still count."""

    def __init__(self, spark: SparkSession, base: str, schema: StructType, merge: Callable[[DataFrame], DataFrame], every: int = 16):
        self.spark, self.base, self.schema, self.merge, self.every = spark, base.rstrip("/"), schema, merge, every

    def _numbers(self, kind: str) -> list[int]:
        return [int(n) for n in _children(self.spark, f"{self.base}/{kind}")]

    def folders(self, before: int | None = None) -> list[tuple[str, int]]:
        """(kind, number) of the folders that hold the state, of batches before ``before``."""
        held = lambda n: before is None or n < before
        snapshots = [n for n in self._numbers("snapshot") if held(n)]
        newest = max(snapshots, default=None)
        deltas = [("delta", n) for n in self._numbers("delta") if held(n) and (newest is None or n > newest)]
        return [*([("snapshot", newest)] if newest is not None else []), *deltas]

    def path(self, kind: str, number: int) -> str:
        return f"{self.base}/{kind}/{number:012d}"

    def _rows(self, folders: list[tuple[str, int]]) -> DataFrame:
        out = self.spark.createDataFrame([], self.schema).withColumn("batch", F.lit(0).cast("long"))
        for kind, n in folders:
            out = out.unionByName(self.spark.read.schema(self.schema).parquet(self.path(kind, n)).withColumn("batch", F.lit(n).cast("long")))
        return out

    def read(self, before: int | None = None) -> DataFrame:
        """The rows that count, of all batches or of those before one."""
        return self.merge(self._rows(self.folders(before)))

    def write(self, batch: DataFrame, number: int) -> None:
        """The delta of a batch; a replayed batch writes its own again."""
        batch.select(*self.schema.names).write.mode("overwrite").parquet(self.path("delta", number))
        if (number + 1) % self.every == 0:
            self.compact(number)

    def compact(self, number: int) -> None:
        """Merge all batches up to ``number`` and retire what the snapshot before has merged."""
        older = [n for n in self._numbers("snapshot") if n < number]
        folders = [*self.folders(before=number), ("delta", number)]
        self.merge(self._rows(folders)).select(*self.schema.names).write.mode("overwrite").parquet(self.path("snapshot", number))
        if older:
            for kind, n in [("snapshot", n) for n in older[:-1]] + [("delta", n) for n in self._numbers("delta") if n <= older[-1]]:
                remove_folder(self.spark, self.path(kind, n))


class KeyIndex:
    """Known values of ``key`` (of the type in ``schema``) under ``base``."""

    #: Buckets named in one partition filter; a batch that touches more reads them all.
    MOST_NAMED = 4096

    def __init__(self, spark: SparkSession, base: str, schema: StructType, every: int = 16, bucket_keys: int = 1 << 20):
        self.key = schema.names[0]
        self.spark, self.base, self.schema, self.bucket_keys, self.every = spark, base.rstrip("/"), schema, bucket_keys, every

    def _bucket(self, depth: int) -> Column:
        return F.pmod(F.xxhash64(f"`{self.key}`"), F.lit(1 << depth))

    def _put(self, keys: DataFrame, path: str) -> None:
        """Distinct keys in as many buckets as keep them near ``bucket_keys`` (one count)."""
        depth = max(0, (max(1, keys.count()) - 1).bit_length() - (self.bucket_keys - 1).bit_length())
        bucketed = keys.withColumn("depth", F.lit(depth)).withColumn("bucket", self._bucket(depth))
        bucketed.repartition("bucket").write.mode("overwrite").partitionBy("depth", "bucket").parquet(path)

    def _depth(self, path: str) -> int:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        names = [s.getPath().getName() for s in target.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(target)]
        return max((int(n.split("=")[1]) for n in names if n.startswith("depth=")), default=0)

    def _get(self, path: str, batch: DataFrame | None) -> DataFrame:
        """Keys of a table of buckets: all, or those of the buckets that ``batch`` touches."""
        table = self.spark.read.schema(StructType([*self.schema.fields, StructField("depth", IntegerType()), StructField("bucket", LongType())])).parquet(path)
        depth = self._depth(path)
        if batch is not None and depth:
            touched = [r[0] for r in batch.select(self._bucket(depth).alias("b")).distinct().limit(self.MOST_NAMED + 1).collect()]
            if len(touched) <= self.MOST_NAMED:
                table = table.where(F.col("bucket").isin(touched))
        return table.select(self.key)

    def put_static(self, keys: DataFrame, name: str) -> None:
        """Keys of a table outside, written once a run."""
        self._put(keys.select(self.key).distinct(), f"{self.base}/{name}")

    def _merged(self, before: int) -> int | None:
        return max((int(n) for n in _children(self.spark, f"{self.base}/merged") if int(n) < before), default=None)

    def known(self, batch: DataFrame, number: int, static: str | None = None) -> DataFrame:
        """Keys known before batch ``number``, of the buckets that its keys fall into."""
        newest = self._merged(number)
        out = self.spark.createDataFrame([], self.schema)
        if static:
            out = out.union(self._get(f"{self.base}/{static}", batch))
        if newest is not None:
            out = out.union(self._get(f"{self.base}/merged/{newest:012d}", batch))
        for n in (int(n) for n in _children(self.spark, f"{self.base}/delta")):
            if n < number and (newest is None or n > newest):
                out = out.union(self.spark.read.schema(self.schema).parquet(f"{self.base}/delta/{n:012d}"))
        return out

    def add(self, keys: DataFrame, number: int) -> None:
        """The keys of a batch; every ``every`` batches all are dealt to buckets anew."""
        keys.select(self.key).write.mode("overwrite").parquet(f"{self.base}/delta/{number:012d}")
        if (number + 1) % self.every:
            return
        newest, deltas = self._merged(number), [int(n) for n in _children(self.spark, f"{self.base}/delta")]
        everything = self.spark.read.schema(self.schema).parquet(*[f"{self.base}/delta/{n:012d}" for n in deltas if n <= number and (newest is None or n > newest)])
        if newest is not None:
            everything = everything.union(self._get(f"{self.base}/merged/{newest:012d}", None))
        self._put(everything.distinct(), f"{self.base}/merged/{number:012d}")
        if newest is not None:
            for n in deltas:
                if n <= newest:
                    remove_folder(self.spark, f"{self.base}/delta/{n:012d}")
            for n in _children(self.spark, f"{self.base}/merged"):
                if int(n) < newest:
                    remove_folder(self.spark, f"{self.base}/merged/{n}")
