"""Token counts through a digest cache.

The cache holds (digest, version, n_tokens): the sha256 of the normalised content and the
digest of the tokenizer's file and library version. Documents are joined to it by both;
only distinct contents without a stored count are encoded, once each, and appended.

Contents meet by digest: a task first drops the repeats it has itself, so a text held by a
third of all rows is sent once a task, and after the exchange each digest is encoded once.
Rows then get their counts by digest; digests of many rows get them in place, from a
broadcast of bounded size.
Normalising turns null into empty and nothing else, since anything more would change
tokens.

Defined cases: null and empty texts have 0 bytes and 0 tokens; special strings inside
texts are handled as the tokenizer's default does; repeated rows come back as often as
they went in; an empty table gives no rows. Counts that two runs appended for one digest
are equal and read as one. Only the id and the text are read; the result has its own
columns. Without ``cache`` a new folder below the shared checkpoint folder is used, so
every distinct text is encoded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, grouped_by_bytes, join_unique, run_folder, written
from tessera.llm.packing import encoder

OVER = 512
_CACHE = "digest binary, version string, n_tokens long"


def tokenizer_json(path: str) -> tuple[str, str]:
    """The tokenizer's file and its version: digest of the file and of the library's version."""
    import tokenizers

    with open(path, encoding="utf-8") as f:
        text = f.read()
    return text, hashlib.sha256(f"{tokenizers.__version__}\n{text}".encode()).hexdigest()


def stored(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Counts of this version, one row a digest; empty if the folder does not exist yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    rows = spark.read.schema(_CACHE).parquet(cache).where(F.col("version") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for d in batch.column(0).to_pylist():
            keep.append(d not in seen)
            seen.add(d)
        yield batch.filter(pa.array(keep, pa.bool_()))


def encode_misses(contents: DataFrame, known: DataFrame, tokenizer: str, version: str) -> DataFrame:
    """(digest, version, n_tokens) of the distinct contents that ``known`` lacks."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer)
        for batch in _once(batches):
            digests, texts, counts = batch.column(0), batch.column(1).to_pylist(), []
            for part in grouped_by_bytes(texts, 256, 1 << 20):
                counts += [len(ids) for ids in tokens(texts[part])]
            yield pa.RecordBatch.from_arrays([digests, pa.array([version] * len(counts)), pa.array(counts, pa.int64())], ["digest", "version", "n_tokens"])

    local = contents.mapInArrow(_once, "digest binary, text string")
    missing = local.join(known.select("digest"), "digest", "left_anti")
    return missing.repartition("digest").mapInArrow(encode, _CACHE)


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: str | None = None, text: str = "text", doc_id: str = "doc_id", over: int = OVER) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row; appends to the cache."""
    spark = docs.sparkSession
    bounded_batches(spark)
    tokenizer, version = tokenizer_json(tokenizer_path)
    cache = cache or run_folder(spark, "token-counts")
    content = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.col(doc_id).alias("doc_id"), content.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    encode_misses(keyed.select("digest", "text"), stored(spark, cache, version), tokenizer, version).write.mode("append").parquet(cache)
    narrow = written(keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "token-digests")
    counted = join_unique(narrow, stored(spark, cache, version), ["digest"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > over).alias("over_limit"))
