"""A corpus pipeline over ``documents``: language ID, toxicity, near-duplicate removal,
benchmark decontamination, mixing to target weights.

Each stage gets what its predecessor kept, as Parquet, and all but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontamination, jaccard_join, language_id, mixing, toxicity
from tessera.llm.common import fresh, load, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is decided: neither undetermined (null texts and texts without
    a letter among them) nor ambiguous. Repeated rows are judged alike; rows without an id are
    judged, but nothing is learnt from them."""
    guessed, name = language_id.predict(docs, language_id.fit(docs))
    return guessed.where((F.col(f"{name}.lang") != language_id.UNDECIDED) & ~F.col(f"{name}.ambiguous")).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half. Null and empty texts have the score of a text
    without any known word, which is below; repeated rows are judged alike and all stay or go;
    rows without an id are judged, but nothing is learnt from them."""
    scored, name = toxicity.score(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))
    return scored.where(F.col(name) < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8): the one
    with the smallest id. Rows of one id are one document, of which the row with the smallest
    digest of its text stays (of equal texts the smallest row); rows without an id stay."""
    groups = jaccard_join.jaccard_groups(docs, k=5, num=80, den=100)
    going = groups.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    named, rest = docs.where(F.col("doc_id").isNotNull()), [c for c in docs.columns if c != "doc_id"]
    # Ids are compared without their texts; few are held by several rows, if any.
    again = written(named.groupBy("doc_id").count().where("count > 1").select("doc_id").join(going, "doc_id", "left_anti"), "repeated-ids")
    kept = named.join(going.union(again), "doc_id", "left_anti")
    first = F.min(F.struct(F.md5("text"), *[F.col(f"`{c}`") for c in rest])).alias("first")
    one = named.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(first).select("doc_id", *[F.col(f"first.`{c}`").alias(c) for c in rest])
    return kept.select(*docs.columns).unionByName(one).unionByName(docs.where(F.col("doc_id").isNull()))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, verbatim or with replaced slots. Rows without
    an id are judged one by one, under a hash of their text."""
    benchmark, key = load(spark, sf_dir, "benchmark"), fresh(docs.columns, "text_key")
    named, bare = docs.where(F.col("doc_id").isNotNull()), docs.where(F.col("doc_id").isNull()).withColumn(key, F.xxhash64("text"))
    going = decontamination.contaminated(named, benchmark).select("doc_id").distinct()
    gone = decontamination.contaminated(bare, benchmark, doc_id=key).select(F.col("doc_id").alias(key)).distinct()
    kept = named.join(going, "doc_id", "left_anti").select(*docs.columns)
    return kept.unionByName(bare.join(gone, key, "left_anti").select(*docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies by source rate, shuffled; the copy's number and shuffle key are added. A null
    source is a source, null texts count no characters, repeated rows of one id get equal
    counts, and rows without an id draw each for itself."""
    return mixing.replicate(docs, F.length("text"))[0]


STAGES = [
    ("language ID", identify_language),
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]

#: The first two stages are trained classifiers, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written and read again."""
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
