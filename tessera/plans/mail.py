"""Family B: mail event ETL.

  CSV rows -> typed mail records (JSON sink, one object per record)
           -> sent per user, received per user (explode), left join from senders
           -> connection weights per (sender, recipient)
  raw file -> gzip archive under a dated name

Every step is a narrow projection or a grouped aggregate with map-side combine, so a
user that sends or receives a third of all mail costs one partial aggregate per task
and one merge, never a group held in one task.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators.cumulative import with_position
from tessera.sources import files, sinks

# Fixed value: the attribute name carried by each record.
RECIPIENT_COUNT_ATTRIBUTE = "number_of_recipients"
MESSAGE_ID_FIELD = "message identifier"


def parse_records(rows: DataFrame) -> DataFrame:
    """SC8-SC12: build the record columns from the six text fields.

    ``rows`` has ``epoch_ms, message_id, sender, recipients, topic, mode`` and may carry
    ``source_file`` and ``row_number`` (kept for the JSON sink and the stable id).
    """
    extra = [c for c in ("source_file", "row_number") if c in rows.columns]
    recips = S.recipients_of("recipients")
    # The parsed epoch is materialised first: the ISO rendering reads it several times.
    rows = rows.withColumn("_ms", S.parse_int("epoch_ms"))
    out = rows.select(
        S.epoch_ms_to_iso("_ms").alias("timestamp_iso"),
        F.col("message_id").alias(MESSAGE_ID_FIELD),
        F.lower("sender").alias("sender"),
        recips.alias("recipients"),
        F.array(
            F.struct(
                F.lit(RECIPIENT_COUNT_ATTRIBUTE).alias("name"),
                F.size(S.split_pipe("recipients")).alias("value"),
            )
        ).alias("attributes"),
        F.col("topic"),
        F.col("mode").alias("email"),
        *extra,
    )
    if "source_file" in extra and "row_number" in extra:
        out = out.withColumn("unique_id", S.stable_id("source_file", "row_number"))
    return out


def number_rows(rows: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Q6 fix: 1..n per source file in file order (distributed prefix count)."""
    tagged = rows.withColumn("_seq", F.monotonically_increasing_id())
    numbered = with_position(tagged, ["_seq"], name="row_number", group_cols=[file_col])
    return numbered.withColumn("row_number", F.col("row_number") + 1).drop("_seq")


def sent_counts(records: DataFrame) -> DataFrame:
    """A7."""
    return records.groupBy(F.col("sender").alias("user")).agg(F.count(F.lit(1)).alias("sent"))


def received_counts(records: DataFrame) -> DataFrame:
    """One count per listed recipient, repeats included."""
    return (
        records.select(F.explode("recipients").alias("user"))
        .groupBy("user")
        .agg(F.count(F.lit(1)).alias("received"))
    )


def user_stats(records: DataFrame, include_receivers: bool = False) -> DataFrame:
    """Statistics per user in one aggregate.

    Each record contributes ``(sender, sent=1)`` and ``(recipient, received=1)`` per
    listed recipient; one ``groupBy(user)`` with map-side partial sums gives both
    counters (one shuffle instead of two aggregates and a join). By default only users
    who sent are listed (as the original); ``include_receivers`` keeps everyone.
    """
    contrib = records.select(
        F.explode(
            F.concat(
                F.array(F.struct(F.col("sender").alias("user"), F.lit(1).alias("s"), F.lit(0).alias("r"))),
                F.transform("recipients", lambda u: F.struct(u.alias("user"), F.lit(0).alias("s"), F.lit(1).alias("r"))),
            )
        ).alias("c")
    )
    stats = contrib.groupBy(F.col("c.user").alias("user")).agg(
        F.sum("c.r").cast("bigint").alias("received"), F.sum("c.s").cast("bigint").alias("sent")
    )
    return stats if include_receivers else stats.where(F.col("sent") > 0)


def edges(records: DataFrame, last_only: bool = False) -> DataFrame:
    """Connection weights. All recipients by default; ``last_only`` counts only the
    last recipient of each record (the original's counter sat after its loop)."""
    if last_only:
        pairs = records.select(F.col("sender").alias("src"), F.element_at("recipients", -1).alias("dst"))
    else:
        pairs = records.select(F.col("sender").alias("src"), F.explode("recipients").alias("dst"))
    return pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))


def run_job(
    spark: SparkSession, path: str, out_dir: str, run_date: str, last_only_edges: bool = False, multi_line: bool = False
) -> dict:
    """Whole job: records (JSON), statistics CSV, edges (Parquet), archive (gzip).

    The parsed records feed three writes, so they are persisted once."""
    rows = number_rows(files.read_mail_csv(spark, path, multi_line))
    records = parse_records(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sinks.write_json_records(records, f"{out_dir}/processed")
        sinks.write_stats_csv(user_stats(records), f"{out_dir}/stats")
        sinks.write_columnar(edges(records, last_only_edges), f"{out_dir}/edges")
    finally:
        records.unpersist()
    archived = sinks.archive_raw(spark, path, f"{out_dir}/archive", run_date)
    return {"processed": f"{out_dir}/processed", "stats": f"{out_dir}/stats", "edges": f"{out_dir}/edges", "archive": archived}
