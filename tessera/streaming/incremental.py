"""ST1, ST2: incremental forms of the copy job and the mail statistics.

Both read a file stream with ``trigger(availableNow=True)`` and write through
``foreachBatch`` keyed by the batch id, so a retried batch overwrites its own output
instead of appending twice. State and outputs live under the session's checkpoint
folder (``spark.checkpoint.dir``), never on a machine-local path.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.session import checkpoint_dir, path_exists
from tessera.streaming.snapshots import KeyIndex, Snapshots, remove_folder


def _run_dir(spark: SparkSession, name: str, base_dir: str | None = None) -> str:
    """``base_dir`` when given (a stable location: a rerun resumes from its checkpoint and
    processes only new files), else a fresh folder under the shared checkpoint folder."""
    if base_dir:
        return base_dir.rstrip("/")
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def create_only_stream(
    spark: SparkSession,
    stream: DataFrame,
    destination: DataFrame,
    key: str = "_id",
    event_time: str = "@timestamp",
    base_dir: str | None = None,
    every: int = 16,
    bucket_keys: int = 1 << 20,
) -> DataFrame:
    """ST1: documents neither in ``destination`` nor copied by an earlier batch, appended
    batch by batch; of several rows with one ``key`` in a batch the earliest by
    ``event_time`` is taken (equal times: any one). However late or far apart, each key is
    copied once and none is lost. Returns every row appended so far under ``base_dir``.

    Known keys lie in a bucketed index: the destination's are dealt to buckets once a run,
    copied ones every ``every`` batches, and a batch reads its own buckets only. A batch is
    written down first, so that ranking and anti join see keys, times and row numbers alone
    and the payload of the winners is fetched by one join."""
    base = _run_dir(spark, "create-only", base_dir)
    out, run = f"{base}/out", f"destination-{uuid.uuid4().hex[:12]}"
    index = KeyIndex(spark, f"{base}/keys", stream.select(key).schema, every, bucket_keys)
    index.put_static(destination.select(key), run)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        landed = f"{base}/landed/{batch_id}"
        batch.withColumn("_row", F.monotonically_increasing_id()).write.mode("overwrite").parquet(landed)
        rows = spark.read.parquet(landed)
        time = F.col(f"`{event_time}`")
        first = rows.groupBy(key).agg(F.min(F.struct(time.isNull().alias("late"), time.alias("at"), F.col("_row").alias("row"))).alias("_first"))
        known = index.known(rows.select(key), batch_id, run)
        winners = first.where(F.col(key).isNotNull()).join(known, on=key, how="left_anti").unionByName(first.where(F.col(key).isNull()))
        winners = winners.select(F.col("_first.row").alias("_row"))
        rows.join(winners, "_row", "left_semi").drop("_row").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        index.add(spark.read.parquet(f"{out}/batch={batch_id}").select(key), batch_id)
        remove_folder(spark, f"{base}/landed/{batch_id - 1}")

    q = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", f"{base}/state")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    remove_folder(spark, f"{base}/keys/{run}")
    if not path_exists(spark, out):  # no batch yet
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(StructType([*stream.schema.fields, StructField("batch", LongType())])).parquet(out).drop("batch")


def _running_totals(spark: SparkSession, totals: DataFrame, keys: list[str], base: str, every: int = 16) -> DataFrame:
    """Runs a streaming aggregate in update mode: each micro-batch writes only the keys it
    changed, with their new totals, as a delta of its own, so a replayed batch rewrites just
    that. The current total of a key is the one of its latest batch; every ``every`` batches
    the deltas are merged into a snapshot of current totals."""
    values = [c for c in totals.columns if c not in keys]

    def current(rows: DataFrame) -> DataFrame:
        latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("now"))
        return latest.select(*keys, "now.*")

    table = Snapshots(spark, f"{base}/totals", totals.schema, current, every)
    q = (
        totals.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: table.write(batch, batch_id))
        .option("checkpointLocation", f"{base}/state")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return table.read()


def mail_stats_stream(
    spark: SparkSession, records_stream: DataFrame, include_receivers: bool = False, base_dir: str | None = None, every: int = 16
) -> DataFrame:
    """ST2: running per-user totals kept in Spark's state store.

    Each record contributes (sender, sent=1) and (recipient, received=1); a streaming
    ``groupBy(user)`` keeps one state row per user (bounded by the number of users, not
    by the number of mails), checkpointed under the shared folder. Returns ``user,
    received, sent``.
    """
    from tessera.plans.mail import user_stats

    totals = user_stats(records_stream, include_receivers=True)
    result = _running_totals(spark, totals, ["user"], _run_dir(spark, "mail-stats", base_dir), every)
    if not include_receivers:
        result = result.where(F.col("sent") > 0)
    return result.select("user", "received", "sent")


def mail_edges_stream(
    spark: SparkSession, records_stream: DataFrame, last_only: bool = False, base_dir: str | None = None, every: int = 16
) -> DataFrame:
    """ST2 (A9): running connection weights per (sender, recipient) in the state store, one
    state row per edge."""
    from tessera.plans.mail import edges

    totals = edges(records_stream, last_only)
    return _running_totals(spark, totals, ["src", "dst"], _run_dir(spark, "mail-edges", base_dir), every).select("src", "dst", "weight")
