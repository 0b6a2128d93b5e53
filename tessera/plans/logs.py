"""Family C: JSON log search and create-only copies between dated targets.

Log documents are landed rows ``_id, host, @timestamp, message`` where ``message`` is a
JSON text ``{"name": ..., "args": {...}}``. The search server's work (match on host,
result cap) becomes Parquet-pushed filters plus ``from_json``; the server-side copy
becomes an anti join (create only) and an append.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.joins import create_only
from tessera.session import path_exists, written

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField(
            "args",
            T.StructType(
                [
                    T.StructField("username", T.StringType()),
                    T.StructField("hostname", T.StringType()),
                    T.StructField("client_address", T.StringType()),
                    T.StructField("device_address", T.StringType()),
                ]
            ),
        ),
    ]
)
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def match_host(host_col: str, value: str, analyzed: bool = False):
    """Exact match, or analysed-text match (any shared lower-cased token)."""
    if not analyzed:
        return F.col(host_col) == F.lit(value)
    tokens = re.findall(r"[^\W_]+", value.lower())  # letters and digits, as TOKEN_SPLIT leaves them
    return F.arrays_overlap(F.split(F.lower(F.col(host_col)), TOKEN_SPLIT), F.array(*[F.lit(t) for t in tokens]))


def parse_messages(docs: DataFrame) -> DataFrame:
    """SC16: decode ``message``; bad JSON or a missing key gives NULL fields.

    The decoded struct comes out of a one-element generator, so filters on it (name,
    rejects) stay above the decode instead of being pushed below it with a second copy
    of ``from_json``: each message is parsed once.
    """
    return docs.select("*", F.inline(F.array(F.struct(F.from_json("message", MESSAGE_SCHEMA).alias("msg")))))


def search(
    docs: DataFrame,
    host: str,
    name: str,
    from_ts=None,
    to_ts=None,
    analyzed: bool = False,
    size: int | None = None,
) -> DataFrame:
    """SRC8 + P12-P14 + O4: matching messages with user, device and addresses.

    The date range (ignored by the original, Q11) filters ``@timestamp`` before the scan
    is decoded. All hits are returned; with ``size`` the first so many by a total order on
    (timestamp, _id), after the name filter.
    """
    cond = match_host("host", host, analyzed)
    if from_ts is not None:
        cond = cond & (F.col("@timestamp") >= F.lit(from_ts))
    if to_ts is not None:
        cond = cond & (F.col("@timestamp") < F.lit(to_ts))
    hits = parse_messages(docs.where(cond)).where(F.col("msg.name") == F.lit(name))
    out = hits.select(
        F.col("_id"),
        F.col("@timestamp").alias("timestamp"),
        F.col("msg.args.username").alias("user"),
        F.col("msg.args.hostname").alias("device"),
        F.col("msg.args.client_address").alias("client_address"),
        F.col("msg.args.device_address").alias("device_address"),
    )
    if size is not None:
        out = out.orderBy("timestamp", "_id").limit(size)
    return out


def rejected_messages(docs: DataFrame) -> DataFrame:
    """Documents whose message is not valid JSON of the expected shape."""
    return parse_messages(docs).where(F.col("msg").isNull() | F.col("msg.name").isNull()).drop("msg")


def two_source_copy(
    docs: DataFrame,
    host_today: str,
    host_yesterday: str,
    existing: DataFrame | None = None,
    day_col: str = "day",
    key: str = "_id",
    row_id: str | None = None,
) -> DataFrame:
    """U4 + J5: for every target day T, copy source days T and T-1 (create only).

    Each source document is offered to the target of its own day (priority 0, the
    'today' pass, filtered on ``host_today``) and of the next day (priority 1, the
    'yesterday' pass, filtered on ``host_yesterday``). Per (target day, id) the first
    offer wins: lower priority, then earlier timestamp, then smaller ``event_id``-like
    tie-breaker column ``_seq`` when present. Documents already in ``existing``
    (columns ``target_day``, ``_id``) are left untouched.

    Offers are ranked without their payload: ``min(struct(...))`` of priority, time and row
    id, an aggregate with map-side combine, so a hot id needs no single-task sort. One join
    by row id then fetches the winners' other columns. ``row_id`` names a column that no two
    documents share; without one the hosts' documents are numbered and written once.
    """
    # The hosts are filtered before the rows are doubled, so that the filter reaches the scan.
    rows = docs.where(F.col("host").isin(sorted({host_today, host_yesterday})))
    if row_id is None:
        rows, row_id = written(rows.withColumn("_row", F.monotonically_increasing_id()), "offered"), "_row"
    tie = [F.col("_seq")] if "_seq" in docs.columns else []
    offers = rows.select(
        key,
        F.explode(
            F.array(
                F.struct(F.col(day_col).alias("target_day"), F.lit(0).alias("priority"), (F.col("host") == F.lit(host_today)).alias("ok")),
                F.struct(F.date_add(F.col(day_col), 1).alias("target_day"), F.lit(1).alias("priority"), (F.col("host") == F.lit(host_yesterday)).alias("ok")),
            )
        ).alias("_offer"),
        F.struct(F.col("@timestamp").alias("ts"), *tie, F.col(row_id).alias("row")).alias("_at"),
    ).where(F.col("_offer.ok"))
    best = offers.groupBy(F.col("_offer.target_day").alias("target_day"), key).agg(F.min(F.struct("_offer.priority", "_at")).alias("_best"))
    if existing is not None:
        best = best.join(existing.select("target_day", key), on=["target_day", key], how="left_anti")
    winners = best.select("target_day", F.col("_best.priority").alias("priority"), F.col("_best._at.row").alias("_won"))
    payload = [c for c in docs.columns if c != key]
    return rows.join(winners, F.col(row_id) == F.col("_won")).select("target_day", key, "priority", *[F.col(f"`{c}`") for c in payload])


def daily_copy(
    docs: DataFrame,
    run_date: str,
    host_today: str,
    host_yesterday: str,
    existing: DataFrame | None = None,
    day_col: str = "day",
    key: str = "_id",
    row_id: str | None = None,
) -> DataFrame:
    """SRC9 + SC15 + U4: the copy for one run date (a parameter, never the wall clock).

    Only the source days ``run_date`` and ``run_date - 1`` are read (a partition filter
    when ``day`` is a partition column) and only the target ``run_date`` is produced.
    """
    d = F.to_date(F.lit(run_date))
    src = docs.where((F.col(day_col) == d) | (F.col(day_col) == F.date_sub(d, 1)))
    out = two_source_copy(src, host_today, host_yesterday, existing, day_col, key, row_id)
    return out.where(F.col("target_day") == d)


def write_by_day(docs: DataFrame, path: str, day_col: str = "day") -> None:
    """The log documents as a table with a folder a day; days that ``docs`` holds are
    replaced, others stay."""
    docs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day_col).parquet(path)


def copy_day(spark: SparkSession, source: str, target: str, run_date: str, host_today: str, host_yesterday: str, key: str = "_id") -> int:
    """SRC9 + SNK7 on tables: the copy of one run date between tables with a folder a day.

    Reads two days of ``source`` and the run date's own folder of ``target``; what that holds
    is never written again. New documents go to ``target_day=<run date>/run=<n>``, with n the
    number of runs before that found any, as a dynamic partition overwrite: an attempt that
    fails leaves nothing behind, one that is made again replaces itself, and a run after
    a finished one adds nothing. Returns n."""
    table = spark.read.parquet(source)
    docs = table.withColumn("_row", F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index")))
    existing, run = None, 0
    if path_exists(spark, target):
        held = spark.read.parquet(target).where(F.col("target_day") == F.to_date(F.lit(run_date)))
        run = held.agg(F.coalesce(F.max("run") + 1, F.lit(0))).first()[0]
        existing = held.select("target_day", key)
    new = daily_copy(docs, run_date, host_today, host_yesterday, existing, key=key, row_id="_row").drop("_row")
    out = new.withColumn("run", F.lit(run))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("target_day", "run").parquet(target)
    return run


def target_name(prefix: str, run_date: str) -> str:
    """SC15: dated target name ``prefix-yyyy.MM.dd`` for a run date ``yyyy-MM-dd``."""
    return f"{prefix}-{run_date.replace('-', '.')}"


def copy_new(source: DataFrame, destination: DataFrame, key: str = "_id") -> DataFrame:
    """SNK7/J5: documents to append to the destination (create only)."""
    return create_only(source, destination, key)
