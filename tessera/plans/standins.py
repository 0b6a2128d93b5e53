"""Reference-shaped inputs derived from the driver tables.

The original jobs read flight/weather CSV lines, mail CSV rows, log documents, version
texts and score files. The driver provides TPC-H-like tables instead, so each input is
derived row by row from a whole table (no sampling, no id subsets); the derived inputs
grow with the tables. Every derivation is a narrow projection (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import table


def _s(c: Column) -> Column:
    return c.cast("string")


# ---------------------------------------------------------------- family A (events)
def hhmm(ts: str = "ts") -> Column:
    """HHMM text without leading zeros (``'930'``, ``'45'`` for 00:45, ``'5'``)."""
    return _s(F.hour(ts) * 100 + F.minute(ts))


def weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather readings, one per event: airport = event bucket, reading = value as '%.2f',
    every 17th ``nan``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("AP"), _s(F.pmod("event_id", F.lit(10)))).alias("airport"),
        hhmm().alias("time"),
        F.when(F.pmod("event_id", F.lit(17)) == 0, F.lit("nan")).otherwise(_s(F.col("value").cast("decimal(18,2)"))).alias("temperature"),
    )


def weather_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = weather_rows(spark, sf_dir)
    return w.select(F.concat_ws(",", "date", "airport", "time", "temperature").alias("value"))


def flight_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights, one per event, spread over the 19 positional text fields."""
    ev = table(spark, sf_dir, "events")
    k = F.pmod("event_id", F.lit(6))
    base = _s(F.floor("value").cast("bigint") - 100)
    delay = (
        F.when(k == 0, base)
        .when(k == 1, F.lit(""))
        .when(k == 2, F.concat(base, F.lit("d")))
        .when(k == 3, F.concat(F.lit(" "), base, F.lit(".5 ")))
        .when(k == 4, F.lit("nan"))
        .otherwise(F.lit("inf"))
    )
    bad_coord = F.pmod("event_id", F.lit(11)) == 0
    lon = F.when(bad_coord, F.lit("")).otherwise(_s((F.pmod(F.col("event_id") * 7919, F.lit(36001)) - 18000) / F.lit(100.0)))
    lat = _s((F.pmod(F.col("event_id") * 104729, F.lit(18001)) - 9000) / F.lit(100.0))
    code = F.when(F.pmod("event_id", F.lit(3)) == 0, F.concat(F.lit("C"), _s(F.col("event_id") * 1000003))).otherwise(_s(F.col("event_id")))
    e = F.lit("")
    return ev.select(
        F.col("event_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("AL"), _s(F.pmod("user_id", F.lit(7)))).alias("airline"),
        F.lit("x,y").alias("f2"),
        F.get_json_object("props", "$.k").alias("destination"),
        e.alias("f4"),
        F.concat(F.lit("AP"), _s(F.pmod("user_id", F.lit(10)))).alias("origin"),
        e.alias("f6"),
        hhmm().alias("dep_time"),
        delay.alias("dep_delay"),
        *[e.alias(f"f{i}") for i in range(9, 15)],
        lon.alias("longitude"),
        lat.alias("latitude"),
        e.alias("f17"),
        code.alias("code"),
    )


def _csv_field(c: Column) -> Column:
    """Quote a text field the way a CSV writer would when it holds , or \"."""
    needs = c.contains(",") | c.contains('"')
    return F.when(needs, F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))).otherwise(c)


def flight_lines(spark: SparkSession, sf_dir: str, copies: int = 2, headers: int = 2) -> DataFrame:
    """Raw flight lines: every record written ``copies`` times plus ``headers`` header lines."""
    from tessera.plans.flights import flight_field_names

    rows = flight_rows(spark, sf_dir)
    names = flight_field_names()
    line = F.concat_ws(",", *[_csv_field(F.col(n)) for n in names])
    # Copies are generated in one pass (one scan), not by a union of scans.
    out = rows.select(F.explode(F.array_repeat(line, copies)).alias("value"))
    header = ",".join(n[0].upper() + n[1:] for n in names)
    if headers:
        out = out.unionAll(spark.range(headers).select(F.lit(header).alias("value")))
    return out


def lineitem_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV lines from ``lineitem``: each row twice, plus two header lines."""
    li = table(spark, sf_dir, "lineitem")
    line = F.concat_ws(
            ",",
            F.date_format("l_shipdate", "yyyy-MM-dd"),
            F.col("l_returnflag"),
            F.concat(F.lit('"'), F.col("l_linestatus"), F.lit(","), F.col("l_returnflag"), F.lit('"')),
            _s(F.col("l_orderkey")),
            _s(F.col("l_partkey")),
            _s(F.col("l_suppkey")),
            _s(F.col("l_linenumber")),
            _s(F.col("l_quantity").cast("bigint")),
            _s(F.col("l_extendedprice").cast("decimal(18,2)")),
    )
    header = spark.range(2).select(F.lit("Date,Flag,Status,Order,Part,Supp,Line,Qty,Price").alias("value"))
    return li.select(F.explode(F.array_repeat(line, 2)).alias("value")).unionAll(header)


LINEITEM_LINE_FIELDS = ["date", "flag", "status", "orderkey", "partkey", "suppkey", "linenumber", "quantity", "price"]


# ---------------------------------------------------------------- family B (lineitem)
def mail_rows(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Mail CSV rows: one per ``lineitem`` row.

    sender = nation of the order's customer; recipients = the supplier's nation (once,
    twice, or with the customer's nation), or none, chosen by line number; upper-case
    names so that lower-casing matters; milliseconds zero for every fourth order.
    """
    li = (lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cn = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("c_nation"))
    sn = n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("s_nation"))
    j = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, o.o_custkey == c.c_custkey)
        .join(cn, "c_nationkey")
        .join(s, li.l_suppkey == s.s_suppkey)
        .join(sn, "s_nationkey")
    )
    k = F.pmod("l_linenumber", F.lit(4))
    recipients = (
        F.when(k == 0, F.lit(""))
        .when(k == 1, F.col("s_nation"))
        .when(k == 2, F.concat_ws("|", "s_nation", "c_nation"))
        .otherwise(F.concat_ws("|", "s_nation", "s_nation", "c_nation"))
    )
    ms = F.when(F.pmod("l_orderkey", F.lit(4)) == 0, F.lit(0)).otherwise(F.pmod(F.col("l_suppkey") * 37 + F.col("l_linenumber"), F.lit(1000)))
    epoch = (
        F.unix_date(F.to_date("l_shipdate")).cast("bigint") * 86_400_000
        + F.col("l_linenumber").cast("bigint") * 3_600_000
        + F.pmod("l_partkey", F.lit(60)) * 60_000
        + ms
    )
    return j.select(
        _s(epoch).alias("epoch_ms"),
        F.concat(F.lit("<"), _s(F.col("l_orderkey")), F.lit("."), _s(F.col("l_linenumber")), F.lit("@mail>")).alias("message_id"),
        F.col("c_nation").alias("sender"),
        recipients.alias("recipients"),
        F.lit("").alias("topic"),
        F.lit("mail").alias("mode"),
    )


# ---------------------------------------------------------------- family C (events)
def log_docs(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Log documents: one per event. ``signup`` messages are cut-off JSON, ``purchase``
    messages have no ``args``; hosts ``web-0..3`` with every 13th in upper case."""
    ev = events if events is not None else table(spark, sf_dir, "events")
    ev = ev.withColumn("_k", F.get_json_object("props", "$.k"))  # extracted once, used twice
    k = F.col("_k")
    host = F.concat(F.lit("web-"), _s(F.pmod("user_id", F.lit(4))))
    args = F.concat(
        F.lit('{"username": "user'), _s(F.col("user_id")),
        F.lit('", "hostname": "h'), _s(F.pmod("user_id", F.lit(5))),
        F.lit('", "client_address": "10.0.'), _s(F.pmod("user_id", F.lit(256))), F.lit("."), k,
        F.lit('", "device_address": "dev-'), k, F.lit('"}'),
    )
    head = F.concat(F.lit('{"name": "'), F.col("event_type"), F.lit('"'))
    message = (
        F.when(F.col("event_type") == "signup", F.concat(head, F.lit(', "args": ')))
        .when(F.col("event_type") == "purchase", F.concat(head, F.lit("}")))
        .otherwise(F.concat(head, F.lit(', "args": '), args, F.lit("}")))
    )
    return ev.select(
        _s(F.col("event_id")).alias("_id"),
        F.when(F.pmod("event_id", F.lit(13)) == 0, F.upper(host)).otherwise(host).alias("host"),
        F.col("ts").alias("@timestamp"),
        message.alias("message"),
        F.to_date("ts").alias("day"),
        F.col("event_id").alias("_seq"),
        F.col("event_type"),
    )


# ---------------------------------------------------------------- family D (part)
def version_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version texts from ``part``: 1 to 5 dot-separated parts, some NULL, some with a
    non-numeric part; the build-lab text carries a ``*`` suffix in part 1 for some rows."""
    p = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    p0 = _s(F.col("p_size"))
    p1 = _s(F.pmod(pk, F.lit(100)))
    p2 = _s(F.pmod(pk * 7, F.lit(10000)))
    p3n = _s(F.pmod(pk * 13, F.lit(1000)))
    p3 = F.when(F.pmod(pk, F.lit(17)) == 0, F.concat(F.lit("x"), p3n)).otherwise(p3n)
    p4 = _s(F.col("p_size") * 3)
    n_parts = (F.pmod(pk, F.lit(5)) + 1).cast("int")
    version = F.when(F.pmod(pk, F.lit(19)) == 0, F.lit(None).cast("string")).otherwise(
        F.concat_ws(".", F.slice(F.array(p0, p1, p2, p3, p4), F.lit(1), n_parts))
    )
    lab_p1 = F.when(F.pmod(pk, F.lit(7)) == 0, F.concat(p1, F.lit("*fre"))).otherwise(p1)
    build_lab = F.concat_ws(".", F.slice(F.array(p0, lab_p1, F.lower("p_type"), F.lower("p_brand")), F.lit(1), F.least(n_parts, F.lit(4))))
    return p.select("p_partkey", version.alias("version"), build_lab.alias("build_lab"))


# ---------------------------------------------------------------- family E (lineitem)
def line_id() -> Column:
    return F.concat(_s(F.col("l_orderkey")), F.lit("-"), _s(F.col("l_linenumber")))


def score_files(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three score files keyed by ``id`` (one row per id, since each is an aggregate):
    ``score_a`` from discounts (holds exactly 0.2 and 0.8), ``score_b`` from taxes over
    the lines not returned (a different id set), ``score_c`` from quantities with NULL
    where every line of the id is open."""
    li = table(spark, sf_dir, "lineitem")
    a = li.groupBy(line_id().alias("id")).agg((F.max("l_discount") * F.lit(10.0)).alias("score_a"))
    b = li.where(F.col("l_returnflag") != "R").groupBy(line_id().alias("id")).agg((F.max("l_tax") * F.lit(12.5)).alias("score_b"))
    c = li.groupBy(line_id().alias("id")).agg(
        F.max(F.when(F.col("l_linestatus") != "O", F.col("l_quantity") / F.lit(50.0))).alias("score_c")
    )
    return [a, b, c]


def importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long importance table ``feature, importance, fold`` (fold tables appended)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("f_"), _s(F.col("l_partkey"))).alias("feature"),
        F.col("l_quantity").alias("importance"),
        F.col("l_linenumber").alias("fold"),
    )
