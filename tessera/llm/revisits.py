"""Resolving not-modified revisit records.

A revisit record says that a server answered 304: its content is that of an earlier full
response. Each revisit is joined, as of its date, to the latest strictly earlier full
response of the same canonical URL; the validators decide whether that response is the
one that was confirmed, and the header fields a 304 may update replace the stored ones.

The as-of join splits hot URLs by time: the last full response of each (URL, hour) is a
pre-combined maximum; a window over the hours of a URL carries it forward, and a second
window works inside each hour. No window sees more than one URL's captures of one hour,
or one row for each hour of a URL. Payloads stay out of the windows and are joined once,
by record id, at the end.

Outcomes: ``resolved``; ``no_response`` (nothing earlier); ``mismatch`` (validators
differ, or the response lacks the one given); ``no_validator`` (the revisit gives none).
Only resolved rows get headers and a payload.

Defined cases: null URL or date resolves to ``no_response``; null headers are no headers;
of full responses with one date the larger record id counts; repeated revisit rows come
back as often as they went in; repeated rows of one response (same record id) must agree
and count once; rows of other types are ignored; an empty table gives no rows. Extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3_600_000_000
#: Header fields that a 304 response may update (RFC 9110, section 15.4.5).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
#: Query parameters that do not change the resource.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case without default port and fragment; query parameters
    sorted and without tracking ones; an empty path is ``/``."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    origin = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)", 1))
    origin = F.regexp_replace(F.regexp_replace(origin, r"^(http://[^/]*):80$", "$1"), r"^(https://[^/]*):443$", "$1")
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    path = F.regexp_replace(rest, r"\?.*$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.concat(origin, F.when(path == "", "/").otherwise(path), F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept)))


def header_lines(block: Column) -> Column:
    """Header lines of a raw block, without the status line and empty lines."""
    return F.filter(F.split(F.coalesce(block, F.lit("")), r"\r?\n"), lambda x: x.contains(":"))


def field_name(line: Column) -> Column:
    return F.lower(F.trim(F.substring_index(line, ":", 1)))


def field(lines: Column, name: str) -> Column:
    """Value of the first header of that name, or null."""
    line = F.try_element_at(F.filter(lines, lambda x: field_name(x) == name), F.lit(1))
    return F.nullif(F.trim(F.regexp_replace(line, r"^[^:]*:", "")), F.lit(""))


def weak(etag: Column) -> Column:
    return F.regexp_replace(etag, r"^W/", "")


def resolve(records: DataFrame, hour: int = HOUR) -> DataFrame:
    """One row for each revisit of ``records`` (record_id, warc_type, target_uri, warc_date,
    http_headers, payload): record_id, url, outcome, response_id, headers, payload."""
    rows = records.where(F.col("warc_type").isin("response", "revisit")).select(
        "record_id",
        (F.col("warc_type") == "response").alias("full"),
        canonical_url(F.col("target_uri")).alias("url"),
        F.unix_micros(F.col("warc_date")).alias("at"),
        header_lines(F.col("http_headers")).alias("lines"),
    )
    rows = rows.withColumns({"etag": field(F.col("lines"), "etag"), "modified": field(F.col("lines"), "last-modified"), "bucket": F.floor(F.col("at") / F.lit(hour))})
    # Revisits that can have no earlier response take no part in the windows.
    placed = rows.where(F.col("url").isNotNull() & F.col("at").isNotNull())
    answer = F.when(F.col("full"), F.struct("at", "record_id", "etag", "modified", "lines"))
    last = placed.groupBy("url", "bucket").agg(F.max(answer).alias("last"))
    before = Window.partitionBy("url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("url", "bucket", F.last("last", ignorenulls=True).over(before).alias("carried"))
    inside = Window.partitionBy("url", "bucket").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    asof = placed.withColumn("near", F.max(answer).over(inside)).where(~F.col("full"))
    asof = asof.join(carried, ["url", "bucket"], "left").select("record_id", "url", "lines", "etag", "modified", F.coalesce("near", "carried").alias("found"))
    rest = rows.where(~F.col("full") & (F.col("url").isNull() | F.col("at").isNull()))
    asof = asof.unionByName(rest.select("record_id", "url", "lines", "etag", "modified"), allowMissingColumns=True)
    same = F.when(F.col("etag").isNotNull(), weak(F.col("etag")) == weak(F.col("found.etag"))).when(F.col("modified").isNotNull(), F.col("modified") == F.col("found.modified"))
    outcome = (
        F.when(F.col("found").isNull(), "no_response")
        .when(F.col("etag").isNull() & F.col("modified").isNull(), "no_validator")
        .when(F.coalesce(same, F.lit(False)), "resolved")
        .otherwise("mismatch")
    )
    fresh_lines = F.filter("lines", lambda x: field_name(x).isin(PERMITTED))
    names = F.transform(fresh_lines, field_name)
    merged = F.concat(F.filter("found.lines", lambda x: ~F.array_contains(names, field_name(x))), fresh_lines)
    judged = asof.withColumn("outcome", outcome).select(
        "record_id",
        "url",
        "outcome",
        F.when(F.col("outcome") == "resolved", F.col("found.record_id")).alias("response_id"),
        F.when(F.col("outcome") == "resolved", F.array_join(merged, "\r\n")).alias("headers"),
    )
    # Rows without a response get a key of their own, or nulls would all meet in one task.
    keyed = judged.withColumn("key", F.coalesce(F.concat(F.lit("+"), "response_id"), F.concat(F.lit("-"), "record_id")))
    bodies = records.where("warc_type = 'response'").select(F.concat(F.lit("+"), "record_id").alias("key"), "payload").dropDuplicates(["key"])
    return keyed.join(bodies, "key", "left").select("record_id", "url", "outcome", "response_id", "headers", "payload")


def captures(pages: DataFrame) -> DataFrame:
    """Capture records made from every page: its full response, and a revisit of another
    spelling of its URL, dated from a day before to three days after, whose validators
    agree, differ or are missing by the page's id."""
    pid = F.col("page_id")
    start = F.timestamp_seconds(F.lit(1704067200) + pid * 7919 % 8640000)
    etag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce(F.col("html"), F.lit(""))), 1, 16), F.lit('"'))
    modified = F.date_format(start - F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss")
    date = F.date_format(start, "yyyy-MM-dd HH:mm:ss")

    def block(status: str, *lines: Column) -> Column:
        return F.concat_ws("\r\n", F.lit(status), *lines)

    response = pages.select(
        F.format_string("resp-%d", pid).alias("record_id"),
        F.lit("response").alias("warc_type"),
        F.col("url").alias("target_uri"),
        start.alias("warc_date"),
        block(
            "HTTP/1.1 200 OK",
            F.concat(F.lit("Date: "), date),
            F.concat(F.lit("ETag: "), etag),
            F.concat(F.lit("Last-Modified: "), modified),
            F.lit("Content-Type: text/html"),
            F.concat(F.lit("Content-Length: "), F.length("html").cast("string")),
            F.lit("Cache-Control: max-age=60"),
        ).alias("http_headers"),
        F.col("html").alias("payload"),
    )
    later = F.timestamp_seconds(F.unix_seconds(start) + (pid % 5 - 1) * 86400)
    revisit = pages.select(
        F.format_string("rev-%d", pid),
        F.lit("revisit"),
        F.concat(F.regexp_replace(F.col("url"), "#.*$", ""), F.when(F.col("url").contains("?"), "&utm_medium=again#x").otherwise("?utm_medium=again")),
        later,
        block(
            "HTTP/1.1 304 Not Modified",
            F.concat(F.lit("Date: "), F.date_format(later, "yyyy-MM-dd HH:mm:ss")),
            F.when(pid % 11 != 0, F.concat(F.lit("ETag: "), F.when(pid % 7 == 0, '"other"').otherwise(F.concat(F.lit("W/"), etag)))),
            F.when((pid % 11 == 0) & (pid % 2 == 0), F.concat(F.lit("Last-Modified: "), modified)),
            F.lit("Cache-Control: max-age=3600"),
            F.lit("Content-Length: 0"),
        ),
        F.lit(None).cast("string"),
    )
    return response.union(revisit)
