"""Edge rows from FIXTURES.md for the mail and log families."""

from datetime import datetime

from tessera.plans import logs as C
from tessera.plans import mail as B


def _records(spark, rows):
    df = spark.createDataFrame(rows, "epoch_ms string, message_id string, sender string, recipients string, topic string, mode string")
    return B.parse_records(df)


def test_mail_edges_and_stats_edge_rows(spark):
    recs = _records(
        spark,
        [
            ("0", "m1", "A-B@x", "c@x|D@x|c@x", "", "mail"),  # repeated recipient, upper case, '-' in sender
            ("1", "m2", "c@x", "", "", "mail"),  # empty recipients: one empty element
            ("2", "m3", "a-b@x", "e-f@x", "", "mail"),
        ],
    )
    all_edges = {(r.src, r.dst): r.weight for r in B.edges(recs).collect()}
    assert all_edges == {("a-b@x", "c@x"): 2, ("a-b@x", "d@x"): 1, ("c@x", ""): 1, ("a-b@x", "e-f@x"): 1}
    last = {(r.src, r.dst): r.weight for r in B.edges(recs, last_only=True).collect()}
    assert last == {("a-b@x", "c@x"): 1, ("c@x", ""): 1, ("a-b@x", "e-f@x"): 1}
    stats = {r.user: (r.received, r.sent) for r in B.user_stats(recs).collect()}
    assert stats == {"a-b@x": (0, 2), "c@x": (2, 1)}  # d@x, e-f@x only received: left out
    everyone = {r.user for r in B.user_stats(recs, include_receivers=True).collect()}
    assert everyone == {"a-b@x", "c@x", "d@x", "e-f@x", ""}
    counts = [r.attributes[0]["value"] for r in recs.orderBy("message identifier").collect()]
    assert counts == [3, 1, 1]


def test_log_search_edge_rows(spark):
    good = '{"name": "login", "args": {"username": "u1", "hostname": "d1", "client_address": "1.2.3.4", "device_address": "5.6.7.8"}}'
    rows = [
        ("1", "web-1", datetime(2024, 1, 1, 1), good),
        ("2", "web-1", datetime(2024, 1, 1, 2), '{"name": "login", "args": '),  # bad JSON
        ("3", "web-1", datetime(2024, 1, 1, 3), '{"name": "login"}'),  # missing args
        ("4", "web-1", datetime(2024, 1, 1, 4), good.replace("login", "logout")),  # other name
        ("5", "web-2", datetime(2024, 1, 1, 5), good),  # other host
        ("6", "WEB-1", datetime(2024, 1, 1, 6), good),  # host in another case
        ("7", "web-1", datetime(2024, 1, 3, 1), good),  # outside the date range
    ]
    docs = spark.createDataFrame(rows, "_id string, host string, `@timestamp` timestamp, message string")
    exact = C.search(docs, "web-1", "login", from_ts="2024-01-01", to_ts="2024-01-02")
    assert [(r._id, r.user, r.device) for r in exact.collect()] == [("1", "u1", "d1"), ("3", None, None)]
    analysed = C.search(docs, "web-1", "login", analyzed=True, size=None)
    assert sorted(r._id for r in analysed.collect()) == ["1", "3", "5", "6", "7"]  # tokens 'web' / '1'
    assert [r._id for r in C.rejected_messages(docs).collect()] == ["2"]
    capped = C.search(docs, "web-1", "login", size=1)
    assert [r._id for r in capped.collect()] == ["1"]
