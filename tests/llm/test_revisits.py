import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import helpers
from clinflat.llm import revisits as V
from clinflat.llm.queries import ORACLES, captures, op10_revisits
from oracle import compare, connect

SCHEMA = (
    "record_id long, url string, ts timestamp, status int, "
    "headers array<struct<name:string,value:string>>, payload string, state string, found string"
)
START = datetime(2026, 1, 1)


def record(k, url, minutes, status, headers=(), payload=None):
    ts = None if minutes is None else START + timedelta(minutes=minutes)
    return k, url, ts, status, None if headers is None else list(headers), payload, "s", "f"


def resolved(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r["record_id"]: r for r in V.resolve(df).collect()}


@pytest.mark.parametrize("url,want", [
    ("HTTP://www.Example.ORG:80/a?b=2&a=1&utm_source=x#f", "example.org/a?a=1&b=2"),
    ("https://example.org:443", "example.org/"), ("https://u:p@example.org:80/x", "example.org:80/x"),
    ("http://example.org/?", "example.org/"), ("example.org/x", None), (None, None),
    ("", None), ("http:///x", None),
])
def test_canonical_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(V.canonical_url(F.col("u"))).first()[0] == want


def test_resolution(spark):
    u = "http://a.org/x"
    rows = [
        record(1, u, 0, 200, [("ETag", '"a"'), ("Content-Length", "5"), ("Date", "d0"), ("X", "1")], "p1"),
        record(2, u + "#f", 5, 304, [("etag", 'W/"a"'), ("Date", "d5"), ("Content-Length", "0")]),
        record(3, u, 6, 304, [("ETag", '"b"')]),
        record(4, u, 7, 304, [("X", "2")]),
        record(5, u, 8, 200, [("Last-Modified", "m")], "p5"),
        record(6, u, 9, 304, [("Last-Modified", "m"), ("ETag", '"a"')]),
        record(7, u, 9, 304, [("Last-Modified", "n")]),
        record(8, u, 0, 304, [("ETag", '"a"')]),
        record(9, "http://b.org/", 1, 304, [("ETag", '"a"')]),
        record(10, None, 1, 304), record(11, u, None, 304), record(12, u, 10, 404),
        record(13, u, 11, None), record(14, u, 12, 304, None),
        record(15, u, 12, 304, [(None, "v"), ("ETag", None), ("Last-Modified", " m ")]),
    ]
    got = resolved(spark, rows)
    states = [got[k]["state"] for k in range(1, 16)]
    assert states == [
        "full", "resolved", "changed", "no_validator", "full", "resolved", "changed",
        "no_earlier_response", "no_earlier_response", "no_earlier_response", "no_earlier_response",
        "other", "other", "no_validator", "resolved",
    ]
    assert {k: r["refers_to"] for k, r in got.items() if r["refers_to"]} == {2: 1, 6: 5, 15: 5}
    assert sorted(tuple(h) for h in got[2]["headers"]) == [
        ("content-length", "5"), ("date", "d5"), ("etag", 'W/"a"'), ("x", "1"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    payloads = {r["record_id"]: r["payload"] for r in V.with_payload(V.resolve(df), df).collect()}
    assert (payloads[2], payloads[6], payloads[1], payloads[3]) == ("p1", "p5", "p1", None)


def plain(rows):
    """Index of the response each 304 record should be held against, by scanning all."""
    out = {}
    for k, url, ts, status, *_ in rows:
        if status == 304:
            full = [(t, j) for j, u, t, s, *_ in rows if s == 200 and u == url and t < ts]
            out[k] = max(full, default=(None, None))[1]
    return out


def test_one_url_with_most_captures(spark):
    rng = random.Random(7)
    rows = []
    for k in range(600):
        url = "http://hot.org/" if rng.random() < 0.7 else f"http://c{rng.randrange(9)}.org/"
        status = 200 if rng.random() < 0.03 else 304
        rows.append(record(k, url, rng.randrange(300), status, [("ETag", '"e"')]))
    got = resolved(spark, rows)
    want = plain(rows)
    assert {k: got[k]["refers_to"] for k in want} == want


def test_empty_and_repeated(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert V.resolve(none).count() == 0
    rows = [record(1, "http://a.org/", 0, 200), record(2, "http://a.org/", 1, 304)] * 2
    assert V.resolve(spark.createDataFrame(rows, SCHEMA)).count() == 4


def test_query(spark):
    con = connect(helpers.SF)
    assert captures(spark, helpers.SF).count() == 4 * 50
    assert compare(op10_revisits(spark, helpers.SF), con, ORACLES["op10_revisits"]) == []
