"""WARC: exact round trip, revisits, keys, index with small blocks."""

import hashlib

import pytest

from civora.llm import warc
from civora.llm.common import shared_path

SCHEMA = "page_id long, url string, html string, payload string"


def pages(spark, data):
    return spark.createDataFrame([(*d, "own") for d in data], SCHEMA).repartition(4)


def corpus():
    big = "<p>" + "é text \r\n\r\n WARC/1.0 " * 80 + "</p>"
    data = [(i, f"https://h{i % 3}.example.org/p/{i}?a=1 b", f"<p>{i}</p>" * (i % 40)) for i in range(120)]
    data += [(1000 + i, "http://same.example.com/", big) for i in range(30)]
    data += [(2000, None, big), (None, "http://x.y/\tz", big), (2001, "not a url", None), (2002, "", ""),
             (2003, "http://[bad/", "z" * 200_000), (2004, "http://x.y/\nA: b", "short"), (2005, "http://q/", "short")]
    return data


def expected(data):
    largest = {}
    for i, _, h in data:
        if len((h or "").encode()) >= 1000:
            largest[h] = max(largest.get(h, -1), -1 if i is None else i)
    out = []
    for i, _, h in data:
        p = (h or "").encode()
        twin = largest.get(h) if sum(d[2] == h for d in data) > 1 else None
        twin = None if twin == i else twin
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if twin is None else "revisit", twin))
    return sorted(out, key=str)


def test_round_trip(spark):
    data = corpus()
    rows = warc.round_trip(pages(spark, data), with_payload=True).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=str) == expected(data)
    html = {i: h for i, _, h in data}
    for r in rows:
        if r.record_type == "response":
            assert bytes(r.payload) == (html[r.page_id] or "").encode()


def test_small_blocks_and_unknown_requests(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    data = corpus()
    folder = shared_path(spark, "warc-test")
    directory = warc.build_index(warc.write(pages(spark, data), folder + "/a"), folder + "/i")
    assert directory.count() > 20
    asked = spark.createDataFrame([(7, data[7][1]), (8, "http://none.example/"), (1003, data[123][1]), (1003, data[123][1])],
                                  "page_id long, url string")
    got = warc.look_up(asked, directory, folder + "/i", folder + "/a")
    assert sorted(r.page_id for r in got.collect()) == [7, 1003]


def test_repeated_rows_and_empty(spark):
    h = "r" * 1500
    got = warc.round_trip(pages(spark, [(1, "http://a/", h), (2, "http://a/", h), (2, "http://a/", h)]))
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got.collect()) == [
        (1, "revisit", 2), (2, "response", None), (2, "response", None)]
    assert warc.round_trip(pages(spark, [])).collect() == []


def test_keys_and_broken_records():
    assert warc.url_key("https://www.A.org:80/p?q=1#f") == "org,a,www)/p?q=1"
    data = warc.record(1, "http://a/", b"payload", None)
    assert warc.parse(data)["payload"] == b"payload"
    for bad in (data.replace(b"payload\r", b"paylOad\r"), data[:-1], b"x" + data):
        with pytest.raises(ValueError):
            warc.parse(bad)


def test_captures_that_share_a_key(spark):
    """Urls that differ in scheme, port, user or fragment, and null ids, give one row per page."""
    pages = [(5, "http://a.org/x", "one"), (5, "https://a.org/x", "two"), (5, "https://a.org:8443/x", "three"),
             (5, "https://me@a.org/x", "four"), (None, "http://b.org/#1", "five"), (None, "http://b.org/#2", "six"),
             (6, None, "seven"), (7, "http://a.org/x", "eight"), (5, "http://a.org/x", "one")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    rows = warc.round_trip(df, with_payload=True).collect()
    assert sorted((str(r.page_id), str(r.url), r.payload.decode()) for r in rows) == sorted(
        (str(i), str(u), h) for i, u, h in pages)
