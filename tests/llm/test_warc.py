"""WARC files: round trip, and assembly against plain dictionaries."""

import gzip
import io
import random

import pytest

from hemicycle.llm import warc

PAGES = "page_id long, url string, html string, record_id string"


def test_pages_round_trip(spark):
    pages = [(i, f"https://example.com/{i}?q=ü x", f"<html>é {i}\r\n\r\n WARC/1.0 \r\n</html>" * (i % 50), "clash") for i in range(300)]
    pages += [(1000, None, None, None), (None, "http://a", "b", None), (7, *pages[7][1:]), (2000, "http://long", "x" * 9_000_000, None)]
    got = warc.page_captures(spark.createDataFrame(pages, PAGES)).collect()
    assert len(got) == 303  # the repeated row counts once
    html = sorted({(p[0], p[2] or "") for p in pages}, key=str)
    assert sorted(bytes(r.response.body).decode() for r in got) == sorted(h for _, h in html)
    for r in got:
        assert len(r.requests) == len(r.metadata) == 1
        assert r.response.status == 200 and r.response.content_type == "text/html; charset=utf-8"
        assert r.requests[0].content.startswith(b"GET /") and r.requests[0].target_uri == r.target_uri == r.metadata[0].target_uri
        assert b"fetchTimeMs" in r.metadata[0].content


def test_empty_table(spark):
    assert warc.page_captures(spark.createDataFrame([], PAGES)).collect() == []


def test_assembly_against_plain_loops(spark, tmp_path):
    rng = random.Random(5)
    records, links = [], {}
    for i in range(120):
        kind = rng.choice(["response", "request", "metadata", "warcinfo"])
        other = tuple(f"urn:{rng.randrange(120)}" for _ in range(rng.randrange(3)))
        links[f"urn:{i}"] = (kind, other)
        records.append(warc.record(kind, f"urn:{i}", f"http://{i}", "2024-01-01T00:00:00Z", f"HTTP/1.1 404 X\r\nA: b\r\n\r\nbody{i}".encode(), "application/http", other))
    records += records[:10]
    (tmp_path / "a.warc").write_bytes(b"".join(records[:50]))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records[50:]))
    (tmp_path / "c.warc").write_bytes(records[0][:-30])  # cut off
    got = warc.captures(warc.list_warc(spark, f"file://{tmp_path}")).collect()
    kinds = {k: v[0] for k, v in links.items() if v[0] != "warcinfo"}
    near = {k: set() for k in kinds}
    for k, (kind, other) in links.items():
        for o in other:
            if k in kinds and o in kinds:
                near[k].add(o)
                near[o].add(k)
    want = {k: {"request": set(), "metadata": set()} for k, kind in kinds.items() if kind == "response"}
    for k, kind in kinds.items():
        if kind == "response":
            continue
        owners = {o for o in near[k] if kinds[o] == "response"}
        if not owners:
            owners = {r for o in near[k] for r in near[o] if kinds[r] == "response"}
        for o in owners:
            want[o][kind].add(k)
    assert len(got) == len(want)
    for r in got:
        assert {x.record_id for x in r.requests} == want[r.capture_id]["request"]
        assert {x.record_id for x in r.metadata} == want[r.capture_id]["metadata"]
        assert r.response.status == 404 and r.response.body == f"body{r.capture_id[4:]}".encode()


def response(i, body=b"body", head=b""):
    content = b"HTTP/1.1 200 OK\r\n" + head + b"Content-Type: text/html\r\n\r\n" + body
    return warc.record("response", f"urn:{i}", f"http://{i}", "2024-01-01T00:00:00Z", content, "application/http")


def ids(stream):
    return [r["record_id"] for r in warc.parse_records(stream)]


BROKEN = {
    "no length": b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\n\r\nsome content\r\n\r\n",
    "bad length": response("x").replace(b"Content-Length: ", b"Content-Length: -"),
    "too short a length": response("x", b"y" * 50).replace(b"Content-Length: ", b"Content-Length: 1\r\nX: "),
    "too long a length": response("x").replace(b"Content-Length: ", b"Content-Length: 9"),
    "no length, cut head": b"WARC/1.1\r\nWARC-Type: response\r\n",
    "foreign bytes": b"\x00\x01\xff not a record\r\nmore\r\n",
}


@pytest.mark.parametrize("broken", BROKEN.values(), ids=BROKEN)
def test_a_broken_record_loses_no_other(broken):
    data = response(0) + broken + response(1) + response(2)
    assert ids(io.BytesIO(data)) == ["urn:0", "urn:1", "urn:2"]


def gunzipped(data):
    return ids(io.BufferedReader(warc._Gunzip(io.BytesIO(data))))


def test_damaged_gzip_members():
    member = lambda i: gzip.compress(response(i, random.Random(i).randbytes(5000)))
    a, b, c = map(member, range(3))
    assert gunzipped(a + b + c + b"\0" * 700) == ["urn:0", "urn:1", "urn:2"]
    assert gunzipped(a + b"\0" * 700 + b + b"junk" + c) == ["urn:0", "urn:1", "urn:2"]
    assert gunzipped(a + b + c[:-3000]) == ["urn:0", "urn:1"]
    hurt = bytearray(b)
    hurt[2000:2040] = bytes(40)
    assert gunzipped(a + bytes(hurt) + c) in (["urn:0", "urn:2"], ["urn:0", "urn:1", "urn:2"])
    assert gunzipped(a + b[:2000] + c) == ["urn:0", "urn:2"]
    assert gunzipped(b"") == gunzipped(b"no gzip at all") == []


def test_long_heads_ties_and_pages_of_one_url(spark, tmp_path):
    long = response(0, head=b"X: " + b"a" * 20_000 + b"\r\n")
    none = warc.record("response", "urn:3", "http://3", "2024", b"HTTP/1.1 204 No\r\n\r\ncontent-type: body", "application/http")
    (tmp_path / "a.warc").write_bytes(long + response(1, b"zz") + response(1, b"aa") + none)
    (tmp_path / "b.warc").write_bytes(response(1, b"mm") + response(1, b"aa"))
    got = {r.capture_id: r.response for r in warc.captures(warc.list_warc(spark, f"file://{tmp_path}")).collect()}
    assert got["urn:0"].content_type == "text/html" and got["urn:0"].status == 200 and got["urn:0"].body == b"body"
    assert got["urn:1"].body == b"aa" and got["urn:3"].content_type == "" and len(got) == 3
    pages = [(1, "http://a", "one", None), (1, "http://a", "two", None), (None, "http://b", "x", None), (None, "http://b", "y", None)]
    rows = warc.page_captures(spark.createDataFrame(pages + pages[:1], PAGES)).collect()
    assert sorted(bytes(r.response.body).decode() for r in rows) == ["one", "two", "x", "y"]
    assert all(len(r.requests) == len(r.metadata) == 1 for r in rows)
