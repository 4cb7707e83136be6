"""WARC archives: round trips, revisits, and broken records."""

import gzip

import pytest

from goldweave.llm import warc

ROWS = [(3, "http://a/", "<p>same</p>"), (1, "http://b/\r\nX: y", "<p>same</p>"), (2, None, None), (5, "u", ""),
        (4, "u", "x" * 100_000), (6, "u", "é\r\n" * 9000), (7, "u", "x" * 100_000), (7, "u", "x" * 100_000),
        (4, "u", "x" * 100_000), (None, "u", "only"), (None, "u", "<p>same</p>")]


def test_pages_come_back(spark, tmp_path):
    table = spark.createDataFrame([(*r, "z") for r in ROWS], "page_id long, url string, html string, sum string")
    warc.write_warc(table, str(tmp_path / "a"), segment_bytes=4096)
    found = warc.read_warc(spark, str(tmp_path / "a")).collect()
    assert all(r.problem is None for r in found)
    first = {}
    for page, _, html in ROWS:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    expected = []
    for page, _, html in ROWS:
        payload = (html or "").encode()
        own = first.get(html or "")
        again = page != own
        expected.append((page, len(payload), warc.digest_of(payload), "revisit" if again else "response",
                         own if again else None))
    key = str
    assert sorted((tuple(r)[:5] for r in found), key=key) == sorted(expected, key=key)
    warc.write_warc(table, str(tmp_path / "b"), min_bytes=10**9)
    assert {r.record_type for r in warc.read_warc(spark, str(tmp_path / "b")).collect()} == {"response"}
    warc.write_warc(table.limit(0), str(tmp_path / "c"))
    assert warc.read_warc(spark, str(tmp_path / "c")).count() == 0


def test_missing_segments_and_wrong_lengths_are_told(spark, tmp_path):
    parts = list(warc.page_records(1, "u", b"y" * 9000, None, "0-1", 2000))
    cases = {"missing": parts[:1] + parts[2:], "total": parts[:-1] + [parts[-1].replace(
        b"Total-Length: ", b"Total-Length: 1")], "sound": parts[::-1], "none": parts[:-1]}
    problems = {}
    for name, records in cases.items():
        path = str(tmp_path / name)
        rows = [(0, k, bytearray(gzip.compress(r))) for k, r in enumerate(records)]
        spark.createDataFrame(rows, warc.ARCHIVE).write.parquet(path)
        problems[name] = [r.problem for r in warc.read_warc(spark, path).collect()]
    assert problems == {"missing": ["segments missing or repeated"], "total": ["wrong total length"],
                        "sound": [None], "none": ["no total length"]}


def test_framing():
    assert warc.unchunked(b"4;x=y\r\nab\r\n\r\n1\r\nc\r\n0\r\nT: 1\r\n\r\n") == b"ab\r\nc"
    assert warc.unchunked(b"0a \t;x\r\n0123456789\r\n0\r\n\r\n") == b"0123456789"
    for broken in (b"", b"5\r\nabc", b"zz\r\n", b"2\r\nab\r\n-2\r\n0\r\n\r\n", b"2\r\nab\r\n-6\r\n0\r\n\r\n",
                   b"1_0\r\n", b"+1\r\na\r\n0\r\n\r\n", b"0x1\r\na\r\n0\r\n\r\n", b"\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)


def write(spark, path, records):
    rows = [(0, k, bytearray(gzip.compress(r))) for k, r in enumerate(records)]
    spark.createDataFrame(rows, warc.ARCHIVE).write.parquet(path)


def test_revisits_refer_to_records_that_are_there(spark, tmp_path):
    table = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    warc.write_warc(table, str(tmp_path / "a"), segment_bytes=4096)
    ids, referred = {}, []
    for r in spark.read.schema(warc.ARCHIVE).parquet(str(tmp_path / "a")).collect():
        for h, _ in warc.parse_records(bytes(r.content)):
            assert h["warc-record-id"] not in ids
            ids[h["warc-record-id"]] = h
            if "warc-refers-to" in h:
                referred.append((h["warc-refers-to"], h["warc-payload-digest"]))
    assert referred
    for name, digest in referred:
        assert ids[name]["warc-type"] == "response" and ids[name]["warc-payload-digest"] == digest


def test_records_of_others(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\n\r\nhello"
    foreign = [warc.record([("WARC-Type", "response"), ("WARC-Record-ID", i)], body) for i in (
        "<urn:uuid:6d058047-ede2-4a13-be79-90c17c631dd4>", "<urn:page:x;row=1>", "<urn:page:5>")]
    bad = [warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:7;row=1>")],
                       b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n2\r\nab\r\n-6\r\n0\r\n\r\n")]
    write(spark, str(tmp_path / "a"), foreign + bad)
    found = warc.read_warc(spark, str(tmp_path / "a")).collect()
    assert sorted((r.page_id is None, r.payload_bytes, r.problem) for r in found if r.payload_bytes) == [
        (True, 5, None)] * 3
    assert [(r.page_id, r.problem) for r in found if r.problem] == [(7, "a chunk's size is no hexadecimal number")]


def test_a_long_payload_is_put_together_in_one_go(spark, tmp_path):
    page = "0123456789abcdef" * (1 << 20)
    warc.write_warc(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"), str(tmp_path / "a"))
    row = warc.read_warc(spark, str(tmp_path / "a")).first()
    assert (row.payload_bytes, row.payload_digest, row.problem) == (16 << 20, warc.digest_of(page.encode()), None)
