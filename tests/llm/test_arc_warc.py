"""ARC to WARC and back: exact round trip."""

import base64
import gzip
import hashlib
import io

import pytest

from shopshift.llm import arc_warc as A
from shopshift.llm.common import work_dir
from tests.llm.helpers import SF


def expected(rows):
    first, out = {}, {}
    for i, body in rows:
        k = base64.b32encode(hashlib.sha1((body or "").encode()).digest()).decode()
        first[k] = min(first.get(k, i), i)
        out[i] = (len((body or "").encode()), k)
    return {i: (n, k, "response" if first[k] == i else "revisit", None if first[k] == i else first[k]) for i, (n, k) in out.items()}


def test_round_trip_of_the_test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    pages = pages.unionByName(pages.limit(30).withColumn("page_id", pages.page_id + 100_000))
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in A.pages_through_warc(pages).collect()}
    assert got == expected([(r.page_id, r.html) for r in pages.collect()])


def test_edges(spark):
    rows = [(3, None, None), (1, "", ""), (2, "http://x/a b\n", "é\r\n\r\nWARC/1.0\n"), (2, "http://y", "é\r\n\r\nWARC/1.0\n"), (None, "u", "only"), (9, "z", "x" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in A.pages_through_warc(pages).collect()), key=str)
    assert got == sorted([(1, 0, "response", None), (3, 0, "revisit", 1), (2, 15, "response", None), (2, 15, "revisit", 2), (None, 4, "response", None), (9, 3_000_000, "response", None)], key=str)
    assert A.pages_through_warc(pages.limit(0)).count() == 0


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long one"), (4, "d", "long one")], "page_id long, url string, html string")
    arc, warc = work_dir(spark, "arc"), work_dir(spark, "warc")
    assert A.write_arc(pages, arc, roll_bytes=1) == 4  # a file for each record, of both versions
    assert {r.version for r in A.read_arc(spark, arc).collect()} <= {1, 2}
    assert A.arc_to_warc(spark, arc, warc, min_revisit_bytes=3) == 4
    got = {r.item_id: (r.record_type, r.digest_ok, r.payload and bytes(r.payload)) for r in A.read_warc(spark, warc, payloads=True).collect()}
    assert got == {1: ("response", True, b"xy"), 2: ("response", True, b"xy"), 3: ("response", True, b"long one"), 4: ("revisit", None, None)}


def test_header_lines_of_both_versions():
    v1 = b"filedesc://a.arc 0.0.0.0 20000101000000 text/plain 9\n1 0 x\nURL\n\nhttp://a 1.2.3.4 20000102030405 text/html 3\nabc\n"
    v2 = b"filedesc://a.arc 0.0.0.0 20000101000000 text/plain 200 - - 0 a.arc 5\n2 0 x\nhttp://a 1.2.3.4 20000102030405 text/html 200 - - 7 a.arc 3\nabc\n"
    for version, data in ((1, v1), (2, v2)):
        records = list(A.parse_arc(data))
        assert [r[0] for r in records] == [version, version]
        assert records[1][1]["URL"] == "http://a" and records[1][1]["Archive-length"] == "3" and records[1][2] == b"abc"
    for bad in (v1[:-3], v1 + b"http://b 1.2.3.4 2000 text/html x y z 1\na\n", b"no newline"):
        with pytest.raises(ValueError):
            list(A.parse_arc(bad))


def test_gzip_members_and_parser_errors():
    parts = [bytes([i]) * (i * 5000) for i in range(5)]
    assert A._gunzip(b"".join(A._gzip(p) for p in parts)) == b"".join(parts) == gzip.GzipFile(fileobj=io.BytesIO(b"".join(map(A._gzip, parts)))).read()
    with pytest.raises(ValueError):
        list(A.parse_warc(b"WARC/1.0\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))
    assert A._warc_date("2001") == "2001-00-00T00:00:00Z"
