import base64
import gzip
import hashlib
import io

import pytest

from episodeframes.llm import arc_warc as A
from episodeframes.llm.common import scratch_path


def brute(rows):
    """(page_id, bytes, digest, type, refers_to) by the contract."""
    keep = {}
    for page, _, html in rows:
        keep[html or ""] = max(keep.get(html or "", -1), page)
    for page, _, html in rows:
        raw = (html or "").encode()
        same = keep[html or ""] == page
        yield page, len(raw), base64.b32encode(
            hashlib.sha1(raw).digest()
        ).decode(), "response" if same else "revisit", None if same else keep[html or ""]


ROWS = [
    (1, "http://a/x y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://b/", None), (4, "http://c/", ""), (5, "http://d/\n1", "x" * 200_000),
    (6, "https://e/", "line\r\n\r\nHTTP/1.1 200\n"), (7, "http://a/", "<p>é</p>")
]


def test_query(spark):
    pages = spark.createDataFrame([(*r, "extra") for r in ROWS], "page_id long, url string, html string, record_type string").repartition(4)
    got = A.archives_query(spark, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(ROWS), key=str)


def test_empty(spark):
    assert A.archives_query(spark, spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_null_and_repeated_ids(spark):
    pages = spark.createDataFrame([(None, "http://a/", "x"), (1, "http://a/", "x"), (1, "http://a/", "x")], "page_id long, url string, html string")
    got = sorted((r.record_type, r.page_id or 0, r.refers_to) for r in A.archives_query(spark, pages).collect())
    assert got == [("response", 1, None), ("revisit", 0, 1), ("revisit", 1, 1)]


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    data = A.arc_filedesc(version, "n.arc", "20010203040506") + A.arc_record(
        version, "http://a/", "20010203040506", "text/html", b"HTTP/1.0 200 OK\r\n\r\nab\n\nc"
    ) + A.arc_record(version, "dns:a", "20010203040506", "text/dns", b"")
    found = list(A.read_arc(io.BytesIO(data)))
    assert [(v, f["URL"], b) for v, f, b in found[1:]] == [(version, "http://a/", b"HTTP/1.0 200 OK\r\n\r\nab\n\nc"), (version, "dns:a", b"")]
    warc = b"".join(A.member(A.converted("p", i, f, b, None)) for i, (_, f, b) in enumerate(found))
    records = list(A.read_warc(io.BytesIO(gzip.decompress(warc))))
    assert [r[0]["WARC-Type"] for r in records] == ["warcinfo", "response", "resource"]
    assert records[1][0]["WARC-Date"] == "2001-02-03T04:05:06Z" and records[1][1].endswith(b"ab\n\nc")


def test_declared_length_is_held():
    with pytest.raises(ValueError):
        list(A.read_arc(io.BytesIO(A.arc_filedesc(1, "n", "2001") + b"http://a/ 0.0.0.0 2001 text/html 10\nabc")))


def test_min_bytes(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    arc = A.write_arc(pages, scratch_path(spark, "arc"))
    got = A.read_archives(A.convert_archives(arc, scratch_path(spark, "warc"), min_bytes=3)).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def test_half_of_all_pages_with_one_payload(spark, monkeypatch):
    """A common payload, one that half of all records have, is joined by broadcast; the result is the same."""
    from episodeframes.llm import common

    monkeypatch.setattr(common, "LIGHT", 8)
    rows = [(i, f"http://h/{i}", "<p>gone</p>" if i % 2 else f"page {i % 300}") for i in range(1, 601)] + [(700 + i, None, None) for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    got = A.archives_query(spark, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows), key=str)
