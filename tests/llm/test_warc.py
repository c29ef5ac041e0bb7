"""WARC archives: round trip, revisits and odd rows."""

import hashlib
import io

import pytest

from orderlake.config import scratch_path
from orderlake.llm import warc

SCHEMA = "page_id bigint, url string, html string, title string"
BIG = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 100
PAGES = [
    (1, "http://a/", BIG, "x"), (5, "http://b/ c\r\nd", BIG, "x"), (3, None, BIG, "x"), (5, "http://b/", BIG, "x"),
    (None, "http://n/", BIG, "x"), (6, "http://c/", "small", "x"), (7, "http://d/", "small", "x"), (8, "http://e/", None, None),
    (9, "http://f/", "", None), (10, "http://g/", "y" * 999, "x"), (11, "http://h/", "y" * 999, "x"),
    (12, "http://i/", "z" * 1000, "x"), (13, "http://j/", "z" * 1000, "x"), (14, "http://k/", "\n\n" + "q" * 200_000, "x"),
]


@pytest.fixture(scope="module")
def archive(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(PAGES, SCHEMA).repartition(4), path)
    return warc.read_archives(spark, path).cache()


def expected():
    out = []
    for page, _, html, _ in PAGES:
        data = (html or "").encode()
        same = [p for p, _, h, _ in PAGES if (h or "").encode() == data and p is not None]
        revisit = len(data) >= 1000 and page is not None and page < max(same)
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    max(same) if revisit else None))
    return sorted(out, key=repr)


def test_records(archive):
    got = archive.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected()


def test_payloads_come_back(archive):
    got = sorted(((r.page_id, r.payload) for r in warc.restore(archive).collect()), key=repr)
    assert got == sorted(((p, h or "") for p, _, h, _ in PAGES), key=repr)


def test_urls_are_one_line(archive):
    assert {r.url for r in archive.where("page_id IN (3, 5)").collect()} == {"urn:page:3", "http://b/%20c%20d", "http://b/"}


def test_empty_table(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_archives(spark, path).count() == 0


def test_many_copies_of_one_payload(spark):
    path = scratch_path(spark, "warc-test")
    pages = [(i, f"http://x/{i}", "hot" * 500 if i % 3 else f"{i} " * 300, "t") for i in range(900)]
    warc.write_archives(spark.createDataFrame(pages, SCHEMA).repartition(6), path)
    got = warc.read_archives(spark, path, payloads=False)
    assert got.count() == 900
    assert got.where("record_type = 'revisit'").groupBy("refers_to").count().collect() == [(899, 599)]


def test_wrong_payload_is_found():
    record = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nWARC-Payload-Digest: sha1:00\r\n"
              b"WARC-Target-URI: u\r\nPayload-Length: 1\r\nContent-Length: 5\r\n\r\n\r\n\r\na\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(record)))
