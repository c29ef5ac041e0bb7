"""WARC archives with revisit resolution (operator 7).

Headers (page id, payload digest, payload length) are grouped by digest: of the pages with
one payload of at least ``MIN_BYTES``, that with the largest id stays a response, the others
become revisit records that refer to it.  The groups with copies are joined back to the pages
(hot digests apart, see ``join_hot_apart``) and every page becomes one record with a fresh
header.  Records are WARC/1.1: header, HTTP response head, payload, two line breaks, which is
what Spark's text writer makes with that line separator, gzip-compressed; every executor
writes its own files into the shared folder.  A file holds at most ``RECORDS_PER_FILE``.

Archives are read back as binary files and cut by Content-Length, one file at a time; every
response's payload is checked against its digest.

Cases: a null payload is empty; a null url becomes a URN; line breaks and blanks in a url are
escaped; a page without id is never referred to and never a revisit of another; rows that
repeat the largest id of a group are all responses.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.config import materialize
from orderlake.llm.common import join_hot_apart

MIN_BYTES = 1000
RECORDS_PER_FILE = 5000
# Names and formats of WARC/1.1.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
RECORD = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
          "refers_to bigint, payload string")


def _payload(html: Column) -> Column:
    return F.coalesce(html, F.lit(""))


def resolve_revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, html with payload_bytes, payload_digest and refers_to (null for a response)."""
    payload = _payload(F.col("html"))
    rows = pages.select("page_id", "url", "html", F.octet_length(payload).cast("bigint").alias("payload_bytes"),
                        F.sha1(payload.cast("binary")).alias("payload_digest"))
    copies = materialize(
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest").agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("original").isNotNull()), "payload-copies")
    joined = join_hot_apart(rows, copies, "payload_digest", "n")
    return joined.withColumn("refers_to", F.when(F.col("page_id") < F.col("original"), F.col("original"))).drop("original")


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit("page"), F.coalesce(page_id.cast("string"), F.lit("")), digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _lines(*lines: Column) -> Column:
    """Header lines, each closed by a line break; null lines are left out."""
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n"))


def records(resolved: DataFrame, date: str) -> DataFrame:
    """One column ``value``: the record as text, without the two line breaks that close it."""
    revisit = F.col("refers_to").isNotNull()

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)

    block = F.concat(F.lit(HTTP_HEAD), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"),
                     F.when(revisit, F.lit("")).otherwise(_payload(F.col("html"))))
    url = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]+", "%20"),
                     F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none"))))
    head = _lines(
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, line("WARC-Refers-To", _record_id(F.col("refers_to"), F.col("payload_digest")))),
        line("Page-ID", F.col("page_id").cast("string")),
        F.when(revisit, line("Refers-To-Page-ID", F.col("refers_to").cast("string"))),
        line("Payload-Length", F.col("payload_bytes").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        line("Content-Length", F.octet_length("block").cast("string")))
    return (resolved.withColumn("block", block)
            .select(F.concat(head, F.lit("\r\n"), F.col("block")).alias("value")))


def write_archives(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z",
                   min_bytes: int = MIN_BYTES) -> None:
    """Write the pages as deduplicated archives (part-*.txt.gz) into ``path``."""
    (records(resolve_revisits(pages, min_bytes), date).write
     .option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE)
     .text(path))


def parse(stream: io.BufferedIOBase) -> Iterator[dict]:
    """The records of one archive."""
    while version := stream.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        head = {}
        while line := stream.readline().rstrip(b"\r\n").decode():
            name, _, value = line.partition(": ")
            head[name] = value
        block = stream.read(int(head["Content-Length"]))
        stream.read(4)
        payload = block.partition(b"\r\n\r\n")[2]
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        revisit = head["WARC-Type"] == "revisit"
        if not revisit and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {head['WARC-Record-ID']} doesn't have its digest")
        page, original = head.get("Page-ID"), head.get("Refers-To-Page-ID")
        yield {"page_id": page and int(page), "url": head["WARC-Target-URI"],
               "payload_bytes": int(head["Payload-Length"]) if revisit else len(payload), "payload_digest": digest,
               "record_type": head["WARC-Type"], "refers_to": original and int(original),
               "payload": None if revisit else payload.decode()}


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per record; ``payload`` is null for revisits (or left out)."""
    fields = [f for f in RECORD.split(", ") if payloads or not f.startswith("payload ")]
    names = [f.split()[0] for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"bigint": pa.int64(), "string": pa.string()}
        schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in fields])
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for r in parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                    rows.append({n: r[n] for n in names})
                    size += len(r["payload"] or "") if payloads else 100
                    if size > 1 << 23:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, ", ".join(fields))


def restore(records: DataFrame) -> DataFrame:
    """page_id, url, payload with the payload of every revisit taken from the response it refers to."""
    responses = records.where(F.col("record_type") == "response")
    originals = responses.select(F.col("page_id").alias("refers_to"), F.col("payload")).dropDuplicates(["refers_to"])
    revisits = records.where(F.col("record_type") == "revisit").drop("payload").join(originals, "refers_to")
    columns = ["page_id", "url", "payload"]
    return responses.select(*columns).unionByName(revisits.select(*columns))
