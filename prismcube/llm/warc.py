"""WARC archives: write captures as transactions, read archives back, assemble transactions (operator 10).

A capture is three records: a request, a response (or a revisit of one), and
metadata. The request and the metadata name the response in WARC-Concurrent-To.
Assembly joins the three kinds through that field and gives one nested row for
each capture. Records are written by Spark's text writer, whose line separator
is the double line break that ends every WARC record, and read back by
Content-Length, so a payload may hold any text.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from itertools import islice
from typing import BinaryIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prismcube.llm.common import States, scratch, text_of

END = "\r\n"
#: Records in a file and bytes of payloads, unless one payload is larger: this is what a reading task holds. Records parsed at once. Repeated payloads that are broadcast at most.
RECORDS_A_FILE, FILE_BYTES, RECORDS_AT_ONCE, BROADCAST_ROWS = 3000, 64 << 20, 500, 500_000
#: Sizes of payloads up to which captures share files; a file's number of records follows from the size.
SIZES = (16 << 10, 128 << 10, 1 << 20, 8 << 20, 64 << 20)
REQUEST, RESPONSE, REVISIT, METADATA = "request", "response", "revisit", "metadata"
RECORD = "type string, id string, concurrent_to string, refers_to string, target string, payload_digest string, page_id long, payload binary, payload_bytes long, found_digest string"


def captures(pages: DataFrame, states: States, least: int = 1000) -> DataFrame:
    """pages as captures: capture (an id), page_id, url, html, digest, size, first (the capture it revisits, if any).

    Of pages with equal payloads of at least ``least`` bytes the one with the largest page_id is the response, the others
    revisit it; ties go to the later row. A null html is an empty payload, a null page_id comes before all others. The
    captures are written once, so that each has one id however often it is read.
    """
    base = pages.select("page_id", "url", text_of("html").alias("html"), F.monotonically_increasing_id().alias("capture"))
    base = states.save(base.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html").cast("long")}), "base")
    first = base.filter(F.col("size") >= least).groupBy("digest").agg(F.max(F.struct("page_id", "capture"))["capture"].alias("first"), F.count("*").alias("n"))
    first = states.save(first.filter("n > 1").select("digest", "first"), "first")
    small = first.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = base.join(F.broadcast(first) if small else first, "digest", "left")
    return joined.withColumn("first", F.when(F.col("first") != F.col("capture"), F.col("first")))


def header(fields: dict[str, Column]) -> Column:
    """The header block of a record; a field whose value is null is left out."""
    lines = [F.coalesce(F.concat(F.lit(f"{k}: "), v.cast("string"), F.lit(END)), F.lit("")) for k, v in fields.items()]
    return F.concat(F.lit(f"WARC/1.1{END}"), *lines, F.lit(END))


def urn(kind: str, capture: Column) -> Column:
    return F.concat(F.lit(f"<urn:capture:{kind}:"), capture.cast("string"), F.lit(">"))


def records(rows: DataFrame, date: str) -> DataFrame:
    """The three records of each capture as text, one row for each record."""
    capture, url = F.col("capture"), F.regexp_replace(text_of("url"), r"[\r\n]", "")
    http = lambda first: F.concat(F.lit(first), F.lit(END))
    path = F.regexp_extract(url, r"^[^:]*://[^/?#]*([^#]*)", 1)
    ask = F.concat(F.lit("GET "), F.when(path == "", F.lit("/")).otherwise(path), F.lit(f" HTTP/1.1{END}{END}"))
    head = F.concat(http("HTTP/1.1 200 OK"), http("Content-Type: text/html; charset=utf-8"), F.lit("Content-Length: "), F.col("size").cast("string"), F.lit(END + END))
    again = F.col("first").isNotNull()
    body = F.when(again, head).otherwise(F.concat(head, F.col("html")))
    note = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(END))

    def record(kind: Column, own: Column, block: Column, more: dict[str, Column]) -> Column:
        fields = {"WARC-Type": kind, "WARC-Record-ID": own, "WARC-Date": F.lit(date), "WARC-Target-URI": url, **more, "Content-Length": F.octet_length(block)}
        return F.concat(header(fields), block)

    answer = urn(RESPONSE, capture)
    reply = {"WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.col("digest")), "WARC-Refers-To": F.when(again, urn(RESPONSE, F.col("first"))), "WARC-Profile": F.when(again, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), "Content-Type": F.lit("application/http; msgtype=response")}
    three = F.array(
        record(F.lit(REQUEST), urn(REQUEST, capture), ask, {"WARC-Concurrent-To": answer, "Content-Type": F.lit("application/http; msgtype=request")}),
        record(F.when(again, F.lit(REVISIT)).otherwise(F.lit(RESPONSE)), answer, body, reply),
        record(F.lit(METADATA), urn(METADATA, capture), note, {"WARC-Concurrent-To": answer, "Content-Type": F.lit("application/warc-fields")}),
    )
    return rows.select(F.explode(three).alias("value"))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", least: int = 1000, compression: str = "gzip") -> None:
    """Write pages (page_id, url, html) as WARC files under path.

    Captures of like size are written together, so that the number of records bounds a file's bytes: one of large pages
    has few of them.
    """
    states = States(pages.sparkSession, "captures")
    rows = captures(pages, states, least)
    place = F.lit(len(SIZES))
    for i in reversed(range(len(SIZES))):
        place = F.when(F.col("size") <= SIZES[i], i).otherwise(place)
    for i in sorted(r["place"] for r in rows.select(place.alias("place")).distinct().collect()) or [0]:  # at most six
        most = max(1, min(RECORDS_A_FILE, FILE_BYTES // SIZES[i] if i < len(SIZES) else 1))
        some = records(rows.filter(place == i), date)
        some.write.mode("append").option("lineSep", END + END).option("maxRecordsPerFile", most).option("compression", compression).text(path)
    states.clear("base", "first")


def parse(archive: BinaryIO, keep_payload: bool) -> Iterator[tuple]:
    """The records of one uncompressed archive, read one after the other."""
    while line := archive.readline():
        if not line.startswith(b"WARC/1."):
            continue
        fields = {}
        while line := archive.readline().strip():
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        block, kind = archive.read(int(fields["Content-Length"])), fields["WARC-Type"]
        payload = block.partition(b"\r\n\r\n")[2] if kind == RESPONSE else None
        page = block[len("page-id: ") :].strip() if kind == METADATA else b""
        yield (
            kind, fields["WARC-Record-ID"], fields.get("WARC-Concurrent-To"), fields.get("WARC-Refers-To"), fields.get("WARC-Target-URI"), fields.get("WARC-Payload-Digest"), int(page) if page else None,
            payload if keep_payload else None, None if payload is None else len(payload), None if payload is None else hashlib.sha1(payload).hexdigest(),
        )


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """One row for each record of the archives under path (gzip or plain), with what its payload really holds."""
    names = [x.split()[0] for x in RECORD.split(", ")]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for raw in files["content"]:
                archive = io.BytesIO(raw) if raw[:2] != b"\x1f\x8b" else io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(raw)))
                found = parse(archive, keep_payload)
                while some := list(islice(found, RECORDS_AT_ONCE)):
                    yield pd.DataFrame(some, columns=names).astype({"page_id": "Int64", "payload_bytes": "Int64"})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(each, RECORD)


def assemble(found: DataFrame) -> DataFrame:
    """One nested row for each capture: capture, page_id, request, response, metadata, and for a revisit what it refers to.

    Requests and metadata are joined to the response or revisit that they are concurrent to; a response without them
    keeps nulls there. ``original`` is the response that a revisit refers to (its page, size and digest).
    """
    kind = F.col("type")
    answer = found.filter(kind.isin(RESPONSE, REVISIT)).select(F.col("id").alias("capture"), F.struct("type", "target", "refers_to", "payload_digest", "payload", "payload_bytes", "found_digest").alias("response"))
    asked = found.filter(kind == REQUEST).select(F.col("concurrent_to").alias("capture"), F.struct("id", "target").alias("request"))
    said = found.filter(kind == METADATA).select(F.col("concurrent_to").alias("capture"), F.struct("id", "page_id").alias("metadata"))
    whole = answer.join(asked, "capture", "left").join(said, "capture", "left")
    first = whole.filter(F.col("response.type") == RESPONSE).select(F.col("capture").alias("refers_to"), F.struct(F.col("metadata.page_id").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.found_digest").alias("found_digest")).alias("original"))
    none = F.concat(F.lit("none of "), F.col("capture"))  # what refers to nothing isn't gathered under one key
    return whole.withColumn("refers_to", F.coalesce("response.refers_to", none)).join(first, "refers_to", "left").drop("refers_to")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages to archives, read them back and assemble the captures: one row for each page.

    page_id, payload_bytes, payload_digest (of the full payload: a revisit's come from the response it refers to),
    record_type, refers_to. Null urls are written empty, repeated rows are captures of their own.
    """
    spark = pages.sparkSession
    at = scratch(spark, "warc")
    write_archives(pages, at)
    whole = assemble(read_archives(spark, at, keep_payload=False))
    return whole.select(
        F.col("metadata.page_id").alias("page_id"),
        F.coalesce("response.payload_bytes", "original.payload_bytes").alias("payload_bytes"),
        F.coalesce("response.found_digest", "original.found_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("original.page_id").alias("refers_to"),
    )


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, strlen(html) AS n, sha1(html) AS d FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS top FROM q)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM r
"""
