"""WARC archives: writing, reading back and resolution of revisits.

Records are written by Spark's text writer with the record end ``CRLF CRLF`` as line separator, so that archives go to any store
Spark can write and a lost task leaves no half-written file. They are read back whole and cut by their Content-Length,
never by a separator that a payload might hold.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import stage_path
from .frame import OWN, refuse

CRLF = "\r\n"
#: Payloads of fewer bytes are always written in full.
LEAST_BYTES = 100
#: Records of an archive file at most, and bytes that these have at most: bounds what a reading task holds at once.
FILE_RECORDS, FILE_BYTES = 2000, 1 << 29
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = ("page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, "
           "record_id string, refers_to_record string, payload binary")


def _clean(value: Column) -> Column:
    """A header value: line breaks would start another header."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), "[\\r\\n]+", " ")


def digests(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with ``payload_bytes`` and ``payload_digest`` (bare hex SHA-256) of the UTF-8 html; null html is an empty payload."""
    refuse(pages, "payload_bytes", "payload_digest")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.withColumns({"payload_bytes": F.octet_length(payload).cast("long"), "payload_digest": F.sha2(payload, 256)})


def resolve_revisits(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``records`` (page_id, payload_bytes, payload_digest, ...) with ``record_type`` and ``refers_to``.

    Only (digest, smallest page_id, count) is shuffled and pre-aggregated to find originals; digests of a single record are dropped
    before the join, whose partitions the planner may split when one payload is hot. Every record that bears the smallest page_id of its payload is a response (so repeated
    rows stay alike); a null page_id is never an original unless all are null, in which case all are responses.
    """
    refuse(records, "record_type", "refers_to")
    originals = (records.filter(F.col("payload_bytes") >= least_bytes).groupBy(F.col("payload_digest").alias(f"{OWN}d"))
                 .agg(F.min("page_id").alias(f"{OWN}first"), F.count("*").alias(f"{OWN}n")).filter(f"{OWN}n > 1 AND {OWN}first IS NOT NULL").drop(f"{OWN}n"))
    joined = records.join(originals, (F.col("payload_digest") == F.col(f"{OWN}d")) & (F.col("payload_bytes") >= least_bytes), "left")
    again = F.col(f"{OWN}first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col(f"{OWN}first"))
    return (joined.withColumn("record_type", F.when(again, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(again, F.col(f"{OWN}first"))).drop(f"{OWN}d", f"{OWN}first"))


def _record(date: str) -> Column:
    """A WARC/1.1 record without its final CRLF CRLF; a revisit carries the HTTP headers only."""
    full = F.col("record_type") == "response"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("payload_bytes"), F.lit(CRLF * 2))
    block = F.concat(http, F.when(full, F.coalesce(F.col("html"), F.lit(""))).otherwise(F.lit("")))

    def identity(page: Column, digest: Column) -> Column:
        # a name made of the record's own values: a task that is run again writes the same record
        h = F.md5(F.concat_ws("|", page.cast("string"), digest))
        return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))

    def header(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    optional = F.when(full, "").otherwise(F.concat(
        header("WARC-Refers-To", identity(F.col("refers_to"), F.col("payload_digest"))), header("WARC-Refers-To-Page", F.col("refers_to").cast("string")),
        header("WARC-Profile", F.lit(PROFILE))))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", identity(F.col("page_id"), F.col("payload_digest"))), header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", _clean(F.col("url"))), header("WARC-Page", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))), optional,
        header("Content-Type", F.lit("application/http; msgtype=response")), header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF), block)


def records_a_file(pages: DataFrame, file_records: int = FILE_RECORDS, file_bytes: int = FILE_BYTES) -> int:
    """Records of a file such that even the largest pages (html) stay below ``file_bytes`` together; one for a page that is larger by itself."""
    largest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0
    return max(1, min(file_records, file_bytes // (largest + 4096)))


def write_archives(records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", file_records: int = FILE_RECORDS) -> None:
    """Write resolved records (page_id, url, html and the columns of ``resolve_revisits``) as gzipped WARC files of at most ``file_records`` under ``path``."""
    (records.select(_record(date).alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", file_records).text(path))


def _records(batches: Iterator[pa.RecordBatch], keep_payload: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            packed = memoryview(batch.column(0)[k].as_buffer())
            rows = []
            for headers, block in split_records(packed):
                body = block.find(b"\r\n\r\n") + 4
                payload = bytes(block[body:])
                full = headers["WARC-Type"] == "response"
                digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                if full and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"record {headers['WARC-Record-ID']} does not have the payload its digest tells")
                refers = headers.get("WARC-Refers-To-Page")
                rows.append((int(headers["WARC-Page"]) if headers["WARC-Page"] else None, headers["WARC-Target-URI"], headers["WARC-Type"], digest,
                             len(payload) if full else None, int(refers) if refers else None, headers["WARC-Record-ID"],
                             headers.get("WARC-Refers-To"), payload if keep_payload and full else None))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
            names = [c.split()[0] for c in RECORDS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(kinds), kinds)], names=names)


def split_records(packed) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a gzipped archive, decompressed piece by piece."""
    source, held = zlib.decompressobj(wbits=31), bytearray()
    at, step = 0, 1 << 18
    left = bytes(packed[at:at + step])

    def more() -> bool:
        nonlocal source, left, at
        while True:
            if source.eof:
                left = source.unused_data
                source = zlib.decompressobj(wbits=31)
            if not left:
                at += step
                left = bytes(packed[at:at + step])
                if not left:
                    return False
            got, left = source.decompress(left), b""
            if got:
                held.extend(got)
                return True

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("the archive ends inside a record header")
                return
        lines = held[:end].decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        size = int(headers["Content-Length"])
        while len(held) < end + 8 + size:
            if not more():
                raise ValueError("the archive ends inside a record")
        yield headers, bytes(held[end + 4:end + 4 + size])
        del held[:end + 8 + size]


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """A row a record of the archives under ``path``; revisits have no payload and null ``payload_bytes``. A response whose payload does not
    have its digest is an error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(lambda batches: _records(batches, payload), RECORDS)


def deduplicated_archives(pages: DataFrame, path: str, **options) -> DataFrame:
    """Write one record per page under ``path``, revisits instead of repeated payloads, and return the records read back with the payload size of
    revisits taken from the responses they refer to."""
    resolved = resolve_revisits(digests(pages.select("page_id", "url", "html")))
    write_archives(resolved, path, **{"file_records": records_a_file(pages), **options})
    back = read_archives(pages.sparkSession, path, payload=False).drop("payload")
    responses = back.filter("record_type = 'response'").select(F.col("payload_digest").alias(f"{OWN}d"), F.col("payload_bytes").alias(f"{OWN}b")).distinct()
    return (back.join(responses, F.col("payload_digest") == F.col(f"{OWN}d"), "left")
            .withColumn("payload_bytes", F.coalesce(F.col("payload_bytes"), F.col(f"{OWN}b"))).drop(f"{OWN}d", f"{OWN}b"))


def rewrite_archives(spark: SparkSession, source: str, path: str, least_bytes: int = LEAST_BYTES, **options) -> None:
    """Resolve the archives under ``source`` and write them deduplicated, with fresh headers, under ``path``.

    Responses and the revisits of an earlier crawl meet by payload digest: the response with the smallest page_id stays one, every other record of that
    payload becomes a revisit of it. A revisit whose original is in none of the archives stays as it is.
    """
    found = read_archives(spark, source)
    originals = (found.filter((F.col("record_type") == "response") & (F.col("payload_bytes") >= least_bytes))
                 .groupBy(F.col("payload_digest").alias(f"{OWN}d")).agg(F.min("page_id").alias(f"{OWN}first"), F.first("payload_bytes").alias(f"{OWN}b"))
                 .filter(f"{OWN}first IS NOT NULL"))
    joined = found.join(originals, F.col("payload_digest") == F.col(f"{OWN}d"), "left")
    first, was = F.col(f"{OWN}first"), F.col("record_type") == "response"
    original = was & (first.isNull() | F.col("page_id").eqNullSafe(first))
    fresh = joined.select(
        "page_id", "url", F.col("payload").cast("string").alias("html"), "payload_digest",
        F.coalesce("payload_bytes", f"{OWN}b", F.lit(0).cast("long")).alias("payload_bytes"),
        F.when(original, "response").otherwise("revisit").alias("record_type"),
        F.when(~original, F.coalesce(first, F.col("refers_to"))).alias("refers_to"))
    write_archives(fresh, path, **{"file_records": records_a_file(fresh), **options})


def archive_path(spark: SparkSession) -> str:
    return stage_path(spark, "warc")
