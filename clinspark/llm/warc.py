"""WARC archives: revisit resolution by payload digest.

Headers (page, digest, length) are shuffled by payload digest; of records with
equal payloads of at least ``SMALLEST`` bytes the smallest page_id is written as
a response and the others as revisits of it, with fresh record ids, digests
and lengths. Reading parses the records by their lengths and joins each
revisit to the response it names.

Written by Spark's text writer with the record end (CRLF CRLF) as line
separator, so a file holds the records' exact bytes, gzip-compressed, under
whatever file system Spark writes to. Read by Spark's text reader with the same
separator, which streams the pieces of a file in order to the parser; a
payload may hold the separator or a WARC header itself.

Defined results: null html is an empty payload; payloads below the limit are
always responses. A null page_id is written without a page id and is larger
than any other; where a payload has no page_id at all, its records are responses. A page
repeated with the same page_id and payload is a response as often as it comes. A null or
multi-line url is left out or percent-encoded. Extra columns are ignored. Empty
tables give archives without records.
"""
from __future__ import annotations

import hashlib
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage

SMALLEST = 100
END = "\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = ("record_type string, record_id string, page_id long, url string, payload_bytes long, "
           "payload_digest string, refers_id string")


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.sha2(F.concat_ws("|", page_id.cast("string"), digest), 256)
    part = lambda a, n: F.substring(h, a, n)
    return F.concat_ws("-", F.concat(F.lit("urn:uuid:"), part(1, 8)), part(9, 4), part(13, 4), part(17, 4), part(21, 12))


def resolved(pages: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """``pages`` with payload, digest, bytes and, for revisits, the page_id of the response."""
    p = (pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
              .withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload").cast("long")))
    first = (p.where(F.col("bytes") >= smallest).groupBy("digest")
              .agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
              .where("n > 1 and original is not null").select("digest", "original"))
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("original"))
    return (p.join(stage(first, "op3-originals"), "digest", "left")
             .withColumn("original", F.when(later, F.col("original"))))


def records(pages: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """One column ``value``: the bytes of each record up to its end."""
    p = resolved(pages, smallest)
    revisit = F.col("original").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    block = F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    refers = F.concat(line("WARC-Refers-To", F.concat(F.lit("<"), _record_id(F.col("original"), F.col("digest")), F.lit(">"))),
                      line("WARC-Profile", F.lit(PROFILE)))
    kind = F.when(revisit, "revisit").otherwise("response")
    return p.select(F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<"), _record_id(F.col("page_id"), F.col("digest")), F.lit(">"))),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        F.coalesce(line("X-Page-Id", F.col("page_id").cast("string")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, refers).otherwise(F.lit("")),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block).alias("value"))


def write_archives(pages: DataFrame, path: str, smallest: int = SMALLEST, per_file: int = 20_000) -> None:
    (records(pages, smallest).write.mode("overwrite").option("lineSep", END).option("compression", "gzip")
        .option("maxRecordsPerFile", per_file).text(path))


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}


def _parsed(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; pieces are what stands between record ends."""
    end, held, size, head, need = END.encode(), [], 0, None, 0
    for piece in pieces:
        held += (piece, end)
        size += len(piece) + len(end)
        # a piece can end a header, a block or neither, and hold the start of what follows
        while held and size >= need:
            data = b"".join(held)
            if head is None:
                at = data.find(end)
                if at < 0:
                    held, need = [data], size + 1
                    break
                head = _headers(data[:at])
                data = data[at + len(end):]
                need = int(head["content-length"]) + len(end)
            else:
                if data[need - len(end):need] != end:
                    raise ValueError(f"record {head.get('warc-record-id')} has a wrong length")
                yield head, data[:need - len(end)]
                data, head, need = data[need:], None, 0
            held, size = ([data] if data else []), len(data)
    if held:
        raise ValueError("an archive ends within a record")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pieces():
        for b in batches:
            for x in b.column(0).cast(pa.binary()):
                yield x.as_py()

    names = ("record_type", "record_id", "page_id", "url", "payload_bytes", "payload_digest", "refers_id")
    types = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
    rows: list[tuple] = []

    def batch():
        cols = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], list(names))

    for head, block in _parsed(pieces()):
        kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha256:")
        payload = block
        if head.get("content-type", "").startswith("application/http"):
            payload = block[block.index(END.encode()) + len(END):]
        size = None
        if kind == "response":
            size = len(payload)
            if hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
        page = head.get("x-page-id")
        refers = head.get("warc-refers-to")
        rows.append((kind, head["warc-record-id"].strip("<>"), None if page is None else int(page),
                     head.get("warc-target-uri"), size, digest, refers and refers.strip("<>")))
        if len(rows) == 4096:
            yield batch()
            rows = []
    if rows:
        yield batch()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; a response's digest is checked against its payload."""
    pieces = spark.read.option("lineSep", END).text(path)
    return pieces.mapInArrow(_rows, RECORDS)


def resolve(found: DataFrame) -> DataFrame:
    """``read_archives`` rows with each revisit's payload_bytes and page taken from its response."""
    answers = (found.where("record_type = 'response'").groupBy(F.col("record_id").alias("a_id"))
                    .agg(F.min("page_id").alias("refers_to"), F.min("payload_bytes").alias("a_bytes")))
    revisits = (found.where("record_type = 'revisit'").join(answers, F.col("refers_id") == F.col("a_id"), "left")
                     .withColumn("payload_bytes", F.col("a_bytes")))
    out = ("page_id", "url", "payload_bytes", "payload_digest", "record_type")
    return (found.where("record_type = 'response'").select(*out, F.lit(None).cast("long").alias("refers_to"))
                 .unionByName(revisits.select(*out, "refers_to")))
