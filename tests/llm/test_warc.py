import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from clinspark.llm import warc


def through_archives(spark, pages, tmp_dir, **options):
    path = os.path.join(tmp_dir, "archives")
    warc.write_archives(pages, path, **options)
    return path, warc.read_archives(spark, path)


def by_hand(rows):
    out = []
    for r in rows:
        payload = (r.html or "").encode()
        same = [x.page_id for x in rows if (x.html or "").encode() == payload]
        ids = [x for x in same if x is not None]
        first = min(ids) if ids and len(payload) >= 100 and len(same) > 1 else None
        revisit = first is not None and (r.page_id is None or r.page_id > first)
        out.append((r.page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=str)


def resolved(found):
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r) for r in warc.resolve(found).select(*cols).collect()), key=str)


def test_pages(spark, tmp_dir):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages = pages.unionByName(pages.where("page_id % 3 = 0").withColumn("page_id", F.col("page_id") + 1000))
    _, found = through_archives(spark, pages, tmp_dir, per_file=7)
    assert resolved(found) == by_hand(pages.collect())


def test_odd_pages(spark, tmp_dir):
    tricky = "x" * 90 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "http://a/\r\nX: y", tricky), (2, None, tricky), (None, None, tricky), (3, "u", None), (4, "u", ""), (5, "é", "é" * 50),
            (6, "u", "é" * 50), (7, "u", "a" * 99), (8, "u", "a" * 99), (9, "u", "\r\n" * 60), (9, "u", "\r\n" * 60), (None, "u", "z" * 200),
            (None, "v", "z" * 200), (10, "u", "long " * 400_000), (11, "u", "long " * 400_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit(c) for c in ("digest", "bytes", "value", "original", "payload")})
    _, found = through_archives(spark, pages, tmp_dir)
    assert resolved(found) == by_hand(pages.collect())


def test_archives_hold_each_payload_once(spark, tmp_dir):
    pages = spark.createDataFrame([(i, "u", "same page " * 50) for i in range(30)], "page_id long, url string, html string")
    path, found = through_archives(spark, pages, tmp_dir)
    raw = b"".join(gzip.open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".gz"))
    assert raw.count(b"WARC/1.1\r\n") == 30 and raw.count(b"same page same page") == 25
    assert {r.record_type for r in found.collect()} == {"response", "revisit"}


def test_a_changed_payload_is_noticed():
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 3"
    with pytest.raises(ValueError, match="digest"):
        import pyarrow as pa
        list(warc._rows(iter([pa.RecordBatch.from_pydict({"value": [head.decode(), "abc"]})])))
    with pytest.raises(ValueError, match="ends within"):
        list(warc._parsed(iter([head, b"a"])))


def test_no_pages(spark, tmp_dir):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    _, found = through_archives(spark, pages, tmp_dir)
    assert warc.resolve(found).collect() == []
