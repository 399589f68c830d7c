"""SimHash near-dedup by anchor-point covering.

Anchors are the words of a covering code: the product of two binary Golay
codes on bits 0-22 and 23-45 of a fingerprint. The Golay code covers its 23 bits with
radius 3, each word having one nearest code word, so a fingerprint has one
home anchor. Fingerprints at most ``THRESHOLD`` = 2 bits apart lie at most 3 + d1
and 3 + d2 from each other's home in the two parts, d1 + d2 <= 2. Each distinct
fingerprint is replicated to all anchors within those distances (61 on average)
and compared, over all 64 bits, with the fingerprints that live there. No link is lost.

A part of the anchors keeps the links it finds as a spanning forest, so a
group of copies gives as many rows as it has fingerprints, not pairs; connected
components over all parts give the groups.

Defined results: words are runs of characters that are not ASCII white space, of
the text with A-Z in lower case; null and empty texts have fingerprint zero and
are linked like any other. A component's id is the smallest doc_id that it
reaches (null if all are null). Rows with one doc_id are taken each on its own.
Extra columns are ignored. An empty table gives an empty result.
"""
from __future__ import annotations

from functools import lru_cache
from itertools import accumulate, combinations
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import packed, unpacked
from .common import components, keyed, same_key, stage, text_hash, text_or_empty

SHINGLE = 3
SEED = 42
THRESHOLD = 2
# binary Golay code: 12 message bits, 11 parity bits, generator x^11+x^9+x^7+x^6+x^5+x+1
GENERATOR = 0b101011100011
RADIUS = 3
RECORD = np.dtype([("anchor", "<u4"), ("fp", "<u8")])
HOME = np.uint32(1 << 31)
PART_RECORDS = 1 << 20


def _hashes(text: bytes, shingle: int) -> list[int]:
    words = text.lower().split()
    if len(words) < shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = list(accumulate(len(w) + 1 for w in words))
    return [digest(joined[a:b - 1], SEED) for a, b in zip([0, *ends], ends[shingle - 1:])]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per run of ``counts`` hashes, the bits set in over half of them (no hashes: zero)."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    n = counts[some]
    starts = np.cumsum(n) - n
    # runs of at most 255 hashes are added bytewise, eight bits at a time
    per = -(-n // 255)
    run = np.repeat(starts, per) + 255 * (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per))
    first = np.cumsum(per) - per
    lanes = np.uint64(0x0101010101010101)
    for k in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & lanes, run)
        ones = np.add.reduceat(sums.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        bits = (2 * ones > n[:, None]).astype(np.uint64)
        out[some] |= (bits << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(k))).sum(axis=1, dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, th and fp (the fingerprint as a signed long) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, counts = [], np.zeros(b.num_rows, np.int64)
            for i, text in enumerate(b.column(2).cast(pa.binary())):
                found = _hashes(text.as_py(), shingle)
                counts[i] = len(found)
                hashes.append(np.array(found, np.uint64))
            all_hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
            fp = majority(all_hashes, counts).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1), pa.array(fp)], ["doc_id", "th", "fp"])

    return (docs.select(F.col("doc_id").cast("long"), text_hash().alias("th"), text_or_empty().alias("text"))
                .mapInArrow(run, "doc_id long, th long, fp long"))


@lru_cache(1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Parity of each message; error patterns sorted by (syndrome, weight beyond the radius) with counts and starts."""
    def remainder(x: int) -> int:
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= GENERATOR << (bit - 11)
        return x

    parity = np.array([remainder(m << 11) for m in range(4096)], np.uint32)
    far = RADIUS + THRESHOLD
    patterns = np.array([sum(1 << i for i in c) for w in range(far + 1) for c in combinations(range(23), w)], np.uint32)
    cost = np.maximum(np.bitwise_count(patterns).astype(np.int64) - RADIUS, 0)
    syndrome = (parity[patterns >> 11] ^ (patterns & 0x7FF)).astype(np.int64)
    key = syndrome * (THRESHOLD + 1) + cost
    order = np.argsort(key, kind="stable")
    counts = np.bincount(key, minlength=2048 * (THRESHOLD + 1))
    return parity, patterns[order], counts, np.cumsum(counts) - counts


def anchors(fps: np.ndarray) -> np.ndarray:
    """A record per fingerprint and anchor that it is replicated to; its home is marked."""
    parity, patterns, counts, starts = _golay()
    halves = [(fps & np.uint64(0x7FFFFF)).astype(np.uint32), (fps >> np.uint64(23) & np.uint64(0x7FFFFF)).astype(np.uint32)]
    keys = [(parity[h >> 11] ^ (h & 0x7FF)).astype(np.int64) * (THRESHOLD + 1) for h in halves]
    out = []
    for c1 in range(THRESHOLD + 1):
        for c2 in range(THRESHOLD + 1 - c1):
            n1, n2 = counts[keys[0] + c1], counts[keys[1] + c2]
            n = n1 * n2
            who = np.repeat(np.arange(len(fps)), n)
            k = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
            e1 = patterns[starts[keys[0] + c1][who] + k // n2[who]]
            e2 = patterns[starts[keys[1] + c2][who] + k % n2[who]]
            rec = np.empty(len(who), RECORD)
            rec["anchor"] = ((halves[0][who] ^ e1) >> 11) << 12 | ((halves[1][who] ^ e2) >> 11)
            if c1 == c2 == 0:
                rec["anchor"] |= HOME
            rec["fp"] = fps[who]
            out.append(rec)
    return np.concatenate(out)


def _root(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def forest(records: np.ndarray, threshold: int = THRESHOLD, chunk: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """(fp, smallest fp of its group) for the fingerprints linked at the anchors of these records."""
    fps, node = np.unique(records["fp"], return_inverse=True)
    anchor = records["anchor"] & ~HOME
    order = np.argsort(anchor, kind="stable")
    anchor, node = anchor[order], node[order]
    home = np.flatnonzero(records["anchor"][order] & HOME)
    start = np.searchsorted(anchor, anchor[home], "left")
    size = np.searchsorted(anchor, anchor[home], "right") - start
    parent = np.arange(len(fps))
    home, start, size = home[size > 1], start[size > 1], size[size > 1]
    done = np.cumsum(size)
    # homes are taken in runs of about a chunk of pairs; one home's pairs are cut likewise
    at, skip = 0, 0
    while at < len(home):
        if size[at] > chunk:
            whole = np.arange(start[at] + skip, min(start[at] + skip + chunk, start[at] + size[at]))
            a, b = np.full(len(whole), node[home[at]]), node[whole]
            skip += chunk
            if skip >= size[at]:
                at, skip = at + 1, 0
        else:
            to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + chunk, "right")))
            while to > at + 1 and size[to - 1] > chunk:
                to -= 1
            n = size[at:to]
            a = np.repeat(node[home[at:to]], n)
            b = node[np.repeat(start[at:to], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            at = to
        near = (a != b) & (np.bitwise_count(fps[a] ^ fps[b]) <= threshold)
        a, b = a[near], b[near]
        while len(a):
            a, b = parent[a], parent[b]
            open_ = a != b
            a, b = a[open_], b[open_]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            parent = _root(parent)
    child = np.flatnonzero(parent != np.arange(len(fps)))
    return fps[child], fps[parent[child]]


def links(fps: DataFrame, part_records: int = PART_RECORDS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all within the threshold."""
    parts = max(1, -(-61 * fps.count() // part_records))

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rec = anchors(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            part = ((rec["anchor"] & ~HOME).astype(np.int64) * parts) >> 24
            rows = list(packed(part, rec))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                              pa.array([r[1] for r in rows], pa.binary())], ["part", "records"])

    def compare(found: pa.Table) -> pa.Table:
        a, b = forest(unpacked(found.column("records"), RECORD))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (fps.select("fp").mapInArrow(replicate, "part int, records binary")
               .groupBy("part").applyInArrow(compare, "a long, b long"))


def groups(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, th, fp and component_id."""
    marked = stage(fingerprints(docs, shingle), "op6-fingerprints")
    distinct = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "op6-distinct")
    roots = components(links(distinct), "op6")
    of = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    reach = of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(of.join(reach, "root").select("fp", "component_id"), "op6-components")
    return marked.join(named, "fp")


def dedup(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Of each group the row with the smallest doc_id (null last, then the smallest text hash) stays.

    A row repeated with that doc_id and text stays once. A group in which no row has a doc_id keeps one row.
    """
    found = stage(groups(docs, shingle), "op6-groups")
    # the component's id is null for several groups at most where rows have no doc_id
    key = F.coalesce("component_id", "fp")
    stays = (found.withColumn("_key", key).withColumn("_none", F.col("component_id").isNull())
                  .groupBy("_key", "_none").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "th")).alias("s"),
                                                F.count(F.lit(1)).alias("rows")))
    stays = stays.select(F.col("s.doc_id").alias("_d"), F.col("s.th").alias("_t"), "rows")
    rows = keyed(docs)
    alone = rows.join(stays.where("rows = 1"), same_key(), "left_semi")
    several = rows.join(stays.where("rows > 1"), same_key(), "left_semi").dropDuplicates(["doc_id", "th"])
    return alone.unionByName(several).select("row.*")
