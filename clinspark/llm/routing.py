"""Passing compact notes between document chunks and content parts.

Documents are dealt to chunks of about ``CHUNK`` characters by a hash of the row,
so a chunk is small whatever a source or a group of copies holds. A pass over
the chunks sends records to content parts (``blobs``); a part compares what
it got and answers chunks, again with records; the next pass reads each chunk with
its answers. A string found in a third of all documents is one record per
chunk, not per document.
"""
from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import packed
from .common import text_hash, text_or_empty

CHUNK = 1 << 21
DOCS = 8192
BLOBS = "part int, records binary"
ANSWERS = "chunk int, records binary"
U = np.uint64
HOT = U(1 << 63)
FACTOR = 0x9E3779B97F4A7C15 | 1
FACTOR_2 = 0xD6E8FEB86659FD93


@dataclass
class Chunk:
    """A chunk's documents, and the records that it was answered."""

    number: int
    answers: np.ndarray
    doc_ids: list
    hashes: list
    texts: list[bytes]


class Dealt:
    """Documents with their chunk, and the numbers of chunks and parts."""

    def __init__(self, docs: DataFrame, per_part: int):
        chars, rows = docs.agg(F.sum(F.length("text")), F.count(F.lit(1))).first()
        self.chunks = max(1, -(-(chars or 0) // CHUNK), -(-rows // DOCS))
        self.parts = max(1, -(-(chars or 0) // per_part))
        self.bits = U(max(1, (self.chunks - 1).bit_length()))
        th = text_hash()
        self.docs = docs.select(F.pmod(F.xxhash64("doc_id", th), F.lit(self.chunks)).cast("int").alias("chunk"),
                                F.col("doc_id").cast("long").alias("doc_id"), th.alias("th"), text_or_empty().alias("text"))

    def __getstate__(self) -> dict:
        """Tasks need the numbers only."""
        return {k: v for k, v in self.__dict__.items() if k != "docs"}

    def noted(self, hashes: np.ndarray, chunk: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts and one-word records: the low bits of a hash and the chunk; a record is kept twice at most."""
        part = part_of(hashes, self.parts)
        record = (hashes << self.bits) | chunk.astype(U)
        order = np.argsort(record, kind="stable")
        record, part = record[order], part[order]
        keep = np.ones(len(record), bool)
        keep[2:] = record[2:] != record[:-2]
        return part[keep], record[keep]

    def low(self, hashes: np.ndarray) -> np.ndarray:
        """What a record keeps of a hash."""
        return (hashes << self.bits) >> self.bits

    def repeated(self, found: DataFrame, hot: int | None = None) -> DataFrame:
        """Answers to each chunk: its hashes that ``noted`` records hold at least twice.

        Those in more than ``hot`` chunks are marked with ``HOT``; column ``hot`` tells of rows that hold some.
        """
        bits, mask = self.bits, (U(1) << self.bits) - U(1)

        def compare(own: pa.Table) -> pa.Table:
            r = np.sort(np.concatenate([np.frombuffer(x.as_buffer(), U) for x in own.column("records")]))
            h = r >> bits
            same = h[1:] == h[:-1]
            r = np.unique(r[np.r_[same, False] | np.r_[False, same]])
            h, chunk = r >> bits, (r & mask).astype(np.int64)
            if hot is None:
                return table_of(packed(chunk, h), "chunk").append_column("hot", pa.array([False] * len(np.unique(chunk))))
            number, chunks = np.unique(h, return_inverse=True, return_counts=True)[1:]
            h = h | np.where(chunks[number] > hot, HOT, U(0))
            out = table_of(packed(chunk, h), "chunk")
            return out.append_column("hot", pa.array([bool((np.frombuffer(x.as_buffer(), U) >= HOT).any()) for x in out.column("records")], pa.bool_()))

        return found.groupBy("part").applyInArrow(compare, f"{ANSWERS}, hot boolean")

    def scan(self, fn: Callable[[np.ndarray, list[bytes]], Iterator[tuple[int, bytes]]], at_once: int = CHUNK) -> DataFrame:
        """Blobs that ``fn`` makes of the documents where they lie; it gets their chunks and texts."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                chunk, column, texts, first, held = b.column(0).to_numpy(), b.column(1).cast(pa.binary()), [], 0, 0
                for i in range(b.num_rows):
                    texts.append(column[i].as_py())
                    held += len(texts[-1])
                    if held >= at_once or i == b.num_rows - 1:
                        yield batch_of(fn(chunk[first:i + 1], texts), "part")
                        texts, first, held = [], i + 1, 0

        return self.docs.select("chunk", "text").mapInArrow(run, BLOBS)

    def read(self, answers: DataFrame, kind: np.dtype, fn: Callable[[Chunk], pa.RecordBatch], schema: str) -> DataFrame:
        """What ``fn`` makes of each chunk and its answers."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, blobs, rows = None, [], []

            def done():
                got = np.concatenate(blobs) if blobs else np.empty(0, kind)
                return fn(Chunk(now, got, *([list(x) for x in zip(*rows)] or [[], [], []])))

            for b in batches:
                chunk, is_doc, doc_id, th = (b.column(i).to_pylist() for i in range(4))
                text, records = b.column(4).cast(pa.binary()), b.column(5)
                for i in range(b.num_rows):
                    if chunk[i] != now:
                        if rows:
                            yield done()
                        now, blobs, rows = chunk[i], [], []
                    if is_doc[i]:
                        rows.append((doc_id[i], th[i], text[i].as_py()))
                    else:
                        blobs.append(np.frombuffer(records[i].as_py(), kind))
            if rows:
                yield done()

        docs = self.docs.select("chunk", F.lit(1).alias("is_doc"), "doc_id", "th", "text",
                                F.lit(None).cast("binary").alias("records"))
        notes = answers.select("chunk", F.lit(0).alias("is_doc"), F.lit(None).cast("long").alias("doc_id"),
                               F.lit(None).cast("long").alias("th"), F.lit(None).cast("string").alias("text"), "records")
        return (docs.unionByName(notes).repartition("chunk").sortWithinPartitions("chunk", "is_doc")
                    .mapInArrow(run, schema))


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (((hashes >> U(32)) * U(parts)) >> U(32)).astype(np.int64)


def batch_of(rows: Iterator[tuple[int, bytes]], key: str) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                       pa.array([r[1] for r in rows], pa.binary())], [key, "records"])


def table_of(rows: Iterator[tuple[int, bytes]], key: str) -> pa.Table:
    return pa.Table.from_batches([batch_of(rows, key)])


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2 ** 64, at least ``n`` of them."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16) * 5 // 4, base, U)
        have[0] = 1
        _powers[base] = np.multiply.accumulate(have)
    return _powers[base]


class Rolling:
    """Hashes of any stretch of a sequence of 64-bit symbols: sums of symbol times power, shifted back."""

    def __init__(self, symbols: np.ndarray, base: int = FACTOR):
        n = len(symbols)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(symbols * powers(base, n)[:n], out=self.sums[1:])
        self.back = powers(pow(base, -1, 1 << 64), n + 1)

    def windows(self, size: int) -> np.ndarray:
        """Raw hashes of all stretches of ``size`` symbols (n - size + 1, none if shorter)."""
        n = len(self.sums) - 1
        return (self.sums[size:] - self.sums[:n - size + 1]) * self.back[:n - size + 1] if n >= size else np.empty(0, U)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]


def member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Whether each value is among the sorted ones."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


def covered(starts: np.ndarray, size: int) -> np.ndarray:
    """Which places lie in a stretch of ``size`` places from one marked in ``starts``."""
    seen = np.cumsum(starts)
    seen[size:] -= seen[:-size].copy()
    return seen > 0
