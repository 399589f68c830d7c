"""Harmonic packing: classes of lengths, whose sequences take a fixed number of pieces.

Texts become token ids by a public tokenizer, then id 2. A piece of r tokens is of
class k = LENGTH div r, the lengths in (LENGTH / (k + 1), LENGTH / k], and a
sequence of class k takes k pieces, whatever they are: no search, no comparing of
lengths. Documents are cut so that this leaves little room: into the fewest
pieces (``cuts``) whose k copies fill a sequence but for ``SLACK`` tokens. Classes up to
``FINE`` are used so, and beyond it the powers of two.

How a document is cut follows from its length alone, so each task tokenizes, cuts
and fills sequences by itself, holding fewer than k pieces of each class. What its
classes hold at its end is numbered over all tasks, class by class, and
fills further sequences by count. Fewer than k pieces a class are left of the whole table, a
fixed number whatever its size; one task packs them. For it about ``EXACT`` documents, picked by hash,
are cut into powers of two: those pieces fill the gaps that the others leave, the rest stack without gaps, and the
last, short sequence is parted into powers of two, which need no padding.

Defined results: a null or empty text is the one id 2. Rows repeated, or sharing a
doc_id, are packed each. Extra columns are ignored. An empty table gives no pieces.
"""
from __future__ import annotations

import zlib
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, text_hash, text_or_empty
from .packing import TOKENIZER, vocabulary

LENGTH = 4096
SLACK = 32
FINE = 32
EXACT = 64
END = 2
PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
FILLED = f"{PACKED}, class int, task int, nth long"


def is_power(n: int) -> bool:
    return n & (n - 1) == 0


@lru_cache
def cuts(length: int = LENGTH, slack: int = SLACK, fine: int = FINE) -> tuple[int, ...]:
    """At r: the first cut of r tokens, such that they come in the fewest pieces (then with the least padding).

    A piece may be h tokens long if k = length div h of them lack at most
    ``slack`` tokens of a sequence, and k is at most ``fine`` or h a power of two. With
    ``fine`` 0 all pieces are powers of two.
    """
    if not is_power(length):
        raise ValueError("the length of a sequence must be a power of two")
    allowed = np.array([h for h in range(1, length + 1)
                        if length - length // h * h <= slack and (length // h <= fine or is_power(h))])
    cost = 1 + (1 / (length // allowed) - allowed / length)
    least, first = np.zeros(length + 1), [0] * (length + 1)
    for r in range(1, length + 1):
        fit = allowed <= r
        total = cost[fit] + least[r - allowed[fit]]
        at = int(np.argmin(total))
        least[r], first[r] = total[at], int(allowed[fit][at])
    return tuple(first)


def parts(tokens: int, length: int, first: tuple[int, ...]) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole sequences, then its rest by ``cuts``."""
    at = 0
    while at < tokens:
        n = length if tokens - at >= length else first[tokens - at]
        yield at, n
        at += n


def filled(docs: DataFrame, length: int, tokenizer: str, exact: int, at_once: int = 1 << 22) -> DataFrame:
    """Pieces with the sequence that their task filled with them; those left have none, but their place ``nth`` in class and task."""
    share = max(1, docs.count())
    fine, powers = cuts(length), cuts(length, fine=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(tokenizer)
        task, bins, held = TaskContext.get().partitionId(), 0, {}

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64()] * 7 + [pa.int32(), pa.int32(), pa.int64()]
            names = [*PIECE, "sequence_id", "offset", "class", "task", "nth"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for b in batches:
            rows, texts, first, size = [], [], 0, 0
            doc_ids, plain, column = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary())
            for i in range(b.num_rows):
                texts.append(column[i].as_py())
                size += len(texts[-1])
                if size < at_once and i < b.num_rows - 1:
                    continue
                for j, ids in enumerate(known.encode(texts), first):
                    ids[-1] = END
                    for at, n in parts(len(ids), length, powers if plain[j] else fine):
                        k = length // n
                        own = held.setdefault(k, [])
                        own.append((doc_ids[j], at, n, zlib.crc32(ids[at:at + n]), len(ids)))
                        if len(own) == k:
                            offset = 0
                            for piece in own:
                                rows.append((*piece, (task << 32) + bins, offset, k, task, None))
                                offset += piece[2]
                            held[k], bins = [], bins + 1
                texts, first, size = [], i + 1, 0
            if rows:
                yield batch(rows)
        rest = [(*piece, None, None, k, task, nth) for k, own in held.items() for nth, piece in enumerate(own)]
        if rest:
            yield batch(rest)

    plain = F.pmod(F.xxhash64("doc_id", text_hash()), F.lit(share)) < exact
    return docs.select(F.col("doc_id").cast("long"), plain.alias("plain"), text_or_empty().alias("text")).mapInArrow(run, FILLED)


def finish(sizes: list[int], length: int) -> list[list[int]]:
    """Sequences of the last pieces (their numbers): gaps of the others are filled with powers of two, the rest stack."""
    longest_first = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    bins: list[list[int]] = []
    room: list[int] = []
    stack = []
    for twos in (False, True):
        for i in longest_first:
            if is_power(sizes[i]) != twos:
                continue
            fits = [(room[b], b) for b in range(len(bins)) if room[b] >= sizes[i]]
            if fits:
                b = min(fits)[1]
                bins[b].append(i)
                room[b] -= sizes[i]
            elif twos:
                stack.append(i)
            else:
                bins.append([i])
                room.append(length - sizes[i])
    # each size divides all before it, so a sequence ends where a piece ends, and so does each power of two of the last
    total, now, fill = sum(sizes[i] for i in stack), [], 0
    full = total // length
    goals = [length] * full + [1 << b for b in reversed(range(length.bit_length())) if total % length >> b & 1]
    for i in stack:
        now.append(i)
        fill += sizes[i]
        if fill == goals[0]:
            bins.append(now)
            now, fill, goals = [], 0, goals[1:]
    return bins


def pack(docs: DataFrame, length: int = LENGTH, tokenizer: str = TOKENIZER, exact: int = EXACT) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    found = stage(filled(docs, length, tokenizer, exact), "op11-pieces")
    done = found.where(F.col("sequence_id").isNotNull()).select(*PIECE, "sequence_id", "offset")
    left = found.where(F.col("sequence_id").isNull()).drop("sequence_id", "offset")

    # a row per class and task
    by_task = Window.partitionBy("class").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = (left.groupBy("class", "task").agg(F.count(F.lit(1)).alias("_n"))
                  .select("class", "task", F.coalesce(F.sum("_n").over(by_task), F.lit(0)).alias("_before"),
                          F.sum("_n").over(Window.partitionBy("class")).alias("_all")))
    numbered = (left.join(counts, ["class", "task"]).withColumn("_rank", F.col("_before") + F.col("nth"))
                    .withColumn("_bin", F.floor(F.col("_rank") / F.col("class"))))
    before = Window.partitionBy("class", "_bin").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    by_count = stage(numbered.select(
        *PIECE, F.when((F.col("_bin") + 1) * F.col("class") <= F.col("_all"), -1 - (F.col("_bin") * (2 * length) + F.col("class"))).alias("sequence_id"),
        F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")), "op11-classes")

    def last(own: pa.Table) -> pa.Table:
        own = own.select(PIECE)
        sizes = own.column("length").to_pylist()
        sequence, offset = [0] * len(sizes), [0] * len(sizes)
        for number, members in enumerate(finish(sizes, length)):
            at = 0
            for i in members:
                sequence[i], offset[i] = -(1 << 62) + number, at
                at += sizes[i]
        return own.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    # fewer than k pieces of each class k: a few thousand rows, whatever the table holds
    few = by_count.where(F.col("sequence_id").isNull()).select(*PIECE)
    return (done.unionByName(by_count.where(F.col("sequence_id").isNotNull()))
                .unionByName(few.groupBy().applyInArrow(last, PACKED)))
