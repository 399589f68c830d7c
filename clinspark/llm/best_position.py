"""Ranked lexical search by the Best Position Algorithm.

Each query item gets its best documents by a sum of integer impacts, one for each of its
terms that the document holds; an impact rises with the term's rarity and frequency and
falls with the document's length.

The documents are read once: a task turns them into shards of about ``SHARD`` characters,
which hold, document by document, the query terms found and how often. Corpus figures (documents,
words, documents per query term) are sums over the tasks. A second pass goes
through the shards. In a shard a term's impact list has its documents by falling
impact; an item reads the lists of its terms side by side. Each document met is scored
in full by direct access to its other terms, which marks their positions as seen
too. The best position of a list is where its seen positions stop being
contiguous: a document not yet met stands behind the best position of each list,
so the sum of the impacts there bounds its score. The search of a shard ends when that bound falls strictly
below the k-th best score - equal scores are settled by doc_id. A task
keeps each item's best k from shard to shard, so later shards start with a
high k-th score and often end before anything is read.

Query items are taken in blocks of about ``PAIRS`` (item, term) pairs; a block's terms and
their weights are what tasks are sent, whatever the corpus holds.

Terms are the maximal runs of ASCII letters, digits and all characters beyond ASCII; only A-Z are lowered.

Defined results: a null or empty text has no terms; an item without terms, or whose terms no document holds,
has no rows. Items that share an id (null too) are one item with the terms of all. Rows of documents that are repeated, or
share a doc_id, are ranked each; a null doc_id comes after all others of the same score. Extra columns are ignored.
Without documents there are no rows.
"""
from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, text_or_empty

K = 50
SHARD = 1 << 22
SHARD_DOCS = 8192
PAIRS = 1 << 20
FIRST_DEPTH = 32
SALTS = 64
ARRAYS = ("ids", "nulls", "words", "found", "term", "tf")
SHARDS = ", ".join(f"{a} binary" for a in ARRAYS)
FOUND = "item_id long, doc_id long, score long"
#: what separates terms becomes a space, A-Z become a-z, bytes of characters beyond ASCII stay
PLAIN = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


def query_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, t.decode()) for i, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist())
                    for t in set(terms_of(text))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                                  pa.array([r[1] for r in rows], pa.string())], ["item_id", "term"])

    return items.select(F.col("item_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, "item_id long, term string").distinct()


def shards(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """One row per shard: doc_ids, which are null, words, entries found; then for each entry its term's number and count."""
    terms = len(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, entries, chars = [], [], [], 0

        def close() -> pa.RecordBatch:
            doc = np.repeat(np.arange(len(ids)), list(map(len, entries)))
            flat = np.fromiter((t for e in entries for t in e), np.int64, len(doc))
            key, tf = np.unique(doc * max(1, terms) + flat, return_counts=True)
            where, term = np.divmod(key, max(1, terms))
            null = np.array([i is None for i in ids], bool)
            arrays = (np.array([i or 0 for i in ids], np.int64), null, np.array(words, np.int64),
                      np.bincount(where, minlength=len(ids)).astype(np.int32), term.astype(np.int32), tf.astype(np.int32))
            return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays], list(ARRAYS))

        for b in batches:
            column = b.column(1).cast(pa.binary())
            for i, doc_id in enumerate(b.column(0).to_pylist()):
                text = column[i].as_py()
                found = terms_of(text)
                ids.append(doc_id)
                words.append(len(found))
                entries.append([n for n in map(number.get, found) if n is not None])
                chars += len(text)
                if chars >= SHARD or len(ids) >= SHARD_DOCS:
                    yield close()
                    ids, words, entries, chars = [], [], [], 0
        if ids:
            yield close()

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, SHARDS)


def read(row: dict) -> list[np.ndarray]:
    kinds = (np.int64, bool, np.int64, np.int32, np.int32, np.int32)
    return [np.frombuffer(row[a], k) for a, k in zip(ARRAYS, kinds)]


def corpus_figures(found: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, words of all, documents per query term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(terms + 2, np.int64)
        for b in batches:
            for row in b.to_pylist():
                _, _, words, _, term, _ = read(row)
                sums[:terms] += np.bincount(term, minlength=terms)
                sums[terms:] += ((words > 0).sum(), words.sum())
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["at", "n"])

    # at most the query terms of a block
    rows = found.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    sums = np.zeros(terms + 2, np.int64)
    for r in rows:
        sums[r.at] = r.n
    return int(sums[terms]), int(sums[terms + 1]), sums[:terms]


class Best:
    """The k best (score, doc_id) so far of an item."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id, self.null = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """A score below which nothing can enter."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        score, ids, null = np.r_[self.score, score], np.r_[self.id, ids], np.r_[self.null, null]
        order = np.lexsort((ids, null, -score))[:self.k]
        self.score, self.id, self.null = score[order], ids[order], null[order]


class Lists:
    """The impact lists of a shard, and direct access by document."""

    def __init__(self, arrays: list[np.ndarray], documents: int, words: int, terms: int):
        self.ids, self.null, n, counts, self.term, tf = arrays
        size = 50 + (50 * n * documents) // max(1, words)
        tf = tf.astype(np.int64)
        self.doc = np.repeat(np.arange(len(n)), counts)
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 20 * size[self.doc])
        self.end = np.cumsum(counts)
        self.start = self.end - counts
        self.entry = np.lexsort((-self.impact, self.term))  # by term, then falling impact
        self.place = np.empty(len(self.entry), np.int64)
        self.place[self.entry] = np.arange(len(self.entry))
        self.bounds = np.searchsorted(self.term[self.entry], np.arange(terms + 1))

    def search(self, terms: np.ndarray, weight: np.ndarray, best: Best) -> int:
        """Best position search of one item; returns how many documents it scored. ``weight`` is by term, 0 outside the item."""
        first, last = self.bounds[terms], self.bounds[terms + 1]
        kept = last > first
        first, last, own = first[kept], last[kept], weight[terms[kept]]
        seen, scored = np.zeros(len(self.entry), bool), np.zeros(len(self.ids), bool)
        position, depth, step, count = first.copy(), 0, FIRST_DEPTH, 0
        while True:
            open_ = position < last
            bound = int((own[open_] * self.impact[self.entry[position[open_]]]).sum())
            if bound < best.least:
                return count
            at = spans(np.minimum(first + depth, last), np.minimum(first + depth + step, last))
            depth, step = depth + step, 2 * step
            seen[at] = True
            doc = self.doc[self.entry[at]]
            doc = np.unique(doc[~scored[doc]])
            scored[doc] = True
            count += len(doc)
            entries = spans(self.start[doc], self.end[doc])
            value = weight[self.term[entries]]
            seen[self.place[entries[value > 0]]] = True
            sums = np.r_[0, np.cumsum(value * self.impact[entries])]
            stop = np.cumsum(self.end[doc] - self.start[doc])
            score = sums[stop] - sums[stop - (self.end[doc] - self.start[doc])]
            good = score >= best.least
            best.add(score[good], self.ids[doc[good]], self.null[doc[good]])
            for i in range(len(first)):
                unseen = np.flatnonzero(~seen[position[i]:position[i] + 2 * step])
                while not len(unseen) and position[i] + 2 * step < last[i]:
                    position[i] += 2 * step
                    unseen = np.flatnonzero(~seen[position[i]:position[i] + 2 * step])
                position[i] = min(last[i], position[i] + unseen[0]) if len(unseen) else last[i]


def spans(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers from each start to its end."""
    n = end - start
    return np.repeat(end - np.cumsum(n), n) + np.arange(int(n.sum()))


def weights(documents: int, per_term: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in per_term], np.int64)


def best_of_tasks(found: DataFrame, items: dict[int | None, np.ndarray], documents: int, words: int, weight: np.ndarray, k: int) -> DataFrame:
    """Each task's best k documents of every item."""
    terms = len(weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {i: Best(k) for i in items}
        for b in batches:
            for row in b.to_pylist():
                lists = Lists(read(row), documents, words, terms)
                for i, own in items.items():
                    mine = np.zeros(terms, np.int64)
                    mine[own] = weight[own]
                    lists.search(own[weight[own] > 0], mine, best[i])
        for i, x in best.items():
            if len(x.score):
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(x.id), pa.int64()), pa.array(x.id, mask=x.null),
                                                  pa.array(x.score)], ["item_id", "doc_id", "score"])

    return found.mapInArrow(run, FOUND)


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score."""
    pairs = stage(query_terms(items), "op12-terms")
    blocks = max(1, -(-pairs.count() // PAIRS))
    out = None
    for block in range(blocks):
        # about PAIRS pairs; an item's terms stay together
        own: dict[int | None, list[bytes]] = {}
        for r in pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect():
            own.setdefault(r.item_id, []).append(r.term.encode())
        number = {t: i for i, t in enumerate(sorted({t for ts in own.values() for t in ts}))}
        numbered = {i: np.array(sorted(number[t] for t in ts), np.int64) for i, ts in own.items()}
        found = stage(shards(docs, number), "op12-shards")
        documents, words, per_term = corpus_figures(found, len(number))
        part = best_of_tasks(found, numbered, documents, words, weights(documents, per_term), k)
        out = part if out is None else out.unionByName(part)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # a task has at most k rows of an item: thinned by groups of tasks before an item's rows meet
    some = (out.withColumn("_some", F.spark_partition_id() % SALTS)
               .withColumn("_rank", F.row_number().over(Window.partitionBy("item_id", "_some").orderBy(*order)))
               .where(F.col("_rank") <= k))
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
                .where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))
