"""Substring dedup by difference-cover anchors.

A window is ``WINDOW`` consecutive words. Positions of a document whose remainder
modulo ``PERIOD`` is in ``COVER`` are anchors; each hashes the ``ANCHOR`` words from there. For any
two remainders the cover has a shift that takes both into it, so two equal
windows, wherever they start, have an equal anchor at the same place inside, within the
first ``PERIOD`` words. Anchors found once are done with. Around the
others the windows that begin up to ``PERIOD`` - 1 words before are extended to their full
length and compared by 128-bit hashes; those found at two or more places anywhere
are repeated, and every word that a repeated window covers is removed.

Passes go by ``routing``: documents are read three times, the last two with what
they were answered. What a part answers is 64 bits of a window's hash, to the
chunks that hold the window.

Defined results: words are runs of characters that are not ASCII white space; a null or empty
text has none. Windows never cross documents; all copies are removed, the first
as well. Rows repeated, or sharing a doc_id, are documents of their own. Extra
columns are ignored by ``removed`` and kept by ``dedup``. Empty tables give empty results.
"""
from __future__ import annotations

import hashlib
from itertools import chain
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import packed
from .common import keyed, same_key, stage, with_texts
from .routing import ANSWERS, BLOBS, FACTOR_2, U, Chunk, Dealt, Rolling, batch_of, covered, member, mixed, part_of, table_of

WINDOW = 35
PERIOD = 21
COVER = (0, 1, 4, 14, 16)  # every difference modulo 21 occurs once
ANCHOR = WINDOW - PERIOD + 1
PER_PART = 1 << 24
RECORD = np.dtype([("a", "<u8"), ("b", "<u8"), ("chunk", "<u4")])
REMOVED = "doc_id long, th long, n_words long, n_removed long, kept_sha256 string, kept string"


class Words:
    """The words of some documents one after the other."""

    def __init__(self, texts: list[bytes]):
        self.words = [t.split() for t in texts]
        self.counts = np.fromiter(map(len, self.words), np.int64, len(texts))
        self.n = int(self.counts.sum())
        digest = xxhash.xxh3_64_digest
        self.symbols = np.frombuffer(b"".join(map(digest, chain.from_iterable(self.words))), ">u8").astype(U)
        self.first = np.cumsum(self.counts) - self.counts
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        self.at = np.arange(self.n) - self.first[self.doc]
        self.left = self.counts[self.doc] - self.at

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of anchors and their hashes."""
        cover = np.zeros(PERIOD, bool)
        cover[list(COVER)] = True
        place = np.flatnonzero(cover[self.at % PERIOD] & (self.left >= ANCHOR))
        return place, mixed(Rolling(self.symbols).windows(ANCHOR)[place]) if len(place) else np.empty(0, U)

    def windows(self, base: int | None = None) -> np.ndarray:
        """Hashes of the windows from each place; only where ``left`` >= WINDOW they lie in one document."""
        rolling = Rolling(self.symbols) if base is None else Rolling(mixed(self.symbols), base)
        return mixed(rolling.windows(WINDOW))


def _repeated_windows(dealt: Dealt) -> DataFrame:
    """Answers to each chunk: its windows that occur at two or more places."""
    def note(chunk: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
        w = Words(texts)
        place, hashes = w.anchors()
        return packed(*dealt.noted(hashes, chunk[w.doc[place]]))

    def extend(c: Chunk) -> pa.RecordBatch:
        w = Words(c.texts)
        place, hashes = w.anchors()
        place = place[member(dealt.low(hashes), np.unique(c.answers))]
        # windows that hold the anchor within their first PERIOD words
        near = np.zeros(w.n, bool)
        for shift in range(PERIOD):
            near[place[w.at[place] >= shift] - shift] = True
        start = np.flatnonzero(near & (w.left >= WINDOW))
        if not len(start):
            return batch_of([], "part")
        rec = np.empty(len(start), RECORD)
        rec["a"], rec["b"], rec["chunk"] = w.windows()[start], w.windows(FACTOR_2)[start], c.number
        rec = rec[np.lexsort((rec["b"], rec["a"]))]
        keep = np.ones(len(rec), bool)
        keep[2:] = (rec["a"][2:] != rec["a"][:-2]) | (rec["b"][2:] != rec["b"][:-2])
        rec = rec[keep]
        return batch_of(packed(part_of(rec["a"], dealt.parts), rec), "part")

    def compare(own: pa.Table) -> pa.Table:
        rec = np.concatenate([np.frombuffer(x.as_buffer(), RECORD) for x in own.column("records")])
        rec = rec[np.lexsort((rec["chunk"], rec["b"], rec["a"]))]
        same = (rec["a"][1:] == rec["a"][:-1]) & (rec["b"][1:] == rec["b"][:-1])
        again = np.r_[same, False] | np.r_[False, same]
        first = ~np.r_[False, same & (rec["chunk"][1:] == rec["chunk"][:-1])]
        rec = rec[again & first]
        return table_of(packed(rec["chunk"].astype(np.int64), np.ascontiguousarray(rec["a"])), "chunk")

    anchors = stage(dealt.repeated(dealt.scan(note)), "op2-anchors")
    windows = dealt.read(anchors, U, extend, BLOBS)
    return stage(windows.groupBy("part").applyInArrow(compare, ANSWERS), "op2-windows")


def removed(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, th, n_words, n_removed, kept_sha256 and, if asked for, the kept words."""
    dealt = Dealt(docs, PER_PART)

    def cut(c: Chunk) -> pa.RecordBatch:
        w = Words(c.texts)
        gone = np.zeros(w.n, bool)
        if w.n >= WINDOW:
            hashes = w.windows()
            inside = np.flatnonzero(w.left[:len(hashes)] >= WINDOW)
            gone[inside[member(hashes[inside], np.unique(c.answers))]] = True
            gone = covered(gone, WINDOW)
        rows = []
        for doc_id, th, words, a in zip(c.doc_ids, c.hashes, w.words, w.first):
            out = gone[a:a + len(words)]
            kept = b" ".join(x for x, o in zip(words, out.tolist()) if not o) if out.any() else b" ".join(words)
            rows.append((doc_id, th, len(words), int(out.sum()), hashlib.sha256(kept).hexdigest(),
                         kept.decode() if with_text else None))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)],
                                          ["doc_id", "th", "n_words", "n_removed", "kept_sha256", "kept"])

    return dealt.read(_repeated_windows(dealt), U, cut, REMOVED)


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated words; documents that lose words keep the others joined by one space."""
    cuts = (removed(docs, with_text=True).where("n_removed > 0").groupBy("doc_id", "th").agg(F.min("kept").alias("_kept"))
            .select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "_kept"))
    rows = keyed(docs).join(stage(cuts, "op2-cuts"), same_key(), "left")
    return with_texts(rows, docs, F.coalesce("_kept", "text"))
