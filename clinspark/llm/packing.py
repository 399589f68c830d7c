"""Best-fit packing with swap-based local search.

Texts become token ids by a public tokenizer, then id 0. A document longer than
``LENGTH`` is cut into pieces of that length; whole pieces are sequences of their own.
All other pieces are dealt evenly to groups of about ``GROUP`` pieces. A group
is packed by best fit, longest first, and then improved: between bins that are not
full a piece is moved, a piece is exchanged for a shorter one, or two pieces
for one, wherever that raises the sum of squared fills. The emptiest bins give
and the others fill until bins are empty and go. The search ends at the least
possible number of bins, or where a round over all open bins empties none.

Groups are independent, so packing scales with their number; each loses less than
one sequence to its cut.

Tokens are looked up by word: the tokenizer drops white space and joins nothing
across it, so a text's ids are its words' ids in order. Words met are kept in a
table of at most ``WORDS`` entries per Python worker.

Defined results: a null or empty text is the one id 0. Rows repeated, or sharing a
doc_id, are packed each. Extra columns are ignored. An empty table gives no pieces.
"""
from __future__ import annotations

import os
import zlib
from itertools import chain
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_or_empty

LENGTH = 2048
GROUP = 16_384
TOKENIZER = "word_bpe_49k.json"
WORDS = 1_000_000
#: a sign behind an ASCII letter or digit and before white space is a token of its own in any case
CLOSING = r"([a-z0-9])([.,;:!?])(\s)"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


class Vocabulary:
    """Ids of words by a tokenizer file; the table of words met starts anew beyond ``WORDS``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = [np.empty(0, np.uint32)]
        self.sizes = [np.empty(0, np.int64)]

    def learn(self, words: list[str]) -> None:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        for w in words:
            self.number[w] = len(self.number)
        ids = [e.ids for e in found]
        self.sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
        self.ids.append(np.fromiter(chain.from_iterable(ids), np.uint32))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text and id 0."""
        if len(self.number) > WORDS:
            self.forget()
        # A-Z may be lowered first unless a combining mark follows that has its own lower-case form, or in what
        # would then be a special token
        plain = pa.array([t if b"\xcc" in t or b"<|" in t else t.lower() for t in texts], pa.large_binary()).cast(pa.large_string())
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(plain, CLOSING, r"\1 \2\3"))
        counts = np.diff(split.offsets.to_numpy())
        words = split.values.dictionary_encode()
        own = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = list(map(self.number.get, own))
        if None in numbers:
            self.learn([w for w, n in zip(own, numbers) if n is None])
            numbers = list(map(self.number.get, own))
        self.ids, self.sizes = [np.concatenate(self.ids)], [np.concatenate(self.sizes)]
        ids, sizes = self.ids[0], self.sizes[0]
        starts = np.cumsum(sizes) - sizes
        at = np.array(numbers, np.int64)[words.indices.to_numpy()]
        size = sizes[at]
        end = np.cumsum(size)
        doc = np.repeat(np.arange(len(texts)), counts)
        out = np.zeros(int(size.sum()) + len(texts), "<u4")  # the id 0 after each text is left
        step = np.arange(len(out) - len(texts))
        out[np.repeat(doc, size) + step] = ids[np.repeat(starts[at] - (end - size), size) + step]
        cuts = np.cumsum(np.bincount(doc, size, len(texts)).astype(np.int64) + 1)
        return np.split(out, cuts[:-1])


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(name: str) -> Vocabulary:
    """One table per Python worker; ``name`` is a path or a file of the public tokenizers."""
    if name not in _vocabularies:
        import public_tokenizers
        _vocabularies[name] = Vocabulary(name if os.sep in name else str(public_tokenizers.path(name)))
    return _vocabularies[name]


def pieces(docs: DataFrame, length: int = LENGTH, tokenizer: str = TOKENIZER, at_once: int = 1 << 22) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(tokenizer)
        for b in batches:
            rows, texts, first, held = [], [], 0, 0
            column = b.column(1).cast(pa.binary())
            for i in range(b.num_rows):
                texts.append(column[i].as_py())
                held += len(texts[-1])
                if held >= at_once or i == b.num_rows - 1:
                    for j, ids in enumerate(known.encode(texts)):
                        doc = b.column(0)[first + j].as_py()
                        for k, at in enumerate(range(0, len(ids), length)):
                            cut = ids[at:at + length]
                            rows.append((doc, k, at, len(cut), zlib.crc32(cut)))
                    texts, first, held = [], i + 1, 0
            if rows:
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, PIECES)


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Bins of item numbers: each item, longest first, to the fullest bin that holds it."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(length + 1)]
    gaps = 0  # bit g: a bin with gap g
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = gaps >> size
        if fits:
            gap = size + (fits & -fits).bit_length() - 1
            k = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps &= ~(1 << gap)
            bins[k].append(i)
        else:
            gap, k = length, len(bins)
            bins.append([i])
        by_gap[gap - size].append(k)
        if gap > size:
            gaps |= 1 << (gap - size)
    return bins


def improve(bins: list[list[int]], sizes: np.ndarray, length: int) -> list[list[int]]:
    """Local search over the bins that are not full; every step raises the sum of squared fills."""
    least = -(-int(sizes.sum()) // length)
    fills = [int(sizes[b].sum()) for b in bins]
    full = [b for b, f in zip(bins, fills) if f == length]
    open_ = [b for b, f in zip(bins, fills) if f < length]
    if len(full) + len(open_) <= least:
        return bins
    members = [list(b) for b in open_]
    fill = np.array([int(sizes[b].sum()) for b in open_], np.int64)
    item = np.array([i for b in open_ for i in b], np.int64)
    where = np.repeat(np.arange(len(open_)), [len(b) for b in open_])
    place = {int(i): k for k, i in enumerate(item)}
    size = sizes[item].astype(np.int64)
    alive = len(open_)

    def give(i: int, to: int) -> None:
        members[where[place[i]]].remove(i)
        fill[where[place[i]]] -= sizes[i]
        members[to].append(i)
        fill[to] += sizes[i]
        where[place[i]] = to

    def step(donor: int) -> bool:
        """One exchange that moves fill from the donor to a fuller bin."""
        gap = length - fill
        gap[donor] = -1
        gap[fill == 0] = -1
        own = sorted(members[donor], key=lambda i: (-sizes[i], i))
        for i in own:  # move: to the bin that it fills most
            fits = np.flatnonzero((gap >= sizes[i]) & (fill + sizes[i] > fill[donor]))
            if len(fits):
                give(i, int(fits[np.argmin(gap[fits])]))
                return True
        room = gap[where]
        after = fill[where]
        singles = [(i,) for i in own]
        for kind in (singles, [(i, j) for k, i in enumerate(own) for j in own[k + 1:]]):  # one for one, then two for one
            best = None
            for parts in kind:
                more = int(sum(sizes[i] for i in parts)) - size
                gain = np.where((more > 0) & (more <= room) & (after + more > fill[donor]), more, 0)
                at = int(np.argmax(gain))
                if gain[at] and (best is None or gain[at] > best[0]):
                    best = (gain[at], parts, int(where[at]), int(item[at]))
            if best:
                for i in best[1]:
                    give(i, best[2])
                give(best[3], donor)
                return True
        return False

    emptied = True
    while emptied and len(full) + alive > least:
        emptied = False
        for donor in np.argsort(np.where(fill > 0, fill, length + 1), kind="stable")[:alive].tolist():
            while fill[donor] > 0 and step(donor):
                pass
            if fill[donor] == 0:
                alive, emptied = alive - 1, True
                if len(full) + alive <= least:
                    break
    return full + [m for m in members if m]


def pack(found: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``pieces`` rows with the sequence that each is in and its offset there."""
    found = stage(found.withColumn("_at", F.monotonically_increasing_id()), "op7-pieces")
    short = found.where(F.col("length") < length)
    groups = max(1, -(-short.count() // group))

    def fill(own: pa.Table) -> pa.Table:
        own = own.sort_by("_at")
        number = own.column("_group")[0].as_py()
        sizes = own.column("length").to_numpy()
        sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
        for k, b in enumerate(improve(best_fit(sizes, length), sizes, length)):
            n = sizes[b]
            sequence[b] = (number << 32) + k
            offset[b] = np.cumsum(n) - n
        kept = own.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        return kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    dealt = short.withColumn("_group", F.pmod(F.xxhash64("_at"), F.lit(groups)).cast("long"))
    whole = (found.where(F.col("length") == length)
                  .select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("_at")).alias("sequence_id"),
                          F.lit(0).cast("long").alias("offset")))
    return dealt.groupBy("_group").applyInArrow(fill, PACKED).unionByName(whole)
