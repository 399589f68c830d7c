"""Substring dedup on bytes by a distributed difference-cover suffix sort.

Every byte that a ``LENGTH``-byte string covers which also starts in a document with a smaller
doc_id is removed. The suffixes that matter are those that begin a repeated string, and
they are found and dealt out by content:

1. Of each string the ``GRAM``-byte grams with the smallest hash are its marks: equal
   strings have equal marks at the same places. Marks found once belong to no
   repeated string.
2. A repeated mark with all bytes that a string around it can reach is a context. Contexts go to a
   part by their mark, as hashes; copies of a context are one name there, with the
   smallest doc_id.
3. Where contexts of a mark share half of what is around it, one copy of each is fetched as text, and the part sorts
   the suffixes of its contexts by the difference cover modulo 3: sampled triples are sorted
   and named, names are sorted recursively, the remaining suffixes follow from their first byte and
   the next rank, and both orders are merged. Neighbours in that order with the same ``LENGTH`` bytes
   are one string; it is removed but where its doc_id is smallest.
4. Parts answer the chunks which strings of which contexts to remove.

A mark in more than ``CROWDED`` chunks has too many records for one part, and so has one with more than
``MANY`` contexts, or more than ``MOST`` that share a half, as at the edges of a passage that many documents
quote between other words. Contexts are counted by a sample of their hashes, so a limit
is met within a fraction. Strings around such marks are spelled out instead: each goes to a
part of its own by a 128-bit hash, once per chunk and with the smallest doc_id there.

Sorting the suffixes of whole texts instead would shuffle a record for each byte in each round;
strings found once, about three quarters of the test corpus, need none.

Defined results: a null or empty text has no bytes. Strings never cross documents; doc_ids
that are equal are not smaller than each other, and a null doc_id is larger than any. Rows
repeated are judged each. Texts are cut at bytes; ``kept`` leaves out characters that a cut
leaves incomplete, its hash does not. Extra columns are ignored.
Empty tables give empty results. A context is told from others with its mark by 64 bits
of hash, strings are compared byte by byte.
"""
from __future__ import annotations

import hashlib
from functools import reduce
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import packed, unpacked
from .common import keyed, same_key, stage, with_texts
from .routing import ANSWERS, BLOBS, FACTOR_2, HOT, U, Chunk, Dealt, Rolling, batch_of, covered, member, mixed, part_of, table_of

LENGTH = 50
GRAM = 16
REACH = LENGTH - GRAM  # a string begins at most so far before a mark in it
PER_PART = 1 << 22
CROWDED = 1 << 16
STEP = 1 << 16
MANY = 1 << 18
MOST = 4096
SAMPLED = 64  # contexts in the sample of a half that has ``MOST``
AT_ONCE = 4096  # contexts whose suffixes are sorted together, if no half of a mark has more
NO_ID = np.iinfo(np.int64).max
HALF = REACH // 2  # a string around a mark holds so many bytes before or behind it
NAME = np.dtype([("mark", "<u4"), ("context", "<u8"), ("doc", "<i8"), ("chunk", "<u4"), ("before", "<u2"), ("behind", "<u2")])
MORE = np.uint32(1 << 31)  # of a chunk: it holds the context in larger doc_ids too
CONTEXT = np.dtype([("context", "<u8"), ("left", "u1"), ("right", "u1"), ("text", "u1", REACH + LENGTH)])
STRING = np.dtype([("a", "<u8"), ("b", "<u8"), ("doc", "<i8"), ("chunk", "<u4")])
WHOLE = U(1 << 63)  # among the shifts of an answer: it is of a string, not of a context
ANSWER = np.dtype([("context", "<u8"), ("doc", "<i8"), ("shifts", "<u8")])
REMOVED = "doc_id long, th long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"
SYMBOLS = mixed(np.arange(1, 257, dtype=U))


def _low(x: np.ndarray) -> np.ndarray:
    return (x & U(0xFFFF)).astype(np.uint16)


def _sliding(x: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """``best`` of each ``size`` neighbours, by doubling."""
    have = 1
    while 2 * have <= size:
        x = best(x[:-have], x[have:])
        have *= 2
    return best(x[:len(x) - (size - have)], x[size - have:]) if size > have else x


class Bytes:
    """The bytes of some documents one after the other, with their marks and, if asked for, the marks' contexts.

    Worked out some documents at a time, so that the arrays of a step stay in a processor's cache.
    """

    def __init__(self, texts: list[bytes], around: bool = False):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.counts = np.fromiter(map(len, texts), np.int64, len(texts))
        self.end = np.cumsum(self.counts)
        self.first = self.end - self.counts
        cuts = np.flatnonzero(np.diff(np.r_[-1, self.first // STEP])) if len(texts) else np.empty(0, np.int64)
        found = [self._marks(a, b, around) for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(texts)])]
        kinds = (np.int64, U, U, np.uint16, np.uint16)
        self.place, self.grams, self.contexts, self.before, self.behind = (
            np.concatenate([np.empty(0, k), *x]) for k, x in zip(kinds, zip(*found) if found else [()] * 5))
        self.doc, self.left, self.right = self._reach(self.place)

    def _reach(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document of each place, and how far a string around it can reach in that document."""
        doc = np.searchsorted(self.end, place, "right")
        return doc, np.minimum(place - self.first[doc], REACH), np.minimum(self.end[doc] - place, LENGTH)

    def _marks(self, a: int, b: int, around: bool) -> tuple[np.ndarray, ...]:
        """Marks of documents a to b: place, gram, context, and short hashes of its halves."""
        low, data = int(self.first[a]), self.data[self.first[a]:self.end[b - 1]]
        none = (np.empty(0, np.int64), *(np.empty(0, U),) * 2, *(np.empty(0, np.uint16),) * 2)
        if len(data) < LENGTH:
            return none
        rolling = Rolling(SYMBOLS[data])
        grams = mixed(rolling.windows(GRAM))
        value = np.maximum((grams >> U(32)).astype(np.uint32), 1)  # 0 is outside strings
        least = _sliding(value, REACH + 1, np.minimum)
        inside = np.zeros(len(least), bool)
        for x, y in zip((self.first[a:b] - low).tolist(), (self.end[a:b] - low).tolist()):
            inside[x:max(x, y - LENGTH + 1)] = True
        window = np.zeros(len(value) + REACH, np.uint32)
        window[REACH:REACH + len(least)] = np.where(inside, least, 0)
        place = np.flatnonzero(_sliding(window, REACH + 1, np.maximum) == value)
        if not around or not len(place):
            return place + low, grams[place], *none[2:]
        _, left, right = self._reach(place + low)
        spread = left.astype(U) * U(0x2545F4914F6CDD1D) + right.astype(U) * U(0x9FB21C651E98DF25)
        context = mixed(rolling.spans(place - left, place + right) + spread)
        # with half of the reach before or behind; any value where that is not there
        before = mixed(rolling.spans(place - np.minimum(left, HALF), place + GRAM))
        behind = mixed(rolling.spans(place, place + np.minimum(right, GRAM + HALF)))
        return (place + low, grams[place], context, _low(np.where(left >= HALF, before, context)),
                _low(np.where(right >= GRAM + HALF, behind, context >> U(16))))

    def strings(self, at: np.ndarray) -> np.ndarray:
        """Starts of the strings around marks."""
        start = np.zeros(len(self.data), bool)
        place, left, right = self.place[at], self.left[at], self.right[at]
        for d in range(REACH + 1):
            start[place[(d <= left) & (LENGTH - d <= right)] - d] = True
        return np.flatnonzero(start)


def _packed(first: np.ndarray, second: np.ndarray, most: int) -> np.ndarray:
    """One number per pair in the order of pairs; ``second`` is below ``most``."""
    if (int(first.max(initial=0)) + 1) * most >= 1 << 62:
        first = np.unique(first, return_inverse=True)[1]
    return first * most + second


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``s`` (whole numbers from 1) in their order, by the difference cover {1, 2} modulo 3."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    s = np.r_[s, 0, 0, 0].astype(np.int64)
    most = int(s.max()) + 1
    ones = np.arange(1, n + (n % 3 == 1), 3)  # one past the end where the last triple needs it
    twos = np.arange(2, n, 3)
    sample = np.r_[ones, twos]
    triples = _packed(_packed(s[sample], s[sample + 1], most), s[sample + 2], most)
    order = np.argsort(triples)
    sorted_ = triples[order]
    name = np.empty(len(sample), np.int64)
    name[order] = np.cumsum(np.r_[1, sorted_[1:] != sorted_[:-1]])
    if name.max() < len(sample):
        order = suffix_array(name)
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sample = sample[order]
    sample = sample[sample < n]
    rest = np.arange(0, n, 3)
    big = n + 3
    rest = rest[np.argsort(s[rest] * big + rank[rest + 1])]
    one, two = sample[sample % 3 == 1], sample[sample % 3 == 2]
    before = np.searchsorted(s[one] * big + rank[one + 1], s[rest] * big + rank[rest + 1])
    # against the other residue: two symbols, then a rank
    pairs = _packed(np.r_[s[two], s[rest]], np.r_[s[two + 1], s[rest + 1]], most)
    keys = _packed(pairs, np.r_[rank[two + 2], rank[rest + 2]], big)
    before += np.searchsorted(keys[:len(two)], keys[len(two):])
    out = np.empty(n, np.int64)
    at = before + np.arange(len(rest))
    own = np.ones(n, bool)
    own[at] = False
    out[at], out[own] = rest, sample
    return out


def smaller_elsewhere(contexts: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Per context (text, left, right; its smallest doc_id) the shifts whose string is found with a smaller doc_id.

    Bit d stands for the string that begins d bytes before the mark.
    """
    shifts = np.zeros(len(contexts), U)
    if len(contexts) < 2:
        return shifts
    left, size = contexts["left"].astype(np.int64), contexts["left"].astype(np.int64) + contexts["right"]
    text = np.where(np.arange(REACH + LENGTH) < size[:, None], contexts["text"].astype(np.int16) + 2, 0)
    text = np.pad(text, ((0, 0), (0, 1)))
    text[np.arange(len(size)), size] = 1  # ends a context
    keep = np.arange(REACH + LENGTH + 1) <= size[:, None]
    flat, row = text[keep], np.repeat(np.arange(len(size)), size + 1)
    at = np.arange(len(flat)) - (np.cumsum(size + 1) - size - 1)[row]
    del text, keep
    order = suffix_array(flat)
    order = order[at[order] + LENGTH <= size[row[order]]]
    shift = left[row[order]] - at[order]
    order = order[(shift >= 0) & (shift <= REACH)]
    if len(order) < 2:
        return shifts
    # neighbours with the same first LENGTH bytes
    last = flat[order + (LENGTH - 1)]
    same = last[1:] == last[:-1]
    maybe, span = np.flatnonzero(same), np.arange(LENGTH - 1)
    for a in range(0, len(maybe), 1 << 15):
        k = maybe[a:a + (1 << 15)]
        same[k] = (flat[order[k, None] + span] == flat[order[k + 1, None] + span]).all(axis=1)
    first = np.flatnonzero(np.r_[True, ~same])
    own = doc[row[order]]
    least = np.repeat(np.minimum.reduceat(own, first), np.diff(np.r_[first, len(order)]))
    gone = order[own > least]
    np.bitwise_or.at(shifts, row[gone], U(1) << (left[row[gone]] - at[gone]).astype(U))
    return shifts


def _doc_ids(c: Chunk) -> np.ndarray:
    return np.array([NO_ID if x is None else x for x in c.doc_ids], np.int64)


def _distinct(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names by mark, context and doc; where a context begins."""
    names = names[np.lexsort((names["chunk"], names["doc"], names["context"], names["mark"]))]
    new = np.r_[True, (names["mark"][1:] != names["mark"][:-1]) | (names["context"][1:] != names["context"][:-1])]
    return names, np.flatnonzero(new[:len(names)])


def _shared(names: np.ndarray, half: str) -> np.ndarray:
    """Which distinct contexts have the mark and half of another."""
    key = names["mark"].astype(U) << U(16) | names[half].astype(U)
    found, count = np.unique(key, return_counts=True)
    return count[np.searchsorted(found, key)] > 1


def _turns(group: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about ``AT_ONCE`` sorted values, equal ones together."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][:len(group)])
    cuts = starts[np.flatnonzero(np.diff(np.r_[-1, starts // AT_ONCE]))] if len(starts) else starts
    return zip(cuts.tolist(), np.r_[cuts[1:], len(group)].tolist())


def _spelled_marks(names: DataFrame) -> DataFrame:
    """part, mark: marks with more contexts than ``MANY``, or than ``MOST`` with the same half."""
    share = max(1, MOST // SAMPLED)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rec = [np.frombuffer(x.as_buffer(), NAME) for x in b.column(1)]
            part = np.repeat(b.column(0).to_numpy(), [len(x) for x in rec])
            rec = np.concatenate([np.empty(0, NAME), *rec])
            kept = (rec["context"] >> U(40)) % U(share) == 0  # other bits stand in for halves
            part, rec = part[kept], rec[kept]
            # the half before, the half behind, any half
            half = np.r_[rec["before"].astype(np.int32), rec["behind"].astype(np.int32) + (1 << 16), np.full(len(rec), -1, np.int32)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(part, 3)), pa.array(np.tile(rec["mark"].astype(np.int64), 3)), pa.array(half),
                 pa.array(np.tile(rec["context"].astype(np.int64), 3))], ["part", "mark", "half", "context"])

    most = F.when(F.col("half") < 0, F.lit(MANY // share)).otherwise(F.lit(MOST // share))
    return (names.select("part", "records").mapInArrow(sample, "part int, mark long, half int, context long").distinct()
                 .groupBy("part", "mark", "half").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
                 .select("part", "mark").distinct())


def _parted(names: DataFrame, spelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``names`` without those of the spelled marks, and answers to each chunk: its spelled marks, as part and mark."""
    def split(batches: Iterator[pa.RecordBatch], kept: bool) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for part, records, marks in zip(*(b.column(i) for i in range(3))):
                rec = np.frombuffer(records.as_buffer(), NAME)
                own = np.isin(rec["mark"], np.array(marks.as_py() or [], np.int64))
                if kept:
                    rows.append((part.as_py(), rec[~own].tobytes()))
                else:
                    key = U(part.as_py() << 32) | rec["mark"][own].astype(U)
                    pair = np.unique(np.rec.fromarrays([rec["chunk"][own] & ~MORE, key], names="chunk,key"))
                    rows += packed(pair["chunk"].astype(np.int64), np.ascontiguousarray(pair["key"]))
            yield batch_of(rows, "part" if kept else "chunk")

    own = spelled.groupBy("part").agg(F.collect_list("mark").alias("marks"))
    return (names.join(own, "part", "left").select("part", "records", "marks").mapInArrow(lambda x: split(x, True), BLOBS),
            names.join(own, "part").select("part", "records", "marks").mapInArrow(lambda x: split(x, False), ANSWERS))


def _hot(marks: DataFrame) -> DataFrame:
    """The crowded marks among answers to each chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.frombuffer(x.as_buffer(), U) for x in b.column(1)]
            yield batch_of(zip(b.column(0).to_pylist(), [x[x >= HOT].tobytes() for x in found]), "chunk")

    return marks.where("hot").select("chunk", "records").mapInArrow(run, ANSWERS)


def _answers(dealt: Dealt) -> DataFrame:
    """Answers to each chunk: a context's smallest doc_id, and the shifts that are removed even there."""
    def note(chunk: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
        b = Bytes(texts)
        return packed(*dealt.noted(b.grams, chunk[b.doc]))

    def name(c: Chunk) -> pa.RecordBatch:
        b = Bytes(c.texts, around=True)
        found = np.flatnonzero(member(dealt.low(b.grams), np.unique(c.answers[c.answers < HOT])))
        rec = np.empty(len(found), NAME)
        rec["mark"], rec["context"] = b.grams[found] & U(0xFFFFFFFF), b.contexts[found]
        rec["doc"], rec["chunk"] = _doc_ids(c)[b.doc[found]], c.number
        rec["before"], rec["behind"] = b.before[found], b.behind[found]
        part = part_of(b.grams[found], dealt.parts)
        order = np.lexsort((rec["doc"], rec["context"]))
        rec, part = rec[order], part[order]
        new = np.r_[True, rec["context"][1:] != rec["context"][:-1]][:len(rec)]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(rec)] - 1
        out = rec[first]
        out["chunk"] |= np.where(rec["doc"][last] > out["doc"], MORE, np.uint32(0)) if len(first) else np.uint32(0)
        return batch_of(packed(part[first], out), "part")

    def request(own: pa.Table) -> pa.Table:
        names, first = _distinct(unpacked(own.column("records"), NAME))
        # contexts of a mark that share the bytes before it or behind it, so that a string can be in both
        one = names[first]
        wanted = one[_shared(one, "before") | _shared(one, "behind")]
        return table_of(packed((wanted["chunk"] & ~MORE).astype(np.int64), np.ascontiguousarray(wanted["context"])), "chunk")

    def fetch(c: Chunk) -> pa.RecordBatch:
        b = Bytes(c.texts, around=True)
        found = np.flatnonzero(member(b.contexts, np.unique(c.answers)))
        found = found[np.unique(b.contexts[found], return_index=True)[1]]
        rec = np.zeros(len(found), CONTEXT)
        rec["context"], rec["left"], rec["right"] = b.contexts[found], b.left[found], b.right[found]
        step = np.arange(REACH + LENGTH)
        at = (b.place - b.left)[found][:, None] + step
        inside = step < (b.left + b.right)[found][:, None]
        rec["text"] = np.where(inside, b.data[np.minimum(at, len(b.data) - 1)] if len(found) else 0, 0)
        return batch_of(packed(part_of(b.grams[found], dealt.parts), rec), "part")

    def answer(own: pa.Table, texts: pa.Table) -> pa.Table:
        names, first = _distinct(unpacked(own.column("records"), NAME))
        least, context = names["doc"][first], names["context"][first]
        shifts = np.zeros(len(first), U)
        known = unpacked(texts.column("records"), CONTEXT)
        if len(known):
            known = known[np.argsort(known["context"], kind="stable")]
            at = np.minimum(np.searchsorted(known["context"], context), len(known) - 1)
            asked = np.flatnonzero(known["context"][at] == context)
            # equal strings have equal marks, and one half or the other: whole marks are sorted in turn, large ones by halves
            one = names[first][asked]
            mark, number, size = np.unique(one["mark"].astype(U) << U(16), return_inverse=True, return_counts=True)
            large = size[number] > AT_ONCE
            for own, half in ((~large, None), (large, "before"), (large, "behind")):
                group = mark[number[own]] | (one[half][own].astype(U) if half else U(0))
                order = np.argsort(group, kind="stable")
                these = asked[own][order]
                for a, b in _turns(group[order]):
                    shifts[these[a:b]] |= smaller_elsewhere(known[at[these[a:b]]], least[these[a:b]])
        row = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(names)]))
        needed = (shifts[row] != 0) | (names["doc"] > least[row]) | (names["chunk"] & MORE > 0)
        row, chunk = row[needed], (names["chunk"] & ~MORE)[needed].astype(np.int64)
        out = np.empty(len(row), ANSWER)
        out["context"], out["doc"], out["shifts"] = context[row], least[row], shifts[row]
        return table_of(packed(chunk, out), "chunk")

    def spell(c: Chunk) -> pa.RecordBatch:
        b = Bytes(c.texts)
        hot = c.answers >= HOT
        key = part_of(b.grams, dealt.parts).astype(U) << U(32) | b.grams & U(0xFFFFFFFF)
        start = b.strings(np.flatnonzero(member(dealt.low(b.grams), np.unique(c.answers[hot] ^ HOT))
                                         | member(key, np.unique(c.answers[~hot]))))
        if not len(start):
            return batch_of([], "part")
        rec = np.empty(len(start), STRING)
        rec["a"] = mixed(Rolling(SYMBOLS[b.data]).windows(LENGTH))[start]
        rec["b"] = mixed(Rolling(mixed(SYMBOLS[b.data]), FACTOR_2).windows(LENGTH))[start]
        rec["doc"], rec["chunk"] = _doc_ids(c)[np.searchsorted(b.end, start, "right")], c.number
        rec = rec[np.lexsort((rec["doc"], rec["b"], rec["a"]))]
        first = np.flatnonzero(np.r_[True, (rec["a"][1:] != rec["a"][:-1]) | (rec["b"][1:] != rec["b"][:-1])])
        out, last = rec[first], np.r_[first[1:], len(rec)] - 1
        out["chunk"] |= np.where(rec["doc"][last] > out["doc"], MORE, np.uint32(0))
        return batch_of(packed(part_of(out["a"], dealt.parts), out), "part")

    def least(own: pa.Table) -> pa.Table:
        rec = unpacked(own.column("records"), STRING)
        rec = rec[np.lexsort((rec["doc"], rec["b"], rec["a"]))]
        first = np.flatnonzero(np.r_[True, (rec["a"][1:] != rec["a"][:-1]) | (rec["b"][1:] != rec["b"][:-1])][:len(rec)])
        smallest = np.repeat(rec["doc"][first], np.diff(np.r_[first, len(rec)]))
        needed = (rec["doc"] > smallest) | (rec["chunk"] & MORE > 0)
        out = np.empty(int(needed.sum()), ANSWER)
        out["context"], out["doc"], out["shifts"] = rec["a"][needed], smallest[needed], WHOLE
        return table_of(packed((rec["chunk"][needed] & ~MORE).astype(np.int64), out), "chunk")

    marks = stage(dealt.repeated(dealt.scan(note), CROWDED), "op8-marks")
    names = stage(dealt.read(marks, U, name, BLOBS), "op8-names")
    spelled = stage(_spelled_marks(names), "op8-spelled")
    asked = []
    if spelled.limit(1).count():
        names, told = _parted(names, spelled)
        asked.append(told)
    if marks.where("hot").limit(1).count():
        asked.append(_hot(marks))
    wanted = stage(names.groupBy("part").applyInArrow(request, ANSWERS), "op8-wanted")
    texts = dealt.read(wanted, U, fetch, BLOBS)
    answers = stage(names.groupBy("part").cogroup(texts.groupBy("part")).applyInArrow(answer, ANSWERS), "op8-answers")
    if asked:
        strings = dealt.read(reduce(DataFrame.unionByName, asked), U, spell, BLOBS).groupBy("part").applyInArrow(least, ANSWERS)
        answers = answers.unionByName(stage(strings, "op8-strings"))
    return answers


def removed(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, th, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept text."""
    dealt = Dealt(docs, PER_PART)

    def cut(c: Chunk) -> pa.RecordBatch:
        b = Bytes(c.texts, around=True)
        gone = np.zeros(len(b.data), bool)
        whole = c.answers["shifts"] == WHOLE
        if whole.any() and len(b.place):
            known = c.answers[whole][np.argsort(c.answers["context"][whole], kind="stable")]
            start = b.strings(np.arange(len(b.place)))
            hashes = mixed(Rolling(SYMBOLS[b.data]).windows(LENGTH))[start]
            at = np.minimum(np.searchsorted(known["context"], hashes), len(known) - 1)
            later = _doc_ids(c)[np.searchsorted(b.end, start, "right")] > known["doc"][at]
            gone[start[(known["context"][at] == hashes) & later]] = True
        if (~whole).any() and len(b.place):
            known = c.answers[~whole][np.argsort(c.answers["context"][~whole], kind="stable")]
            at = np.minimum(np.searchsorted(known["context"], b.contexts), len(known) - 1)
            found = np.flatnonzero(known["context"][at] == b.contexts)
            said = known[at[found]]
            shifts = np.where(_doc_ids(c)[b.doc[found]] > said["doc"], U((1 << (REACH + 1)) - 1), said["shifts"])
            place, left, right = b.place[found], b.left[found], b.right[found]
            for d in range(REACH + 1):
                fits = (shifts >> U(d) & U(1) > 0) & (d <= left) & (LENGTH - d <= right)
                gone[place[fits] - d] = True
        gone = covered(gone, LENGTH) if len(gone) >= LENGTH else gone
        rows = []
        for doc_id, th, text, a in zip(c.doc_ids, c.hashes, c.texts, b.first.tolist()):
            out = gone[a:a + len(text)]
            kept = b.data[a:a + len(text)][~out].tobytes() if out.any() else text
            spans = int(out[0]) + int((out[1:] & ~out[:-1]).sum()) if len(out) else 0
            rows.append((doc_id, th, len(text), int(out.sum()), spans, hashlib.sha256(kept).hexdigest(),
                         kept.decode(errors="ignore") if with_text else None))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)],
                                          ["doc_id", "th", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return dealt.read(_answers(dealt), ANSWER, cut, REMOVED)


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` without the removed bytes; characters that a cut leaves incomplete are dropped."""
    cuts = (removed(docs, with_text=True).where("n_removed > 0").groupBy("doc_id", "th").agg(F.min("kept").alias("_kept"))
            .select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "_kept"))
    rows = keyed(docs).join(stage(cuts, "op8-cuts"), same_key(), "left")
    return with_texts(rows, docs, F.coalesce("_kept", "text"))
