import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clinspark.llm import harmonic as H


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(H.TOKENIZER))


def check(docs, tokenizer, packed, length=H.LENGTH):
    """Every id in one piece, sequences gapless; returns padding, tokens and pieces."""
    texts = sorted((str(r.doc_id), zlib.crc32(ids.tobytes()), len(ids)) for r in docs.collect()
                   for ids in [np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")])
    rows = packed.collect()
    want = {}
    for r in docs.select("doc_id", "text").collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(r.doc_id, []).append(ids)
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    assert got.keys() == want.keys()
    for doc_id, docs_of in want.items():
        own = {(len(ids), r.start, r.length, zlib.crc32(ids[r.start:r.start + r.length].tobytes()))
               for ids in docs_of for r in got[doc_id] if r.doc_tokens == len(ids)}
        assert {(r.doc_tokens, r.start, r.length, r.ids_crc32) for r in got[doc_id]} <= own
        assert sum(r.length for r in got[doc_id]) == sum(map(len, docs_of))
        if len(docs_of) == 1:
            at = 0
            for r in sorted(got[doc_id], key=lambda r: r.start):
                assert r.start == at
                at += r.length
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = 0
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at and n > 0
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    assert texts
    return padding, sum(r.length for r in rows), len(rows)


def test_documents(few_docs, tokenizer):
    padding, tokens, pieces = check(few_docs, tokenizer, H.pack(few_docs))
    assert padding <= 0.01 * tokens
    assert pieces <= 4 * few_docs.count()


def test_small_tables_need_no_padding(few_docs, tokenizer):
    some = few_docs.where("doc_id < 20")
    assert check(some, tokenizer, H.pack(some))[0] == 0


def test_few_exact_documents(few_docs, tokenizer):
    padding, tokens, _ = check(few_docs, tokenizer, H.pack(few_docs.repartition(5), length=512, exact=0), 512)
    assert padding <= 0.1 * tokens


def test_odd_documents(odd_docs, no_docs, tokenizer):
    check(odd_docs, tokenizer, H.pack(odd_docs))
    check(odd_docs, tokenizer, H.pack(odd_docs, length=64, exact=0), 64)
    assert H.pack(no_docs).collect() == []


def test_sequences_of_a_class_take_a_fixed_number(few_docs):
    rows = (H.filled(few_docs.repartition(3), H.LENGTH, H.TOKENIZER, 0).where("sequence_id IS NOT NULL")
             .groupBy("class", "sequence_id").agg(F.count("*").alias("n"), F.sum("length").alias("fill")).collect())
    assert rows and all(r.n == r["class"] and r.fill >= H.LENGTH - H.SLACK for r in rows)


@given(st.integers(1, 3 * H.LENGTH))
@settings(max_examples=300, deadline=None)
def test_cuts(tokens):
    for fine in (0, H.FINE):
        found = list(H.parts(tokens, H.LENGTH, H.cuts(fine=fine)))
        assert sum(n for _, n in found) == tokens
        for _, n in found:
            k = H.LENGTH // n
            assert H.LENGTH / (k + 1) < n <= H.LENGTH / k
            assert H.LENGTH - k * n <= H.SLACK
            assert fine or H.is_power(n)


def test_cuts_are_the_fewest():
    first = H.cuts(64, 2, 8)
    allowed = [h for h in range(1, 65) if 64 - 64 // h * h <= 2 and (64 // h <= 8 or H.is_power(h))]
    least = [0]
    for r in range(1, 65):
        least.append(1 + min(least[r - h] for h in allowed if h <= r))
    for r in range(1, 65):
        n, at = 0, r
        while at:
            n, at = n + 1, at - first[at]
        assert n == least[r]
    with pytest.raises(ValueError):
        H.cuts(100)


@given(st.lists(st.integers(1, 64), max_size=60))
@settings(max_examples=200, deadline=None)
def test_finish(sizes):
    bins = H.finish(sizes, 64)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    fills = [sum(sizes[i] for i in b) for b in bins]
    assert all(0 < f <= 64 for f in fills)
    if all(H.is_power(s) for s in sizes):
        assert all(H.is_power(f) for f in fills)
