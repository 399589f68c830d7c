import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle

from clinspark.llm import routing, suffix_dedup as S


@given(st.lists(st.integers(1, 3), max_size=60))
@settings(max_examples=200, deadline=None)
def test_suffix_array(symbols):
    want = sorted(range(len(symbols)), key=lambda i: symbols[i:])
    assert S.suffix_array(np.array(symbols, np.int64)).tolist() == want


def by_hand(rows):
    first, out = {}, []
    for r in rows:
        t, d = (r.text or "").encode(), S.NO_ID if r.doc_id is None else r.doc_id
        for k in range(len(t) - S.LENGTH + 1):
            s = t[k:k + S.LENGTH]
            first[s] = min(first.get(s, d), d)
    for r in rows:
        t, d = (r.text or "").encode(), S.NO_ID if r.doc_id is None else r.doc_id
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - S.LENGTH + 1):
            if first[t[k:k + S.LENGTH]] < d:
                gone[k:k + S.LENGTH] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((r.doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(docs):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.removed(docs).collect()), key=str)


def test_documents(few_docs):
    assert found(few_docs) == by_hand(few_docs.collect())


def test_odd_documents(odd_docs):
    assert found(odd_docs) == by_hand(odd_docs.collect())


@pytest.mark.parametrize("crowded", [0, 2])
def test_crowded_marks_are_spelled_out(spark, few_docs, odd_docs, monkeypatch, crowded):
    monkeypatch.setattr(routing, "CHUNK", 20_000)
    monkeypatch.setattr(S, "CROWDED", crowded)
    assert found(few_docs) == by_hand(few_docs.collect())
    assert found(odd_docs) == by_hand(odd_docs.collect())
    line = "This line stands in every document of the whole table, as notices do."
    docs = spark.createDataFrame([(i, f"{i * 7919} before {line} after {i * 104729}") for i in range(60)], "doc_id long, text string")
    assert found(docs) == by_hand(docs.collect())


def test_a_passage_between_differing_neighbours_is_spelled_out(spark, few_docs, monkeypatch):
    """Few chunks, but a context per document at the passage's edges: no sort gets them."""
    line = "This line stands in every document of the whole table, as notices do."
    rnd = random.Random(1)
    rows = [(i, "".join(rnd.choice("abcdefgh ") for _ in range(90)) + line + "".join(rnd.choice("ijklmn ") for _ in range(90)))
            for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = S.smaller_elsewhere

    def bounded(contexts, doc):
        assert len(contexts) <= 100
        return plain(contexts, doc)

    monkeypatch.setattr(S, "smaller_elsewhere", bounded)
    monkeypatch.setattr(S, "AT_ONCE", 10)
    # by value, so that the workers get what is set here
    cloudpickle.register_pickle_by_value(S)
    try:
        monkeypatch.setattr(S, "MOST", 20)
        assert found(docs) == by_hand(docs.collect())
        for most, many in ((1, 1 << 18), (1 << 18, 1)):
            monkeypatch.setattr(S, "MOST", most)
            monkeypatch.setattr(S, "MANY", many)
            assert found(few_docs) == by_hand(few_docs.collect())
    finally:
        cloudpickle.unregister_pickle_by_value(S)


def test_large_marks_are_sorted_by_halves(spark, monkeypatch):
    rnd = random.Random(2)
    line, ends = "A line of some words that is quoted.", ["".join(rnd.choice("abcdefgh ") for _ in range(40)) for _ in range(12)]
    docs = spark.createDataFrame([(i, rnd.choice(ends) + line + rnd.choice(ends)) for i in range(150)], "doc_id long, text string")
    monkeypatch.setattr(S, "AT_ONCE", 4)
    cloudpickle.register_pickle_by_value(S)
    try:
        assert found(docs) == by_hand(docs.collect())
    finally:
        cloudpickle.unregister_pickle_by_value(S)


def test_a_gram_whose_hash_is_0_is_a_mark(monkeypatch):
    monkeypatch.setattr(S, "mixed", lambda x: routing.mixed(x) & S.U(0xFFFFFFFF))
    b = S.Bytes([bytes(range(60)), b"x" * 49, b"y" * 50])
    assert b.strings(np.arange(len(b.place))).tolist() == [*range(11), 109]


def test_a_document_of_one_string_alone_in_its_chunk(spark, monkeypatch):
    monkeypatch.setattr(routing, "CHUNK", 2)
    passage = "A passage of fifty bytes, copied from elsewhere..."
    docs = spark.createDataFrame([(1, f"before {passage} after"), (2, passage)], "doc_id long, text string")
    assert len(passage) == S.LENGTH and found(docs) == by_hand(docs.collect())


def test_many_chunks(few_docs, monkeypatch):
    monkeypatch.setattr(routing, "CHUNK", 20_000)
    monkeypatch.setattr(S, "PER_PART", 50_000)
    assert found(few_docs) == by_hand(few_docs.collect())


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh é"])
def test_overlapping_passages(spark, alphabet):
    """Pieces of one long string, so that contexts of a mark differ, and runs of one letter."""
    rnd = random.Random(alphabet)
    base = "".join(rnd.choice(alphabet) for _ in range(2000)) + "a" * 300
    rows = []
    for i in range(60):
        a = rnd.randrange(len(base))
        rows.append((rnd.randrange(40), base[a:a + rnd.randrange(20, 400)] + rnd.choice(alphabet) * rnd.randrange(70)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == by_hand(docs.collect())


def test_dedup_keeps_columns(odd_docs, no_docs):
    out = S.dedup(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert S.dedup(no_docs).collect() == [] and S.removed(no_docs).collect() == []
